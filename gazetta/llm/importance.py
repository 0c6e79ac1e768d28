"""Resampling of documents towards a target distribution, by importance of hashed n-grams.

Both sides, all documents and all target texts, are counted by the CRC-32 buckets of their word n-grams; a bucket's gain is the log
of how much likelier it is in the target, a document's weight the mean gain of its n-grams, and the draw takes the highest
weights after Gumbel noise that depends on the id alone.

N-grams are never spelled out. A task reads its documents once in their normalised form, every word behind one space,
and keeps the running CRC at each word's end. The CRC is linear over GF(2): that of a text is that of what stands
before its last n bytes, moved on by n bytes of zeros, plus that of these bytes. So the CRC of any run of words is the
difference of the prefix at its end and the prefix at its start, moved on by the run's length; a move by n bytes is one
table step for each bit of n.

What is gathered is one count for each bucket, a count for each score, which is a whole number of bounded size, and
one for each range of the order; the draw itself is a range sort of the rows at or above the score that the last drawn one has.

Defined cases: a null text has no words; a document without words has weight 0; a null id is hashed as an empty one and comes
first among ties; repeated rows are drawn as often as they fit, in any order among themselves; very long texts and words are
read in stretches; other columns are ignored; an empty table gives an empty result, an empty target the plain smoothed gains.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernel as K
from .shared import Scratch, small_batches

POLYNOMIAL = 0xEDB88320
STRETCH = 1 << 20  # bytes whose words are held at a time
_U = np.uint32
#: Bytes of words as they are, A-Z lower-cased, all others a space.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@lru_cache(1)
def table() -> np.ndarray:
    """What a byte becomes when it leaves the register."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & _U(1), (x >> _U(1)) ^ _U(POLYNOMIAL), x >> _U(1))
    return x


@lru_cache(64)
def move(bit: int) -> np.ndarray:
    """Four tables, one for each byte of a CRC, of the move by 2**bit bytes of zeros."""
    x = np.arange(256, dtype=np.uint32)[None] << (_U(8) * np.arange(4, dtype=np.uint32)[:, None])
    if not bit:
        return (x >> _U(8)) ^ table()[x & _U(255)]
    half = move(bit - 1)
    return step(half, step(half, x))


def step(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0][x & _U(255)] ^ tables[1][(x >> _U(8)) & _U(255)] ^ tables[2][(x >> _U(16)) & _U(255)] ^ tables[3][x >> _U(24)]


def moved(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    """CRCs moved on by so many bytes of zeros each."""
    x = x.copy()
    for bit in range(int(by.max()).bit_length() if len(by) else 0):
        some = np.flatnonzero((by >> bit) & 1)
        x[some] = step(move(bit), x[some])
    return x


def spaced(x: np.ndarray) -> np.ndarray:
    """CRCs after one more byte, a space."""
    raw = ~x
    return ~(table()[(raw ^ _U(32)) & _U(255)] ^ (raw >> _U(8)))


def stretches(data: bytes):
    """The words of a normalised text, in lists of about STRETCH bytes; a word is never cut."""
    lo = 0
    while lo < len(data):
        hi = data.find(b" ", lo + STRETCH) if lo + STRETCH < len(data) else -1
        hi = len(data) if hi < 0 else hi
        yield data[lo:hi].split()
        lo = hi


def ngrams(text: pa.Array, most: int):
    """(row of each word, row of each n-gram, its CRC) of all runs of 1 to `most` words, piece by piece.

    Pieces hold whole rows, or stretches of a long one whose runs reach back over `most` - 1 words of the stretch before.
    """
    data, offsets = K.utf8(text)
    data = data.tobytes().translate(NORMAL)
    held: list[list[bytes]] = []
    rows: list[int] = []
    room = STRETCH

    def piece(words, row, fresh):
        """`fresh` marks the words that end new runs."""
        ends = np.fromiter(accumulate(words, lambda c, w: crc32(b" " + w, c), initial=0), np.uint32, len(words) + 1)
        size = np.fromiter(map(len, words), np.int64, len(words))
        out_rows, out = [], []
        before = spaced(ends[:-1])  # the prefix at each word's start
        for n in range(1, most + 1):
            if n > 1:  # runs of n words that start where those of n - 1 did
                before, row_first = before[:-1], row[: len(row) - n + 1]
            else:
                row_first = row
            if not len(before):
                break
            before = moved(before, size[n - 1 :] + (n > 1))
            ok = (row_first == row[n - 1 :]) & fresh[n - 1 :]
            out_rows.append(row[n - 1 :][ok]), out.append((ends[n:] ^ before)[ok])
        return row[fresh], np.concatenate(out_rows), np.concatenate(out)

    def flush():
        words = [w for own in held for w in own]
        row = np.repeat(np.array(rows, np.int64), [len(own) for own in held])
        held.clear(), rows.clear()
        return piece(words, row, np.ones(len(words), bool))

    for r, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if b - a > STRETCH:
            tail: list[bytes] = []
            for words in stretches(data[a:b]):
                if words:
                    every = tail + words
                    yield piece(every, np.full(len(every), r), np.arange(len(every)) >= len(tail))
                    tail = every[max(0, len(every) - most + 1) :] if most > 1 else []
            continue
        words = data[a:b].split()
        if words:
            held.append(words), rows.append(r)
        room -= b - a
        if room <= 0:
            if held:
                yield flush()
            room = STRETCH
    if held:
        yield flush()


def bucket_counts(texts: DataFrame, buckets: int, most: int) -> np.ndarray:
    """How many n-grams of all texts each bucket holds; `buckets` numbers reach the driver."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, crc in ngrams(batch.column(0), most):
                total += np.bincount(crc % _U(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed share in the target and in the source, rounded down."""
    s, t, n = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + n) / ((a + 1.0) * (t + n)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, most: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        gain = shared.value
        for batch in batches:
            words, count, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for word, row, crc in ngrams(batch.column(1), most):
                words += np.bincount(word, minlength=batch.num_rows)
                count += np.bincount(row, minlength=batch.num_rows)
                total += np.bincount(row, weights=gain[crc % _U(len(gain))], minlength=batch.num_rows).astype(np.int64)  # whole sums of one piece, exact in doubles
            weight = np.where(count > 0, total // np.maximum(count, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in (words, count, weight))], ["doc_id", "n_words", "n_features", "weight"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def numbered(rows: DataFrame, order: list, scratch: Scratch) -> DataFrame:
    """Rows with their place `rank` in an order without ties, from 1: a range sort, then the count of earlier ranges."""
    dealt = scratch.write(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    base, at = [], 0
    for r in sorted(dealt.groupBy("range").count().collect()):  # one row for each range
        base.append((r["range"], at))
        at += r["count"]
    base = F.broadcast(rows.sparkSession.createDataFrame(base, "range int, base long"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return dealt.join(base, "range").withColumn("rank", F.col("base") + inside).drop("range", "base")


def resample(docs: DataFrame, target: DataFrame, buckets: int = 10_000, most: int = 2, least_words: int = 20, percent: int = 25, seed: int = 7) -> DataFrame:
    """Rows (doc_id, n_features, weight, score, rank, n_words) of all documents; `rank` is null where one is not drawn."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "importance")
    gain = gains(bucket_counts(docs, buckets, most), bucket_counts(target, buckets, most))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    score = F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    rows = scratch.write(weighed(docs, gain, most).withColumn("score", score.cast("long")).withColumn("tie", F.monotonically_increasing_id()), "scores")
    enough = F.col("n_words") >= least_words
    by_score = rows.where(enough).groupBy("score").count().collect()  # scores are whole thousandths of logs: some 100,000 values at most
    left = percent * sum(r["count"] for r in by_score) // 100
    drawn, cut = left, None
    for r in sorted(by_score, reverse=True):
        if left <= 0:
            break
        cut, left = r["score"], left - r["count"]
    none = F.lit(None).cast("long").alias("rank")
    columns = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    if cut is None:
        return rows.withColumn("rank", none).select(columns)
    high = enough & (F.col("score") >= cut)
    ranked = numbered(rows.where(high), [F.col("score").desc(), F.col("doc_id").asc(), F.col("tie").asc()], scratch)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.select(columns).unionByName(rows.where(~high).withColumn("rank", none).select(columns))
