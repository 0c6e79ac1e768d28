"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its hashed byte n-grams (A-Z lower-cased), and a linear softmax on it
gives the languages. Both are trained by stochastic gradient descent in numpy on at most `fit_rows` labelled
learning rows, those with the smallest hash of the id. As the model is linear up to the softmax, embeddings and
output weights are multiplied once, and every whole text is scored by table look-ups. The rows are taken by
that hash as long as their n-grams stay within `fit_bytes`; of rows that repeat an id one teaches. A temperature fitted on
rows left out of training calibrates the score, and a text is rejected below a score that hardly any correctly
identified left-out row stays under.

Defined cases: null texts and texts without a letter are `und` with score 0 and rejected; rows with a null language
teach nothing; with no labelled row everything is `und`; repeated rows are scored as often as they came; other
columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .shared import small_batches

BITS = 16
GRAMS = (2, 3, 4)
STRETCH = 1 << 18  # bytes scored at a time; some 60 bytes of arrays for each
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32


def grams(data: np.ndarray):
    """Per n the hashed n-gram that starts at each byte."""
    x = _FOLD[data]
    packed, shift = x.copy(), np.uint32(32 - BITS)
    for n in range(2, max(GRAMS) + 1):
        if len(x) < n:
            return
        with np.errstate(over="ignore"):
            packed = (packed[:-1] << np.uint32(8)) | x[n - 1 :]
            if n in GRAMS:
                h = (packed + np.uint32(n)) * np.uint32(0x9E3779B1)
                h ^= h >> np.uint32(15)
                yield n, ((h * np.uint32(0x85EBCA77)) >> shift)


def bag(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of one text and their shares."""
    found = [g for _, g in grams(data)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    idx, n = np.unique(np.concatenate(found), return_counts=True)
    return idx.astype(np.int64), n / n.sum()


class Model:
    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, heat: float, floor: float):
        self.langs, self.table, self.bias, self.heat, self.floor = langs, table, bias, heat, floor

    def logits(self, text: pa.Array) -> np.ndarray:
        out = np.zeros((len(text), len(self.langs)))
        for lo, hi in K.chunks(text, STRETCH):
            data, offsets = K.utf8(text.slice(lo, hi - lo))
            count = np.zeros(hi - lo)
            for at in range(0, len(data), STRETCH):  # more than one stretch only in a long text
                for n, g in grams(data[at : at + STRETCH + max(GRAMS) - 1]):
                    # n-grams that begin in one row and end in the next are left out by cutting each row's last n - 1
                    stop = np.clip(np.maximum(offsets[1:] - (n - 1), offsets[:-1]) - at, 0, min(len(g), STRETCH))
                    start = np.minimum(np.clip(offsets[:-1] - at, 0, min(len(g), STRETCH)), stop)
                    cum = np.zeros((len(g) + 1, len(self.langs)))
                    np.cumsum(self.table[g], axis=0, out=cum[1:])
                    out[lo:hi] += cum[stop] - cum[start]
                    count += stop - start
            out[lo:hi] /= np.maximum(count, 1)[:, None]
        return (out + self.bias) / self.heat

    def best(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        z = self.logits(text)
        z = np.exp(z - z.max(axis=1, keepdims=True))
        p = z / z.sum(axis=1, keepdims=True)
        return p.argmax(axis=1), p.max(axis=1)


def train(bags: list, y: np.ndarray, langs: list[str], dim: int, epochs: int, rate: float, seed: int = 1) -> Model:
    rng = np.random.default_rng(seed)
    emb, out, bias = rng.uniform(-1 / dim, 1 / dim, (1 << BITS, dim)), np.zeros((dim, len(langs))), np.zeros(len(langs))
    held = np.arange(len(bags)) % 4 == 3 if len(bags) >= 8 else np.zeros(len(bags), bool)
    own = np.flatnonzero(~held)
    steps, total = 0, epochs * len(own)
    for _ in range(epochs):
        for i in rng.permutation(own):
            idx, share = bags[i]
            if not len(idx):
                continue
            lr = rate * (1 - steps / total)
            steps += 1
            x = share @ emb[idx]
            z = x @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = out @ p
            out -= lr * np.outer(x, p)
            bias -= lr * 0.1 * p
            emb[idx] -= (lr * share * len(idx) ** 0.5)[:, None] * back  # larger steps where a text spreads over more n-grams
    model = Model(langs, (emb @ out).astype(np.float32), bias, 1.0, 0.0)
    check = np.flatnonzero(held) if held.any() else own
    z = np.array([bags[i][1] @ model.table[bags[i][0]] + bias if len(bags[i][0]) else bias for i in check])
    if len(check):
        def loss(heat):
            s = z / heat
            s = s - s.max(axis=1, keepdims=True)
            return -(s[np.arange(len(s)), y[check]] - np.log(np.exp(s).sum(axis=1))).mean()

        model.heat = float(min(np.geomspace(0.05, 20, 60), key=loss))
        s = z / model.heat
        p = np.exp(s - s.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        right = p.argmax(axis=1) == y[check]
        if right.any():
            model.floor = float(min(0.5, np.quantile(p.max(axis=1)[right], 0.001) * 0.9))
    return model


def learn(docs: DataFrame, fit_rows: int, fit_bytes: int, dim: int, epochs: int, rate: float) -> Model | None:
    """`docs` has (doc_id, text, lang) of the learning rows."""
    docs = docs.where("lang is not null")
    first = docs.groupBy("doc_id").agg(F.max(F.octet_length("text")).alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).collect()
    ids, room = [], fit_bytes
    for r in first:  # a text of n bytes has at most 3 n n-grams, and 2**BITS different ones, of 8 bytes
        room -= 8 * min(len(GRAMS) * (r["n"] or 0), 1 << BITS)
        if room < 0 and ids:
            break
        ids.append(r["doc_id"])
    if not ids:
        return None

    def rows(batches):
        for batch in batches:
            found = []
            for lo, hi in K.chunks(batch.column(2)):
                data, offsets = K.utf8(batch.column(2).slice(lo, hi - lo))
                found += [bag(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([a.astype(np.int32).tobytes() for a, _ in found], pa.binary()), pa.array([b.astype(np.float32).tobytes() for _, b in found], pa.binary())], ["doc_id", "lang", "idx", "share"])

    # at most fit_rows; from Arrow, as a list of tuples would start Python workers of another kind beside those of the UDFs
    some = F.broadcast(docs.sparkSession.createDataFrame(pa.table({"doc_id": pa.array(ids, pa.int64())})))
    one = F.min(F.struct("lang", "idx", "share")).alias("x")  # of rows that repeat an id
    got = docs.join(some, "doc_id").select("doc_id", "lang", "text").mapInArrow(rows, "doc_id long, lang string, idx binary, share binary").groupBy("doc_id").agg(one).select("doc_id", "x.*").toArrow()
    told = got["lang"].to_pylist()
    langs = sorted(set(told))
    order = np.argsort(got["doc_id"].to_numpy(), kind="stable").tolist()
    view = lambda name, k, kind: np.frombuffer(got[name][k].as_buffer(), kind)
    return train([(view("idx", k, np.int32), view("share", k, np.float32)) for k in order], np.array([langs.index(told[k]) for k in order]), langs, dim, epochs, rate)


def identify(docs: DataFrame, learn_from: DataFrame | None = None, folds: int = 3, fold: int = 1, fit_rows: int = 3000, fit_bytes: int = 1 << 27, dim: int = 16, epochs: int = 4, rate: float = 0.5) -> DataFrame:
    """All columns of `docs`, with held_out, lang_pred, score and rejected behind them, in place of any of these names."""
    small_batches(docs.sparkSession)
    docs = docs.drop("held_out", "lang_pred", "score", "rejected", "_letter")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))
    base = (docs if learn_from is None else learn_from).where(~out).where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = learn(base, fit_rows, fit_bytes, dim, epochs, rate)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["_letter", *docs.columns, "lang_pred", "score", "rejected"]
    at = docs.columns.index("text") + 1

    def run(batches):
        m = shared.value
        for batch in batches:
            letter = np.asarray(batch.column(0).fill_null(False).to_numpy(zero_copy_only=False), dtype=bool)
            if m is None:
                pred, score, bad = ["und"] * len(letter), np.zeros(len(letter)), np.ones(len(letter), bool)
            else:
                best, p = m.best(batch.column(at))
                score = np.where(letter, p, 0.0)
                pred, bad = [m.langs[k] if ok else "und" for k, ok in zip(best, letter, strict=True)], ~letter | (score < m.floor)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(bad, pa.bool_())], names)

    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    kind = StructType([StructField("_letter", BooleanType()), *docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())])
    return docs.select(F.col("text").cast("string").rlike(r"\p{L}").alias("_letter"), "*").mapInArrow(run, kind).drop("_letter").withColumn("held_out", out)
