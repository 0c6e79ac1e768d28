"""Benchmark decontamination by SimHash windows, multi-index Hamming blocks and exact verification.

Windows as long as an item, in word shingles, stand at every place of a document. A window that reaches the bound
holds so many shingles of items that a table of all items' shingles rules nearly all windows out; each one that is left gets
a 64-bit SimHash of its shingles. Items are indexed by eight 8-bit blocks of their fingerprints together with all values
within an eighth of the radius, so every fingerprint within the radius meets in some block (pigeonhole).
Candidates within the radius are verified exactly: the window is compared with the item by weighted shingle
similarity, the sum of smaller over the sum of larger shingle counts.

The radius of 23 bits is far beyond what windows within the bound differ by (11 bits in the mean), so it costs next to none of them.
The index holds at most `items_per_pass` items, some tens of megabytes; a larger benchmark takes several passes.

Defined cases: null, empty or wordless items and documents match nothing; texts with fewer words than the shingle
size have their whole sequence as one shingle, so such an item matches only a document that consists of it; a
document shorter than an item is one window; for each document and item the most similar place is kept, of equal ones
the first; repeated rows give repeated hits in the documents and one hit for each item id; other columns are
ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .shared import small_batches

BLOCKS, WIDTH = 8, 8
BITS = 22  # of the table that rules shingles out: 4 MB
SPAN = 1 << 12  # windows whose sums of bits are held at a time


def near(radius: int) -> np.ndarray:
    """All values of a block with at most `radius` bits."""
    x = np.arange(1 << WIDTH, dtype=np.uint8)
    return x[np.bitwise_count(x) <= radius]


def fingerprints(x: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """SimHashes of the windows of `size` shingles at increasing places."""
    out = np.empty(len(start), np.uint64)
    lo = 0
    while lo < len(start):
        hi = int(np.searchsorted(start, start[lo] + SPAN))
        first, past = int(start[lo]), int(start[hi - 1])
        # sums of the first window, then what each step to the right adds and takes away
        ones = np.zeros((past - first + 1, 64), np.int32)
        for a in range(first, first + size, SPAN):
            ones[0] += unpacked(x[a : min(a + SPAN, first + size)]).sum(axis=0, dtype=np.int32)
        if past > first:
            ones[1:] = unpacked(x[first + size : past + size])
            ones[1:] -= unpacked(x[first:past])
            np.cumsum(ones, axis=0, out=ones)
        out[lo:hi] = np.packbits(2 * ones[start[lo:hi] - first].astype(np.int64) > size, axis=1).view(np.uint64)[:, 0]
        lo = hi
    return out


def unpacked(x: np.ndarray) -> np.ndarray:
    return np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1)


class Item:
    def __init__(self, item_id: int, x: np.ndarray):
        self.id, self.n = item_id, len(x)
        self.kinds, self.counts = np.unique(x, return_counts=True)
        self.print = fingerprints(x, np.zeros(1, np.int64), len(x))[0]

    def shared(self, window: np.ndarray) -> int:
        """The sum of smaller counts."""
        kinds, counts = np.unique(window, return_counts=True)
        at = np.minimum(np.searchsorted(self.kinds, kinds), len(self.kinds) - 1)
        return int(np.minimum(self.counts[at], counts)[self.kinds[at] == kinds].sum())


class Index:
    """Items by length, each length with its Hamming tables, and all their shingles."""

    def __init__(self, items: list[tuple[int, np.ndarray, bool]], radius: int, num: int, den: int):
        self.radius, self.num, self.den, self.alone, lengths = radius, num, den, {}, {}
        for item_id, x, whole in items:
            if whole:
                self.alone.setdefault(int(x[0]), []).append(item_id)
            else:
                lengths.setdefault(len(x), []).append(Item(item_id, x))
        items_ = [i for own in lengths.values() for i in own]
        self.sizes = np.array([i.n for i in items_], np.int64)
        every = np.concatenate([np.zeros(0, np.uint64), *(i.kinds for i in items_)])
        order = np.argsort(every, kind="stable")
        self.who = np.repeat(np.arange(len(items_)), [len(i.kinds) for i in items_])[order]
        self.often = np.concatenate([np.zeros(0, np.int64), *(i.counts for i in items_)])[order]
        self.shingles, self.at = np.unique(every[order], return_index=True)
        self.at = np.append(self.at, len(every))
        self.maybe = np.zeros(1 << BITS, dtype=bool)
        self.maybe[self.shingles & np.uint64((1 << BITS) - 1)] = True
        self.least = min((self.need(n, -(-num * n // den)) for n in lengths), default=0)
        flips = near(radius // BLOCKS)
        self.lengths = {}
        for n, own in sorted(lengths.items()):
            prints = np.array([i.print for i in own])
            tables = []
            for block in prints.view(np.uint8).reshape(-1, BLOCKS).T:
                keys = (block[:, None] ^ flips[None]).ravel()
                order = np.argsort(keys, kind="stable")
                tables.append((np.searchsorted(keys[order], np.arange((1 << WIDTH) + 1)), order // len(flips)))
            self.lengths[n] = (own, prints, tables)

    def need(self, n: int, size: int) -> int:
        """Shingles that an item of `n` and a window of `size` share at least."""
        return -(-self.num * (n + size) // (self.num + self.den))

    def held(self, x: np.ndarray) -> np.ndarray:
        """Which shingles are an item's."""
        out = self.maybe[x & np.uint64((1 << BITS) - 1)]
        some = np.flatnonzero(out)
        if len(some):
            out[some] = self.shingles[np.minimum(np.searchsorted(self.shingles, x[some]), len(self.shingles) - 1)] == x[some]
        return out

    def within(self, x: np.ndarray) -> set[int]:
        """Lengths of the items that share enough with these shingles as a whole."""
        kinds, counts = np.unique(x, return_counts=True)
        at = np.searchsorted(self.shingles, kinds)
        many = self.at[at + 1] - self.at[at]
        place = np.arange(many.sum()) + np.repeat(self.at[at] - (np.cumsum(many) - many), many)
        same = np.bincount(self.who[place], weights=np.minimum(self.often[place], np.repeat(counts, many)), minlength=len(self.sizes))
        return set(self.sizes[same * self.den >= self.num * self.sizes].tolist())

    def candidates(self, n: int, prints: np.ndarray):
        """(window, item) with fingerprints within the radius."""
        own, theirs, tables = self.lengths[n]
        found = []
        for (start, who), block in zip(tables, prints.view(np.uint8).reshape(-1, BLOCKS).T, strict=True):
            lo, many = start[block], start[block.astype(int) + 1] - start[block]
            window = np.repeat(np.arange(len(prints)), many)
            item = who[np.arange(len(window)) + np.repeat(lo - (np.cumsum(many) - many), many)]
            ok = np.bitwise_count(prints[window] ^ theirs[item]) <= self.radius
            found.append(window[ok] * len(own) + item[ok])
        pairs = np.unique(np.concatenate(found))
        return zip((pairs // len(own)).tolist(), (own[i] for i in (pairs % len(own)).tolist()), strict=True)

    def row(self, x: np.ndarray, held: np.ndarray):
        """(item id, similarity, first shingle, shingles) of the best place of each item in one document."""
        total = np.concatenate([[0], np.cumsum(held)])
        best: dict[int, tuple] = {}
        for n in sorted(self.within(x[held])):
            size = min(n, len(x))
            start = np.flatnonzero(total[size:] - total[: len(total) - size] >= self.need(n, size))
            if not len(start):
                continue
            for w, item in self.candidates(n, fingerprints(x, start, size)):
                at = int(start[w])
                same = item.shared(x[at : at + size])
                either = n + size - same
                if self.den * same >= self.num * either and (same / either, -at) > best.get(item.id, (0.0, 0))[:2]:
                    best[item.id] = (same / either, -at, size)
        return [(item, sim, -at, size) for item, (sim, at, size) in best.items()]


def hits(text: pa.Array, index: Index):
    """(row, item id, similarity, first word, words) of every verified place, the best one for each row and item."""
    for lo, hi in K.chunks(text):
        h, at, _, _ = K.words(*K.utf8(text.slice(lo, hi - lo)))
        size = np.diff(at)
        if index.alone:
            for r in np.flatnonzero((size > 0) & (size < K.WORDS)).tolist():
                for item in index.alone.get(int(K.shingle(h[at[r] : at[r + 1]], int(size[r]))[0]), ()):
                    yield lo + r, item, 1.0, 0, int(size[r])
        x = K.shingle(h, K.WORDS)
        if not index.lengths or not len(x):
            continue
        held = index.held(x)
        for k in range(1, K.WORDS):  # shingles over the border of two rows are none
            over = at[1:-1] - k
            held[over[(over >= 0) & (over < len(held))]] = False
        total = np.concatenate([[0], np.cumsum(held)])
        ends = np.minimum(at, len(held))
        for r in np.flatnonzero((size >= K.WORDS) & (total[ends[1:]] - total[ends[:-1]] >= index.least)).tolist():
            part = slice(at[r], at[r + 1] - K.WORDS + 1)
            for item, sim, first, n in index.row(x[part], held[part]):
                yield lo + r, item, sim, first, n + K.WORDS - 1


def contaminated(docs: DataFrame, benchmark: DataFrame, num: int = 3, den: int = 4, radius: int = 23, items_per_pass: int = 20_000) -> DataFrame:
    """Rows (doc_id, item_id, similarity, first_word, n_words): where documents repeat benchmark items."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    benchmark = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    passes = max(1, math.ceil(benchmark.count() / items_per_pass))
    out = None
    for p in range(passes):
        items = []
        for r in benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p).collect():  # about items_per_pass
            h, at, _, _ = K.words(*K.utf8(pa.array([r["text"]])))
            if len(h):
                items.append((r["item_id"], next(K.shingle_rows(h, at)), len(h) < K.WORDS))
        shared = spark.sparkContext.broadcast(Index(items, radius, num, den))

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                found = list(hits(batch.column(1), index))
                rows, items, sims, starts, sizes = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [], [], [])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(items, pa.int64()), pa.array(sims, pa.float64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], ["doc_id", "item_id", "similarity", "first_word", "n_words"])

        found = docs.mapInArrow(run, "doc_id long, item_id long, similarity double, first_word long, n_words long")
        out = found if out is None else out.unionByName(found)
    return out
