"""Best-fit packing of documents into sequences of a fixed length, in bounded space.

Each task tokenizes the documents of its split and packs them as they come. Only documents longer than a sequence
are cut: into whole sequences, with the rest as the first piece. A piece goes to the open bin with the least free
space that holds it; open bins are kept in a bitset keyed by free space, so the best fit is one shift and one
lowest-bit step. When more than `open_bins` are open, the fullest closes first. No text moves between tasks, and a
task's memory does not depend on its input. The pieces of bins still open when a task ends are packed once more, the
longest first and those of many tasks together, so splits cost little room.

Defined cases: null and empty texts are documents of the end token alone; ties go to the bin opened last; repeated
rows are packed as often as they come; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .shared import Scratch, small_batches

#: The published pre-tokenizer pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: itself if printable, else the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(2)
def encoder(path: str):
    """A tiktoken encoder of the vocabulary in a tokenizers JSON file; ids are the same, several times faster."""
    import tiktoken

    letters = byte_letters()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", ())}
    ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


#: tiktoken's pattern engine overflows its stack on whitespace runs of several 100,000.
LONG = re.compile(r"(?<!\s)\s{10000}")


@lru_cache(4)
def plain(path: str, added: bool):
    """The tokenizer of `tokenizers`."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = not added
    return whole


@lru_cache(4)
def encode(path: str, added: bool):
    """A function from a text to its ids, which are those of `tokenizers`.

    Texts with a long whitespace run go to `tokenizers` itself, and so do texts that hold an added token, which is
    one id if `added` and ordinary text otherwise; it takes 32 MB and is read when the first such text comes.
    """
    fast = encoder(path)
    with open(path, encoding="utf-8") as f:
        tokens = [t["content"] for t in json.load(f).get("added_tokens", ())]

    def run(text: str) -> list[int]:
        if any(t in text for t in tokens) or (len(text) >= 10_000 and LONG.search(text)):
            return plain(path, added).encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return run


class Bins:
    """Open bins by free space: `mask` has bit f set while a bin with f free places is open."""

    def __init__(self, size: int, open_bins: int, first_id: int):
        self.size, self.most, self.next = size, open_bins, first_id
        self.mask, self.count, self.by_free = 0, 0, {}

    def _open(self, free: int, bin_id: int) -> None:
        if not free:
            return
        if self.count == self.most:  # the fullest closes first, be it the new one
            fullest = (self.mask & -self.mask).bit_length() - 1
            if free <= fullest:
                return
            self._take(fullest)
        self.by_free.setdefault(free, []).append(bin_id)
        self.mask |= 1 << free
        self.count += 1

    def _take(self, free: int) -> int:
        ids = self.by_free[free]
        out = ids.pop()
        if not ids:
            self.mask ^= 1 << free
        self.count -= 1
        return out

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        fit = self.mask >> length
        if fit:
            free = length + (fit & -fit).bit_length() - 1
            bin_id = self._take(free)
        else:
            free, bin_id = self.size, self.next
            self.next += 1
        self._open(free - length, bin_id)
        return bin_id, self.size - free


def cut(length: int, size: int) -> list[int]:
    """Piece lengths of a document."""
    return [length] if length <= size else [(length - 1) % size + 1, *[size] * ((length - 1) // size)]


def pack(docs: DataFrame, vocabulary: str, size: int = 1024, end_id: int = 2, open_bins: int = 1024, id_col: str = "doc_id", text_col: str = "text", added: bool = False, together: int = 1 << 15) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one for each piece.

    With `added`, an added token in a text is its one id, as by default in `tokenizers`; else it is ordinary text.
    Pieces of about `together` bins that tasks leave open meet in one task.
    """
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, fill long"

    def run(batches):
        code = encode(vocabulary, added)
        bins = Bins(size, open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for lo, hi in K.chunks(batch.column(1), 1 << 22):
                out: dict[str, list] = {c: [] for c in columns}
                for doc, text in zip(batch.column(0)[lo:hi].to_pylist(), batch.column(1)[lo:hi].to_pylist(), strict=True):
                    ids = np.array(code(text or "") + [end_id], dtype="<u4")
                    start = 0
                    for k, n in enumerate(cut(len(ids), size)):
                        where, offset = bins.put(n)
                        for c, v in zip(columns, (doc, k, start, n, zlib.crc32(ids[start : start + n].tobytes()), where, offset), strict=True):
                            out[c].append(v)
                        start += n
                yield rows(out, None)
        yield rows({"sequence_id": [b for own in bins.by_free.values() for b in own]}, [size - f for f, own in bins.by_free.items() for _ in own])

    def rows(out, fill):
        n = len(out["sequence_id"])
        return pa.RecordBatch.from_arrays([*(pa.array(out.get(c, [None] * n), pa.int32() if c == "piece" else pa.int64()) for c in columns), pa.array(fill or [None] * n, pa.int64())], [*columns, "fill"])

    def again(batches):
        bins = Bins(size, open_bins, 1 << 61 | TaskContext.get().partitionId() << 40)
        for batch in batches:
            new = [bins.put(n) for n in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array([b for b, _ in new], pa.int64()), pa.array([o for _, o in new], pa.int64())], columns)

    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "packing")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    done = scratch.write(docs.mapInArrow(run, kind), "pieces")
    left, every = done.where("fill is not null").select("sequence_id"), done.where("fill is null").select(*columns)
    tasks = -(-left.count() // together) or 1
    loose = every.join(left, "sequence_id", "left_semi").select(*columns).repartition(tasks, "sequence_id").sortWithinPartitions(F.desc("length"), "sequence_id", "offset")
    return every.join(left, "sequence_id", "left_anti").select(*columns).unionByName(loose.mapInArrow(again, kind.removesuffix(", fill long")))
