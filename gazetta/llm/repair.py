"""Repair of the structure of conversations: cheapest edits by integer weights over a DAG.

A repaired conversation has the role initials `(s?(ua)+)?`. Each row is kept, given another role (user or assistant) or
deleted, and turns without text may be inserted anywhere. The DAG's nodes are the rows read and the state of the output
(nothing yet, after `s`, after `u`, after `a`). A path's weight is one integer: its high digits are the cost, its low
digits, as many as any path can need, the letters of its edits from the first on, with zeros behind the last. So the smallest
integer at a node is the cheapest path and, of equal costs, the one whose letters come first in ASCII order, and a plain
minimum decides everything. Two equal costs at one node never belong to letters of which one begins the other, as
the further letters could only be inserts, which cost; so the minimum of a node is that of every path through it.

Rows reach a task in the order of their conversation, and only the four nodes of the last row are held: their weights, and a
hash of the text that each would give. No texts are gathered, however long a conversation is; a weight of n rows
has about 6 n bits. What is said more than once is told by 128-bit digests of role and text.

Defined cases: rows go by turn, nulls first, of equal ones by role and text; a null role or text is one space; an empty role has no initial, so
such a row cannot be kept as it is; rows with a null
conversation id form one conversation; repeated rows are repeated turns, so all but one are duplicates; very long
texts are read once; a conversation of which no row is left gives zeros, no edits and the hash of the empty text; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import small_batches

SPACE = " \t\n\x0b\x0c\r"
#: What edits cost, and the letters in ASCII order, whose places from 1 are their digits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LETTERS = "DIKR"
D, I, K, R = 1, 2, 3, 4
DIGIT = 3  # bits of a letter
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {NOTHING: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
KEEPS = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
GOOD = ("su", "ua", "au")
FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Path:
    """The cheapest path to a node: its weight, how far its next letter is shifted, and the hash of its output."""

    __slots__ = ("weight", "shift", "hash")

    def __init__(self, weight: int, shift: int, digest):
        self.weight, self.shift, self.hash = weight, shift, digest


class Dag:
    """The nodes behind the rows read so far, for a conversation of at most `rows` rows."""

    def __init__(self, rows: int):
        # a cheapest path to a node inserts fewer than rows / 2 + 4 turns, as deleting all rows and two inserts reach the same state
        self.width = DIGIT * (2 * rows + 8)
        self.nodes: list[Path | None] = [Path(0, self.width, hashlib.sha256()), None, None, None]
        self.insert()

    def after(self, path: Path, cost: int, letter: int) -> int:
        return path.weight + (cost << self.width) + (letter << (path.shift - DIGIT))

    def moved(self, state: int, weight: int, said: bytes | None) -> Path:
        path = self.nodes[state]
        digest = path.hash
        if said is not None:
            digest = digest.copy()
            digest.update(said if state == NOTHING else b"\n" + said)
        return Path(weight, path.shift - DIGIT, digest)

    def insert(self) -> None:
        """Inserts behind the last row; more than two in a row lead back to a state at a higher cost."""
        for state in (NOTHING, SYSTEM, ASSISTANT, USER):
            if self.nodes[state] is not None:
                to, role = NEXT[state]
                weight = self.after(self.nodes[state], INSERT, I)
                if self.nodes[to] is None or weight < self.nodes[to].weight:
                    self.nodes[to] = self.moved(state, weight, f"{role}:".encode())

    def read(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        best: dict[int, tuple] = {}
        extra = TRUNCATED if truncated else 0

        def offer(to, state, cost, letter, own):
            weight = self.after(self.nodes[state], cost, letter)
            if to not in best or weight < best[to][0]:
                best[to] = (weight, state, own)

        for state in (s for s in range(4) if self.nodes[s] is not None):
            offer(state, state, DELETE, D, None)
            if not must_go:
                if (kept := KEEPS.get((state, role[:1]))) is not None:
                    offer(kept, state, extra, K, role)
                to, other = NEXT[state]
                offer(to, state, REROLE + extra, R, other)
        self.nodes = [None if s not in best else self.moved(best[s][1], best[s][0], None if best[s][2] is None else f"{best[s][2]}:{text}".encode("utf-8", "surrogatepass")) for s in range(4)]
        self.insert()

    def end(self) -> tuple[int, str, str]:
        """(cost, audit, hash of the output) of the cheapest path to an allowed end."""
        path = min((self.nodes[s] for s in (NOTHING, ASSISTANT) if self.nodes[s] is not None), key=lambda p: p.weight)
        letters = format(path.weight & ((1 << self.width) - 1), "o").zfill(self.width // DIGIT).rstrip("0")
        return path.weight >> self.width, letters.translate(str.maketrans("1234", LETTERS)), path.hash.hexdigest()


class Conversation:
    """One conversation, read row by row: its faults and its DAG."""

    def __init__(self, conv_id, rows: int):
        self.id, self.dag, self.seen, self.before = conv_id, Dag(rows), set(), None
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None

    def read(self, turn, role: str, text: str) -> None:
        if turn is not None and turn != self.last:  # turns come in order
            self.first = turn if self.first is None else self.first
            self.turns, self.last = self.turns + 1, turn
        if self.before is not None and self.before + role[:1] not in GOOD:
            self.illegal += 1
        self.before = role[:1]
        name = hashlib.blake2b(len(role).to_bytes(8, "big") + (role + text).encode("utf-8", "surrogatepass"), digest_size=16).digest()
        said = text.rstrip(SPACE)
        blank, repeated = not said, name in self.seen
        truncated = not (blank or repeated) and said[-1] not in ".!?"
        self.seen.add(name)
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += truncated
        self.dag.read(role, text, blank or repeated, truncated)

    def end(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.dag.end())


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations as a faulty writer leaves them, with `copies`, how often each row stands: by the crc32 of id and turn a row is lost, emptied, cut, doubled or becomes the user's."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    mark = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    return rows.select(
        "conv_id", "turn", F.when(mark == 4, "user").otherwise(shown("role")).alias("role"), F.when(mark == 1, "").when(mark == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text")).alias("text"),
        F.when(mark == 0, 0).when(mark == 3, 2).otherwise(1).alias("copies"),
    )


def ordered(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, rows): rows in their order, every conversation in one task's stream, with its number of rows."""
    copies = F.col("copies").cast("int") if "copies" in rows.columns else F.lit(1)
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), shown("role"), shown("text"), copies.alias("copies"))
    order = ("turn", "role", "text")
    whole = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumn("rows", F.sum("copies").over(whole)).sortWithinPartitions("conv_id", *order)


def repairs(rows: DataFrame) -> DataFrame:
    """One row for each conversation: its faults, the cheapest edits, what they cost, and the hash of the repaired turns.

    `rows` has conv_id, turn, role and text, and may have `copies`; a row without copies only names its conversation.
    """
    small_batches(rows.sparkSession)
    kind = f"conv_id long, {FOUND}"
    names = [c.split()[0] for c in kind.split(", ")]

    def run(batches):
        now, out = None, []

        def batch():
            types = [pa.string() if c in ("audit", "repaired_sha256") else pa.int64() for c in names]
            made = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), types, strict=True)], names)
            out.clear()
            return made

        for some in batches:
            for conv_id, turn, role, text, copies, total in zip(*(c.to_pylist() for c in some.columns), strict=True):
                if now is None or now.id != conv_id:
                    if now is not None:
                        out.append(now.end())
                    now = Conversation(conv_id, total)
                for _ in range(copies):
                    now.read(turn, role, text)
            if out:
                yield batch()
        if now is not None:
            out.append(now.end())
            yield batch()

    return ordered(rows).mapInArrow(run, kind)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns, (conv_id, place, role, text), by the edits that `repairs` found.

    Letters become rows and meet the rows that they edit by number, so a long conversation is many rows everywhere.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text", "copy")
    each = ordered(rows).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    each = each.withColumn("k", F.row_number().over(order)).select(F.coalesce("conv_id", F.lit(0)).alias("c"), F.col("conv_id").isNull().alias("none"), "k", F.col("role").alias("old"), "text")
    edits = found.where("audit <> ''").select("conv_id", (F.char_length(F.replace("audit", F.lit("D"), F.lit(""))) % 2).alias("led"), F.posexplode(F.transform(F.sequence(F.lit(1), F.char_length("audit")), lambda i: F.substr("audit", i, F.lit(1)))).alias("at", "edit"))
    upto = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edits = edits.withColumn("k", F.when(F.col("edit") != "I", F.count_if(F.col("edit") != "I").over(upto))).withColumn("place", F.count_if(F.col("edit") != "D").over(upto) - 1).where("edit <> 'D'")
    edits = edits.withColumn("c", F.coalesce("conv_id", F.lit(0))).withColumn("none", F.col("conv_id").isNull())
    role = F.when(F.col("edit") == "K", F.col("old")).when((F.col("place") - F.col("led")) % 2 == 0, "user").otherwise("assistant")
    return edits.join(each, ["c", "none", "k"], "left").select("conv_id", "place", role.alias("role"), F.coalesce("text", F.lit("")).alias("text"))
