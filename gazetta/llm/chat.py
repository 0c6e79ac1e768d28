"""Chat formatting as a prefix tree with ancestor attention intervals.

Conversations that share initial turns share nodes of one tree: a node is a turn together with all turns before
it. Nodes are emitted once each, depth first, into one stream of tokens. Every node has its place in the stream,
the position id of its first token (the tokens of its ancestors come before it, not those of its siblings) and the
stream intervals of its ancestors, which are what its tokens attend to besides themselves. The loss mask covers the
texts of assistant turns.

Template of a turn: `<s>` role newline text `</s>`. In roles and texts a backslash becomes `\\\\`, `<` becomes `\\l` and
`[` becomes `\\b`, and in roles a newline becomes `\\n`; so no control string of this or the bracket style can
appear inside a text, and the way back is exact.

The stream is laid out by a range sort of the distinct conversations by their paths of node hashes, where a node is new in
the first line that holds it, and by running sums inside ranges, with one total for each range on the driver. So work grows
with the number of turns, however long a conversation is, and a first turn that a third of all conversations share
is one node whose children are spread over ranges like any others.

Defined cases: rows go by turn number, of equal ones by role and text, nulls first; a null text or role is empty; rows with a
null conversation id form one conversation with a null id; equal conversations share all nodes; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, salted_join, small_batches

OPEN, CLOSE = "<s>", "</s>"
DEPTH = 16  # bytes of a node's hash


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l").replace("[", "\\b")


def unescape(text: str) -> str:
    parts = text.split("\\\\")
    return "\\".join(p.replace("\\l", "<").replace("\\b", "[").replace("\\n", "\n") for p in parts)


def render(role: str, text: str) -> tuple[str, str, str]:
    """A turn's header, text and end."""
    return OPEN + escape(role).replace("\n", "\\n") + "\n", escape(text), CLOSE


def parse(turn: str) -> tuple[str, str]:
    head, _, text = turn.removeprefix(OPEN).removesuffix(CLOSE).partition("\n")
    return unescape(head), unescape(text)


@lru_cache(2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def chains(rows: DataFrame) -> DataFrame:
    """Per conversation its turns and, for each, the hash of the path down to it."""
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # one conversation is one training example, so its turns fit in one row
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def run(batches):
        for batch in batches:
            out = []
            for turns in batch.column(1).to_pylist():
                path, own = b"", []
                for t in turns:
                    role, text = t["role"].encode("utf-8", "surrogatepass"), t["text"].encode("utf-8", "surrogatepass")
                    path = hashlib.blake2b(path + len(role).to_bytes(8, "big") + role + text, digest_size=DEPTH).digest()
                    own.append(path)
                out.append(own)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.binary()))], ["conv_id", "turns", "nodes"])

    return convs.mapInArrow(run, "conv_id long, turns array<struct<turn:long,role:string,text:string>>, nodes array<binary>")


def laid_out(convs: DataFrame, scratch: Scratch, ranges: int) -> DataFrame:
    """Distinct lines in depth-first order: leaf, range, k, nodes, turns and how many first nodes the line before has too.

    A line is the path of a conversation; its bytes order lines such that lines with a common start stand together, so a
    node is new in the first line that holds it.
    """
    lines = convs.groupBy(F.element_at("nodes", -1).alias("leaf")).agg(F.first("nodes").alias("nodes"), F.first("turns").alias("turns"))
    lines = lines.withColumn("path", F.array_join(F.transform("nodes", lambda x: F.hex(x)), ""))
    # written once: the ranges are then fixed, whatever is recomputed later
    lines = scratch.write(lines.repartitionByRange(ranges, "path").withColumn("range", F.spark_partition_id()), "lines")
    order = Window.partitionBy("range").orderBy("path")
    lines = lines.withColumn("k", F.row_number().over(order)).withColumn("prev", F.lag("nodes").over(order))
    # across a border the line before is the last one of the nearest range before: one line for each range
    last = sorted(lines.groupBy("range").agg(F.max_by("nodes", "path").alias("nodes")).collect(), key=lambda r: r["range"])
    border = [(b["range"], a["nodes"]) for a, b in zip(last, last[1:])]
    border = convs.sparkSession.createDataFrame(border, "range int, border array<binary>")
    lines = lines.join(F.broadcast(border), "range", "left").withColumn("prev", F.coalesce("prev", "border"))
    same = F.zip_with("nodes", F.coalesce("prev", F.array().cast("array<binary>")), lambda x, y: F.coalesce(x == y, F.lit(False)))
    differs = F.array_position(same, False)  # from 1; 0 if the line before holds this one whole, which cannot be
    return lines.withColumn("old", (F.when(differs > 0, differs - 1).otherwise(F.size("nodes"))).cast("int")).select("leaf", "range", "k", "nodes", "turns", "old")


def tokenized(lines: DataFrame, vocabulary: str) -> DataFrame:
    """Token ids of the new nodes of every line, by turn in three parts."""
    kind = pa.list_(pa.list_(pa.int32()))

    def run(batches):
        code = tokenizer(vocabulary)
        for batch in batches:
            parts = []
            for turns, old in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                parts.append([[code.encode(p, add_special_tokens=False).ids for p in render(t["role"], t["text"])] for t in turns[old:]])
            flat = [sum(len(i) for t in own for i in t) for own in parts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], batch.column(5), pa.array([[t["role"] == "assistant" for t in turns] for turns in batch.column(4).to_pylist()], pa.list_(pa.bool_())), pa.array(parts, pa.list_(kind)), pa.array(flat, pa.int64())], ["leaf", "range", "k", "nodes", "old", "loss", "ids", "n"])

    return lines.mapInArrow(run, "leaf binary, range int, k int, nodes array<binary>, old int, loss array<boolean>, ids array<array<array<int>>>, n long")


NODE = "node binary, parent binary, depth int, start long, end long, position long, attend array<struct<start:long,end:long>>, ids array<int>, loss_from int, loss_to int"


def placed(lines: DataFrame) -> DataFrame:
    """New nodes of every line with place, position and attention intervals; `before` are the places of its shared nodes."""

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {c.split()[0]: [] for c in NODE.split(", ") if " " in c}
            for r in batch.to_pylist():
                spans = sorted((x["depth"], x["start"], x["end"]) for x in r["before"] or [])
                attend: list[list[int]] = []
                position = 0

                def reach(a, b, attend=attend):
                    if attend and attend[-1][1] == a:  # touching intervals are one
                        attend[-1][1] = b
                    else:
                        attend.append([a, b])

                for _, a, b in spans:
                    reach(a, b)
                    position += b - a
                at = r["start"]
                for d, (head, body, end) in enumerate(r["ids"], start=r["old"]):
                    n = len(head) + len(body) + len(end)
                    row = (r["nodes"][d], r["nodes"][d - 1] if d else None, d, at, at + n, position, [{"start": a, "end": b} for a, b in attend], head + body + end, len(head), len(head) + (len(body) if r["loss"][d] else 0))
                    for c, v in zip(out, row, strict=True):
                        out[c].append(v)
                    reach(at, at + n)
                    at, position = at + n, position + n
            i64, span = pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = [pa.binary(), pa.binary(), pa.int32(), i64, i64, i64, span, pa.list_(pa.int32()), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))

    return lines.select("nodes", "old", "loss", "ids", "start", "before").mapInArrow(run, NODE)


def format_tree(rows: DataFrame, vocabulary: str, scratch: Scratch | None = None, ranges: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes, convs): emitted nodes, and for each conversation its path through them.

    nodes: node, parent, depth, start, end, position, attend (intervals of its ancestors, touching ones merged, so a chain
    has one), ids, loss_from, loss_to (offsets into ids). convs: conv_id, nodes.
    """
    spark = rows.sparkSession
    small_batches(spark)
    scratch = scratch or Scratch(spark, "chat")
    convs = scratch.write(chains(rows), "convs")
    lines = scratch.write(tokenized(laid_out(convs, scratch, ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))), vocabulary), "tokens")
    base, at = [], 0
    for r in sorted(lines.groupBy("range").agg(F.sum("n").alias("n")).collect()):  # one row for each range
        base.append((r["range"], at))
        at += r["n"]
    before = Window.partitionBy("range").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.join(F.broadcast(spark.createDataFrame(base, "range int, base long")), "range")
    lines = scratch.write(lines.withColumn("start", F.col("base") + F.coalesce(F.sum("n").over(before), F.lit(0))).drop("base"), "starts")
    # places of new nodes, and from them those of the nodes that a line shares with earlier ones
    sizes = F.transform("ids", lambda t: F.aggregate(t, F.lit(0).cast("long"), lambda a, p: a + F.size(p)))
    ends = F.aggregate(sizes, F.array(F.col("start")), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
    spots = lines.select("nodes", "old", ends.alias("ends")).select("nodes", "old", "ends", F.posexplode(F.slice("ends", 2, F.size("ends"))).alias("i", "end"))
    spots = spots.select(F.get("nodes", F.col("old") + F.col("i")).alias("node"), F.get("ends", F.col("i")).alias("start"), "end")
    shared = lines.where("old > 0").select("leaf", F.posexplode(F.slice("nodes", 1, F.col("old"))).alias("depth", "node"))
    shared = salted_join(shared, spots, "node", "leaf").groupBy("leaf").agg(F.collect_list(F.struct("depth", "start", "end")).alias("before"))
    return scratch.write(placed(lines.join(shared, "leaf", "left")), "nodes"), convs.select("conv_id", "nodes")


def read_back(nodes: DataFrame, convs: DataFrame, vocabulary: str) -> DataFrame:
    """Digests of every conversation, from the emitted tokens alone: decoded, unescaped, in path order."""

    def decode(batches):
        code = tokenizer(vocabulary)
        for batch in batches:
            roles, texts, losses, sizes = [], [], [], []
            for ids, a, b in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                ids = ids.values.to_pylist()
                whole = code.decode(ids, skip_special_tokens=False)
                role, text = parse(whole)
                roles.append(role), texts.append(text), sizes.append(len(whole))
                losses.append(unescape(code.decode(ids[a:b], skip_special_tokens=False)) if b > a else "")
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.string()) for x in (roles, texts, losses)), pa.array(sizes, pa.int64())], ["node", "role", "text", "loss", "chars"])

    said = nodes.select("node", "ids", "loss_from", "loss_to").mapInArrow(decode, "node binary, role string, text string, loss string, chars long")
    # equal conversations end in the same node: one of each line is read, and the digest joined to all
    ends = convs.withColumn("leaf", F.element_at("nodes", -1))
    lines = ends.groupBy("leaf").agg(F.first("nodes").alias("nodes")).select("leaf", F.posexplode("nodes").alias("k", "node"))
    told = salted_join(lines, said, "node", "leaf")
    turns = told.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("k", "role", "text", "loss", "chars"))).alias("t"))
    text = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("t", lambda x: x["loss"]), "")
    digest = turns.select(
        "leaf", F.size("t").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.aggregate("t", F.lit(0).cast("long"), lambda a, x: a + x["chars"]).alias("formatted_chars"),
    )
    return ends.select("conv_id", "leaf").join(digest, "leaf", "left").drop("leaf")
