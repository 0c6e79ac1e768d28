"""N-gram Jaccard join by a size-aware heavy-light split.

Documents are sets of word shingles, and two link when their Jaccard similarity reaches `num/den`.

1. Equal sets become one class (a 64-bit fingerprint of the sorted set together with its size), so exact copies
   are never paired.
2. All shingles get one global order, rare ones first. It comes from a fixed-size histogram of hash buckets over
   the whole corpus; any fixed order gives the same links, a good one only keeps the lists short.
3. Light sets (below the size boundary) list the 2-subsets of their 2-extended prefix: sets that overlap enough
   share at least two shingles there. Heavy sets use inverted lists over single prefix shingles, which sets down
   to `num/den` of the boundary also enter. The boundary is the size up to which enumerating subsets costs less
   than scanning the lists whose length the histogram tells. Each entry carries its place in its set's order: of two
   sets that link, the first shared shingles stand early enough in both for the rest to reach the overlap they need.
4. Families merge before lists are paired. Every set in a shared list has a few min-hashes, and meets one head of
   each min-hash group, the one that shares most keys; then, of each component in a list that still holds several, a
   few members, such ones and others drawn by hash, meet a few of the list's largest component, for some rounds. What is met is verified on the full sets, and components merge.
5. Of the lists that still hold several components, all members outside the largest one meet all members of
   other components whose sizes and places allow a link. So no link between two texts is lost, while a family
   of thousands of near copies, one component by then, costs no pair for each two.

Defined cases: null text, empty text and text without words have an empty set and link with nothing; fewer words
than the shingle size give one shingle; equal sets always link; repeated rows are returned as often as they came;
a null id gets a null component, while its text links others as any text does; other columns are ignored; an
empty table gives an empty result. The similarity must be over 1/2: below, a set of one shingle could link with two.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernel as K
from .shared import Scratch, components, merged_pieces, salted_join, small_batches

BITS = 23  # buckets of the histogram behind the shingle order: 8 MB as broadcast, whatever the corpus
BUCKETS, BLOCK = 1 << BITS, 1 << 15
OCTAVE = 10  # steps of its logarithmic scale
SKETCH = 4  # min-hashes of a set
HEADS = 4  # members drawn of each component in a list
ROUNDS = 3
HOT = 2000  # entries of a list that one task pairs
SHARES = 2  # of the keys, whose lists are made one share after another


def least(n: int, num: int, den: int) -> int:
    """Smallest size (and overlap) of a partner of a set of n."""
    return -((-num * n) // den)


def fingerprint(x: np.ndarray) -> int:
    """64 bits of a sorted set of shingle hashes, as a signed integer."""
    with np.errstate(over="ignore"):
        spread = K.mix(x + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64) ^ (K.mix(x ^ np.uint64(0x9E6C63D0676A9A99)).sum(dtype=np.uint64) << np.uint64(1))
        return int(K.mix(np.array([spread + np.uint64(len(x))]))[0].astype(np.int64))


def bucket(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - BITS)).astype(np.int64)


def sets_of(text: pa.Array, words: int):
    """(row, sorted distinct shingles) of every row."""
    for a, b in K.chunks(text):
        h, at, _, _ = K.words(*K.utf8(text.slice(a, b - a)))
        for i, x in enumerate(K.shingle_rows(h, at, words)):
            yield a + i, np.unique(x)


def profile(docs: DataFrame, words: int) -> DataFrame:
    """One row per document (its set's size and fingerprint), and per task the histogram in blocks."""

    names = ["doc_id", "rid", "n", "sig", "block", "counts"]

    def run(batches):
        total = np.zeros(BUCKETS, dtype=np.int32)
        for batch in batches:
            sizes, prints = [], []
            for _, x in sets_of(batch.column(2), words):
                total[bucket(x)] += 1  # within one set a bucket counts once
                sizes.append(len(x))
                prints.append(fingerprint(x) if len(x) else 0)
            none = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()), none.cast(pa.int32()), none.cast(pa.binary())], names)
        full = [k for k in range(BUCKETS // BLOCK) if total[k * BLOCK : (k + 1) * BLOCK].any()]
        for lo in range(0, len(full), 16):  # all blocks at once would be as large as the histogram
            blocks = full[lo : lo + 16]
            none = pa.nulls(len(blocks)).cast(pa.int64())
            task = pa.array([TaskContext.get().partitionId()] * len(blocks), pa.int64())  # in place of a size
            yield pa.RecordBatch.from_arrays([none, none, task, none, pa.array(blocks, pa.int32()), pa.array([shrunk(total[k * BLOCK : (k + 1) * BLOCK]) for k in blocks], pa.binary())], names)

    return docs.mapInArrow(run, "doc_id long, rid long, n long, sig long, block int, counts binary")


def shrunk(x: np.ndarray) -> bytes:
    """Counts of a block: places and counts where few differ from zero, else all counts, in one byte, four or eight."""
    at = np.flatnonzero(x)
    if x.max() > 255:
        return x.astype(np.int32 if x.max() < 1 << 31 else np.int64).tobytes()
    if 3 * len(at) < BLOCK:
        return at.astype(np.uint16).tobytes() + x[at].astype(np.uint8).tobytes()
    return x.astype(np.uint8).tobytes()


def added(total: np.ndarray, x: bytes) -> None:
    """Add what `shrunk` made of a block."""
    if len(x) < BLOCK:
        n = len(x) // 3
        total[np.frombuffer(x, np.uint16, n)] += np.frombuffer(x, np.uint8, n, 2 * n)
    else:
        total += np.frombuffer(x, dtype={1: np.uint8, 4: np.int32, 8: np.int64}[len(x) // BLOCK])


def histogram(profiles: DataFrame) -> np.ndarray:
    """Logarithmic loads of all buckets; BUCKETS bytes reach the driver."""

    def total(pieces):
        out = np.zeros(BLOCK)
        for x in pieces:
            added(out, x)
        return out

    level = lambda x: np.minimum(255, np.rint(np.log2(x + 1) * OCTAVE)).astype(np.uint8)
    parts = profiles.where("block is not null").select("block", F.col("n").alias("part"), F.col("counts").alias("sums"))
    out = np.zeros(BUCKETS, dtype=np.uint8)
    for r in merged_pieces(parts, lambda _, x: shrunk(total(x)), lambda _, x: level(total(x)).tobytes()).toLocalIterator():
        out[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["sums"], dtype=np.uint8)
    return out


def boundary(hist: np.ndarray, num: int, den: int, largest: int = 64) -> int:
    """The first size at which 2-subsets cost more than single-shingle lists.

    Costs are rows written plus list entries met: C(p+1, 2) for subsets, p * (1 + l) for lists, where p is the
    prefix length and l the mean relative load of the rarer quarter of shingles, the part that prefixes take.
    """
    counts = sum(np.bincount(hist[k : k + BLOCK], minlength=256) for k in range(0, len(hist), BLOCK))[1:]  # buckets of each level; no array of all loads
    if not counts.any():
        return 2
    load, cum = 2.0 ** (np.arange(1, 256) / OCTAVE) - 1, np.cumsum(counts)
    mass = np.cumsum(load * counts)
    last = int(np.searchsorted(mass, mass[-1] / 4))  # the level in which the rarer quarter ends
    rare = np.where(np.arange(255) < last, counts, 0)
    rare[last] = min(counts[last], max(1, np.ceil((mass[-1] / 4 - mass[last] + load[last] * counts[last]) / load[last])))
    median = load[np.searchsorted(cum, [(cum[-1] - 1) // 2, cum[-1] // 2], side="right")].mean()
    met = max(1.0, float((rare * load**2).sum() / (rare * load).sum()) / max(1.0, float(median)))
    n = 2
    while n < largest:
        p = n - least(n, num, den) + 1
        if p * (p + 1) / 2 > p * (1 + met):
            break
        n += 1
    return n


def shared_least(n: int, limit: int, num: int, den: int) -> int:
    """How many list keys of its own a set shares at least with a partner that is no smaller: prefixes are longer by that many, less one."""
    return 1 if n < limit else 1 + (n - least(n, num, den) + 1) // 8


def postings(docs: DataFrame, rank, limit: int, words: int, num: int, den: int, part: int = 0, parts: int = 1) -> DataFrame:
    """Rows (key, sig, n, pos) of every set: single prefix shingles, 2-subsets, or both, with their place in the set's order; of `parts` shares of the keys the given one."""

    def run(batches):
        order = rank.value
        for batch in batches:
            seen: set[int] = set()
            keys, sigs, sizes, places = [], [], [], []
            for _, x in sets_of(batch.column(0), words):
                n = len(x)
                if n < 2:  # a single shingle reaches the limit with its own copy only
                    continue
                sig = fingerprint(x)
                if sig in seen:  # copies in one batch: the later steps know them by the class
                    continue
                seen.add(sig)
                prefix = n - least(n, num, den) + 1
                light = n < limit
                x = x[np.lexsort((x, order[bucket(x)]))[: prefix + (1 if light else shared_least(n, limit, num, den) - 1)]]
                at = np.arange(len(x), dtype=np.int32)
                if light:
                    i, j = np.triu_indices(len(x), 1)
                    with np.errstate(over="ignore"):
                        keys.append(K.mix(x[i] * np.uint64(3) + K.mix(x[j])))
                    places.append((j - 1).astype(np.int32))  # of two shared shingles the second may stand one place later
                    sigs.append(np.full(len(i), sig, np.int64))
                    sizes.append(np.full(len(i), n, np.int32))
                    x = x[:prefix] if n >= least(limit, num, den) else x[:0]
                keys.append(x)
                places.append(at[: len(x)])
                sigs.append(np.full(len(x), sig, np.int64))
                sizes.append(np.full(len(x), n, np.int32))
                if sum(map(len, keys)) > 200_000:
                    yield flush(keys, sigs, sizes, places)
                    keys, sigs, sizes, places = [], [], [], []
            if keys:
                yield flush(keys, sigs, sizes, places)

    def flush(keys, sigs, sizes, places):
        key = np.concatenate(keys)
        own = key % np.uint64(parts) == part
        return pa.RecordBatch.from_arrays([pa.array(key[own].astype(np.int64)), *(pa.array(np.concatenate(v)[own]) for v in (sigs, sizes, places))], ["key", "sig", "n", "pos"])

    return docs.select("text").mapInArrow(run, "key long, sig long, n int, pos int")


def neighboured(rows: DataFrame, limit: int, num: int, den: int) -> DataFrame:
    """The rows (key, sig, n, pos) without copies that have a possible partner next to them in their list.

    One exchange by key serves the removal of copies and the look at each member's neighbours.
    """
    rows = rows.repartition("key").dropDuplicates(["key", "sig"])
    order = Window.partitionBy("key").orderBy("n", "sig")
    rows = rows.withColumns({f"{name}_{c}": f(c).over(order) for name, f in (("down", F.lag), ("up", F.lead)) for c in ("n", "pos")} | {"more": F.coalesce(F.lag("n", 2).over(order), F.lead("n", 2).over(order))})
    # members whose neighbours by size are too far off share this key with no possible partner
    near = (den * F.col("down_n") >= num * F.col("n")) | (den * F.col("n") >= num * F.col("up_n"))
    # a list of two is one pair: its places must allow as many shared keys as it needs
    two = F.col("more").isNull() & (F.col("down_n").isNull() | F.col("up_n").isNull())
    close = F.when(two, pair_fits(("n", "pos"), (F.coalesce("down_n", "up_n"), F.coalesce("down_pos", "up_pos")), limit, num, den)).otherwise(near)
    return rows.where(close).select("key", "sig", "n", "pos")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""
    a, b = sets.select(F.col("sig").alias("a"), F.col("items").alias("x")), sets.select(F.col("sig").alias("b"), F.col("items").alias("y"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y)
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                same = int((y[at] == x).sum())
                keep.append(den * same >= num * (both - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    whole = salted_join(salted_join(pairs, a, "a", "b"), b, "b", "a", keys=pairs)  # one set may meet very many
    return whole.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = K.WORDS, num: int = 3, den: int = 4) -> DataFrame:
    """Rows (doc_id, n_shingles, class_id, component_id): set size, smallest id with the same set, smallest id reachable."""
    if 2 * num <= den:
        raise ValueError("the similarity must be over 1/2")
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    small_batches(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.select("doc_id", F.coalesce("doc_id", F.xxhash64("text")).alias("rid"), "text")  # finds a text again, also without an id
    profiles = scratch.write(profile(docs, words), "profile")
    hist = histogram(profiles)
    limit = boundary(hist, num, den)
    rank = spark.sparkContext.broadcast(hist)
    members = scratch.write(profiles.where("block is null").select("doc_id", "rid", "n", "sig"), "members")
    scratch.drop("profile")

    # lists are made by shares of the keys, one after another, as what is shuffled and sorted for them takes most disk of all
    parts = [scratch.write(neighboured(postings(docs, rank, limit, words, num, den, k, SHARES), limit, num, den), f"lists-{k}") for k in range(SHARES)]
    lists = reduce(DataFrame.unionByName, parts)
    # a set that shares fewer keys than any pair of its size must share links with nothing
    enough = need_keys((-F.floor(F.lit(-num) * F.col("n") / den)).cast("int"), limit, num, den)
    busy = lists.groupBy("sig", "n").agg(F.count("*").alias("keys")).where(F.col("keys") >= enough).select("sig", "keys")
    lists = lists.join(busy, "sig")
    several = lists.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    shared = scratch.write(lists.join(several, "key", "left_semi"), "shared")
    scratch.drop(*(f"lists-{k}" for k in range(SHARES)))

    # whole sets of the classes that share enough keys
    first = members.where("n > 0").groupBy("sig").agg(F.min("rid").alias("rid"))
    keep = scratch.write(shared.select("sig").distinct().join(first, "sig").select("rid"), "wanted")
    sets = whole_sets(of_ids(docs.select(F.col("rid").alias("id"), "text"), keep.select(F.col("rid").alias("id"))), words)
    sets = scratch.write(sets.dropDuplicates(["sig"]), "sets")
    scratch.drop("wanted")

    # each set meets one head of each of its min-hash groups
    central = shared.groupBy("sig").agg((-F.max("keys")).alias("rank"))  # the member of a family that was edited least shares most keys
    sketch = sets.select("sig", "n", "sketch").join(central, "sig").select("sig", "n", "rank", F.posexplode("sketch").alias("r", "h")).select("sig", "n", "rank", F.xxhash64("r", "h").alias("group"))
    sketch = scratch.write(sketch, "sketch")  # read several times from here on: a plan that computes it each time has over a hundred exchanges
    head = sketch.groupBy("group").agg(F.min(F.struct("rank", F.xxhash64("sig", "group").alias("draw"), "sig", "n")).alias("head"), F.count("*").alias("m")).where("m > 1").select("group", "head")
    met = salted_join(sketch.join(head.select("group"), "group", "left_semi"), head, "group", "sig")
    met = met.where("sig <> head.sig").where(sizes_fit(F.col("n"), F.col("head.n"), num, den))
    met = scratch.write(met.select(F.least("sig", "head.sig").alias("a"), F.greatest("sig", "head.sig").alias("b")).distinct(), "met")
    links = scratch.write(verified(met, sets, num, den), "links-0")
    label = components(links, scratch, "c0")

    # of lists with several components, a few members of each meet a few of the largest one, drawn anew each round
    tagged = scratch.write(split(shared, label), "tagged-0")
    scratch.drop("shared", "sketch", "met", "links-0")
    for step in range(ROUNDS):
        draw = [F.xxhash64("sig", F.lit(step * HEADS + k)) for k in range(HEADS)]  # half of them members that share most keys
        draws = [F.min(F.struct((F.when(draw[k] % 2 == 0, -F.col("keys")).otherwise(0) if k % 2 else -F.col("keys") if k == 0 else F.lit(0)).alias("rank"), draw[k].alias("draw"), "sig", "n", "pos")) for k in range(HEADS)]
        heads = tagged.groupBy("key", "root").agg(F.array_distinct(F.transform(F.array(*draws), lambda x: x.dropFields("rank", "draw"))).alias("own"))
        heads = scratch.write(heads.select("key", "root", F.explode("own").alias("x")).select("key", "root", "x.*"), f"drawn-{step}")
        fresh = meet(heads, sets, num, den, scratch, f"heads-{step}", star=True)
        scratch.drop(f"drawn-{step}")
        if fresh.isEmpty():
            break
        label = merged(label, fresh, scratch, f"c1-{step}")
        tagged = scratch.write(split(tagged.drop("root"), label), f"tagged-{step + 1}")
        scratch.drop(f"tagged-{step}")

    # of lists that still have several, all members outside the largest component
    label = merged(label, meet(tagged, sets, num, den, scratch, "rest"), scratch, "c2")

    classes = members.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("class_id"))
    classes = classes.join(label.withColumnRenamed("id", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    roots = classes.groupBy("root").agg(F.min("class_id").alias("component_id"))
    classes = scratch.write(classes.join(roots, "root").select("sig", "class_id", "component_id"), "classes")
    scratch.keep("members", "classes")
    out = salted_join(members.where("n > 0"), classes, "sig", "rid").unionByName(members.where("n = 0"), allowMissingColumns=True)
    own = lambda c: F.when(F.col("doc_id").isNotNull(), F.coalesce(c, "doc_id")).alias(c)
    return out.select("doc_id", F.col("n").alias("n_shingles"), own("class_id"), own("component_id"))


def merged(label: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Labels (id, root) after more links (a, b) between sets: the components of the links between roots."""
    if links.isEmpty():
        return label
    ends = [label.select(F.col("id").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b")]
    roots = links.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    top = components(roots, scratch, name)
    old = label.join(top.select(F.col("id").alias("root"), F.col("root").alias("top")), "root", "left").select("id", F.coalesce("top", "root").alias("root"))
    return scratch.write(old.unionByName(top.join(label, "id", "left_anti").select("id", "root")), f"{name}-all")


def meet(tagged: DataFrame, sets: DataFrame, num: int, den: int, scratch: Scratch, name: str, star: bool = False) -> DataFrame:
    """Links (a, b) between members (key, root, sig, n, pos) of different components of a list.

    Members outside a list's largest component meet all whose sizes and places allow a link, so of two members one
    is outside it; with `star`, they meet that component's members only. A list of more than `HOT` entries is dealt
    over several tasks.
    """
    sizes = tagged.groupBy("key", "root").agg(F.count("*").alias("m"))
    lists = sizes.groupBy("key").agg(F.max(F.struct("m", "root")).alias("top"), F.sum("m").alias("all"), F.count("*").alias("roots")).where("roots > 1")
    lists = lists.select("key", F.col("top.root").alias("main"), F.ceil(F.col("all") / HOT).cast("int").alias("parts"))
    every = tagged.join(lists, "key")
    x = every.where("root <> main").select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), *(F.col(c).alias(f"{c}1") for c in ("root", "sig", "n", "pos")))
    y = every.select("key", F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int").alias("part"), (F.col("root") == F.col("main")).alias("main"), *(F.col(c).alias(f"{c}2") for c in ("root", "sig", "n", "pos")))
    if star:
        y = y.where("main")
    # the overlap that a pair needs, and the last place at which its first shared key can stand
    overlap = -F.floor(F.lit(-num) * (F.col("n1") + F.col("n2")) / (num + den))
    early = [F.col(f"pos{k}") <= F.col(f"n{k}") - overlap for k in (1, 2)]
    pairs = x.join(y, ["key", "part"]).where((F.col("root1") != F.col("root2")) & (F.col("main") | (F.col("sig1") < F.col("sig2"))) & sizes_fit(F.col("n1"), F.col("n2"), num, den) & early[0] & early[1])
    pairs = pairs.select(F.least("sig1", "sig2").alias("a"), F.greatest("sig1", "sig2").alias("b")).distinct()
    pairs = scratch.write(pairs.select("a", "b"), f"{name}-pairs")
    if pairs.isEmpty():
        return pairs
    return scratch.write(verified(pairs, sets, num, den), name)


def sizes_fit(n, m, num: int, den: int):
    return den * F.least(n, m) >= num * F.greatest(n, m)


def need_keys(n, limit: int, num: int, den: int):
    """`shared_least` of a size column: at least so many keys are shared by sets of which the smaller has n."""
    return F.when(n < limit, 1).otherwise(1 + F.floor((n + F.floor(F.lit(-num) * n / den) + 1) / 8))


def pair_fits(one, other, limit: int, num: int, den: int):
    """Whether two entries (size, place) of one key can be among the shared keys that `shared_least` counts for their sets."""
    (n, p), (m, q) = (tuple(F.col(c) if isinstance(c, str) else c for c in x) for x in (one, other))
    spare = need_keys(F.least(n, m), limit, num, den) - 1 + F.floor(F.lit(-num) * (n + m) / (num + den))  # keys counted less one, less the overlap needed
    return sizes_fit(n, m, num, den) & (p <= n + spare) & (q <= m + spare)


def split(shared: DataFrame, label: DataFrame) -> DataFrame:
    """Entries of the lists that hold more than one component, with the component's root."""
    tagged = shared.join(label.withColumnRenamed("id", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    mixed = tagged.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    return tagged.join(mixed, "key", "left_semi")


def whole_sets(docs: DataFrame, words: int) -> DataFrame:
    """(sig, n, items, sketch) of every text: its shingles and a few min-hashes."""
    names = ["sig", "n", "items", "sketch"]

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for _, x in sets_of(batch.column(0), words):
                if len(x):
                    with np.errstate(over="ignore"):
                        low = [int(K.mix(x + np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15)).min().astype(np.int64)) for k in range(SKETCH)]
                    rows.append((fingerprint(x), len(x), x.tobytes(), low))
                    held += x.nbytes
                if len(rows) >= 500 or held > 1 << 22:
                    yield flush(rows)
                    rows, held = [], 0
            yield flush(rows)

    def flush(rows):
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return docs.select("text").mapInArrow(run, "sig long, n int, items binary, sketch array<long>")


def of_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `docs` whose id is among `ids`.

    They move by id, also where the ids are few: after a broadcast join the filter and the UDF that reads the rows would share a stage, and each core
    hold two Python workers, which stay for the other stages.
    """
    return bloomed(docs, ids).join(ids.hint("merge"), "id", "left_semi")


def bloomed(docs: DataFrame, ids: DataFrame, bits: int = 1 << 24) -> DataFrame:
    """`docs` without most rows whose id is not among `ids`: a Bloom filter of a fixed size (2 MB) ahead of the exact join."""

    def mark(batches):
        seen = np.zeros(bits, dtype=bool)
        for batch in batches:
            h = K.mix(np.asarray(batch.column(0)).astype(np.uint64))
            seen[(h % np.uint64(bits)).astype(np.int64)] = True
            seen[((h >> np.uint64(32)) % np.uint64(bits)).astype(np.int64)] = True
        packed = np.packbits(seen).reshape(256, -1)
        full = [k for k in range(256) if packed[k].any()]
        task = pa.array([TaskContext.get().partitionId()] * len(full), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), task, pa.array([packed[k].tobytes() for k in full], pa.binary())], ["block", "part", "sums"])

    def either(_, pieces):
        return reduce(np.bitwise_or, (np.frombuffer(x, np.uint8) for x in pieces)).tobytes()

    table = np.zeros((256, bits // 8 // 256), dtype=np.uint8)
    for r in merged_pieces(ids.mapInArrow(mark, "block int, part int, sums binary"), either, either).toLocalIterator():
        table[r["block"]] = np.frombuffer(r["sums"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(table.reshape(-1))

    def test(batches):
        bit = shared.value
        for batch in batches:
            ids = batch.column(0)
            h = K.mix(np.asarray(ids.fill_null(0)).astype(np.uint64))
            ok = np.ones(len(h), dtype=bool)
            for x in (h % np.uint64(bits), (h >> np.uint64(32)) % np.uint64(bits)):
                x = x.astype(np.int64)
                ok &= (bit[x >> 3] >> (7 - (x & 7)).astype(np.uint8)) & 1 == 1
            yield batch.filter(pa.array(ok))

    return docs.mapInArrow(test, docs.schema)
