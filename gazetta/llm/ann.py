"""Approximate nearest neighbours by largest inner product: multiprobe p-stable hashing with exact reranking.

Vectors are lifted by one coordinate so that the largest inner product becomes the smallest Euclidean distance,
then hashed by `tables` groups of Gaussian projections cut into cells of one width. A query visits, in every
table, its own bucket and then perturbed buckets in the order of estimated success: perturbations are ranked by
the summed squared distances to the cell borders they cross. All table candidates are scored exactly, in double
precision, on the original vectors, and merged.

How fine the cells are and how many buckets are visited is fitted on a bounded sample (`fit_rows` vectors) to a
target recall; every vector is indexed. Equal vectors form one class that is indexed once; a class stands for its
smallest ids, which is all that a top-k with ties to smaller ids can show. A bucket is cut into blocks of bounded
size on both sides, so a hot bucket becomes many tasks.

Defined cases: vectors that are null, zero, hold null or non-finite components or have another length than most
take no part, neither as query nor as candidate; a query with fewer found candidates returns those; ties go to
the smaller id; a repeated id stands once; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

SIDE = 2048  # rows of a block on either side


def clean(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows (id, dim, vec as bytes of doubles, class digest, norm) of the vectors that take part."""

    def run(batches):
        for batch in batches:
            ids, dims, vecs, keys, norms = [], [], [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                v = v.values if v.is_valid else None
                if i is None or v is None or not len(v) or v.null_count:
                    continue
                x = np.asarray(v, dtype=np.float64) + 0.0  # -0.0 becomes 0.0
                most = float(np.abs(x).max())
                if not np.isfinite(most) or most == 0:
                    continue
                norm = min(most * float(np.linalg.norm(x / most)), np.finfo(np.float64).max)  # squares of large and small components would leave the range
                ids.append(i), dims.append(len(x)), vecs.append(x.tobytes()), norms.append(norm)
                keys.append(hashlib.blake2b(vecs[-1], digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary()), pa.array(keys, pa.binary()), pa.array(norms, pa.float64())], ["id", "dim", "vec", "class", "norm"])

    return df.select(F.col(id_col).cast("long"), F.col(vec_col)).mapInArrow(run, "id long, dim int, vec binary, class binary, norm double")


class Hashing:
    def __init__(self, dim: int, tables: int, k: int, width: float, probes: int, scale: float, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.tables, self.k, self.width, self.probes, self.scale = tables, k, width, probes, scale
        self.a, self.b = rng.normal(size=(dim + 1, tables * k)), rng.uniform(0, width, tables * k)

    def place(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Positions in cells, rows x tables x k."""
        if query:
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            last = np.zeros((len(x), 1))
        else:
            x = x / self.scale
            last = np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))
        return ((np.hstack([x, last]) @ self.a + self.b) / self.width).reshape(len(x), self.tables, self.k)

    @staticmethod
    def names(cells: np.ndarray) -> np.ndarray:
        """A 64-bit name of each cell vector along the last axis."""
        from .kernel import mix

        out = np.zeros(cells.shape[:-1], dtype=np.uint64)
        for j in range(cells.shape[-1]):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + cells[..., j].astype(np.int64).astype(np.uint64))
        return out.astype(np.int64)

    def visits(self, place: np.ndarray) -> list[np.ndarray]:
        """For one query and table the cells to visit, in the order of estimated success."""
        base = np.floor(place).astype(np.int64)
        down = place - base
        cost = np.concatenate([down**2, (1 - down) ** 2])
        order = np.argsort(cost, kind="stable")
        cost, k = cost[order].tolist(), len(place)
        out, heap = [base], [(cost[0], (0,))]
        while heap and len(out) < self.probes:
            total, steps = heapq.heappop(heap)
            which = [int(order[s]) for s in steps]
            if len({w % k for w in which}) == len(which):
                cell = base.copy()
                for w in which:
                    cell[w % k] += 1 if w >= k else -1
                out.append(cell)
            last = steps[-1]
            if last + 1 < len(cost):
                heapq.heappush(heap, (total + cost[last + 1], (*steps, last + 1)))
                heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*steps[:-1], last + 1)))
        return out


def fit(sample: np.ndarray, rows: int, scale: float, k_near: int, tables: int, target: float) -> Hashing:
    """The setting that visits fewest candidates among those whose recall on the sample reaches the target.

    The neighbours of a sample vector within the sample lie at least as far away as its neighbours among all
    rows, so the estimate errs on the safe side.
    """
    rng = np.random.default_rng(5)
    ask = rng.permutation(len(sample))[:64]
    scores = sample[ask] @ sample.T
    scores[np.arange(len(ask)), ask] = -np.inf
    near = np.argsort(-scores, axis=1)[:, : max(1, min(len(sample) - 1, round(k_near * len(sample) / max(rows, 1))))]
    best = None
    for k in (2, 3, 4, 6, 8, 12, 16):
        for width in (1.0, 1.5):
            for probes in (6, 24):
                h = Hashing(sample.shape[1], tables, k, width, probes, scale)
                cells = h.names(np.floor(h.place(sample, False)))
                place = h.place(sample[ask], True)
                hit, seen = [], []
                for q in range(len(ask)):
                    mark = np.zeros(len(sample), dtype=bool)
                    for t in range(tables):
                        mark |= np.isin(cells[:, t], h.names(np.array(h.visits(place[q, t]))))
                    hit.append(mark[near[q]].mean())
                    seen.append(mark.mean())
                if (recall := float(np.mean(hit))) >= target and (best is None or np.mean(seen) < best[0]):
                    best = (float(np.mean(seen)), h)
                if recall >= target:
                    break  # more probes only cost more
    return best[1] if best else Hashing(sample.shape[1], 1, 1, 1e12, 1, scale)  # one cell: all vectors are visited


def nearest(df: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", tables: int = 6, target: float = 0.96, fit_rows: int = 2000) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for every id divisible by `every` its k best found neighbours."""
    spark = df.sparkSession
    scratch = Scratch(spark, "ann")
    one = F.min(F.struct("vec", "dim", "class", "norm")).alias("x")  # of different vectors with one id that with the smallest bytes
    good = scratch.write(clean(df, id_col, vec_col).groupBy("id").agg(one).select("id", "x.dim", "x.vec", "x.class", "x.norm"), "clean")
    dims = good.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not dims:
        return empty
    good = good.where(F.col("dim") == dims[0]["dim"])
    classes = good.groupBy("class").agg(F.min("id").alias("rep"), F.max(F.col("id") % every == 0).alias("asks"), F.first("vec").alias("vec"), F.first("norm").alias("norm"))
    classes = scratch.write(classes, "classes")
    stats = classes.agg(F.max("norm"), F.count("*")).first()
    rows = classes.orderBy(F.xxhash64("rep"), "rep").select("vec").limit(fit_rows).collect()
    hashing = fit(np.stack([np.frombuffer(r["vec"]) for r in rows]), stats[1], stats[0], k, tables, target)
    shared = spark.sparkContext.broadcast(hashing)  # its size depends on the dimension only

    def spread(query: bool):
        def run(batches):
            h = shared.value
            for batch in batches:
                for lo in range(0, len(batch), 512):
                    part = batch.slice(lo, 512)
                    place = h.place(np.stack([np.frombuffer(v.as_buffer()) for v in part.column(1)]), query)
                    if query:
                        cells = [[np.unique(h.names(np.array(h.visits(place[i, t])))) for t in range(h.tables)] for i in range(len(part))]
                        at = [(i, t, c) for i, own in enumerate(cells) for t, found in enumerate(own) for c in found.tolist()]
                    else:
                        names = h.names(np.floor(place))
                        at = [(i, t, c) for i, own in enumerate(names.tolist()) for t, c in enumerate(own)]
                    i, t, c = (np.array(x) for x in zip(*at, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(c, pa.int64()), part.column(0).take(pa.array(i)), part.column(1).take(pa.array(i))], ["t", "cell", "rep", "vec"])

        return run

    kind = "t int, cell long, rep long, vec binary"
    index = classes.select("rep", "vec").mapInArrow(spread(False), kind)
    asked = classes.where("asks").select("rep", "vec").mapInArrow(spread(True), kind)
    index, asked = scratch.write(index, "index"), scratch.write(asked, "asked")
    blocks = lambda x, name: x.groupBy("t", "cell").agg(F.ceil(F.count("*") / SIDE).cast("int").alias(name))
    size = blocks(index, "nc").join(blocks(asked, "nq"), ["t", "cell"])
    piece = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    other = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    index = index.join(size, ["t", "cell"]).withColumn("c", piece("nc")).withColumn("q", other("nq")).select("t", "cell", "q", "c", "rep", "vec")
    asked = asked.join(size, ["t", "cell"]).withColumn("q", piece("nq")).withColumn("c", other("nc")).select("t", "cell", "q", "c", "rep", "vec")
    most = k + 1  # the query's own class may stand for the query alone

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"q": [], "rep": [], "score": []}).astype({"q": "int64", "rep": "int64", "score": "float64"})
        x, y = (np.stack([np.frombuffer(v) for v in d["vec"]]) for d in (left, right))
        ids = right["rep"].to_numpy()
        found = []
        for lo in range(0, len(x), 256):
            s = x[lo : lo + 256] @ y.T
            edge = np.partition(s, max(0, s.shape[1] - most), axis=1)[:, max(0, s.shape[1] - most)]
            i, j = np.nonzero(s >= edge[:, None] - 1e-12 * np.abs(edge[:, None]))
            exact = np.einsum("ij,ij->i", x[lo + i], y[j])
            found.append(pd.DataFrame({"q": left["rep"].to_numpy()[lo + i], "rep": ids[j], "score": exact}))
        out = pd.concat(found)
        return out.sort_values(["q", "score", "rep"], ascending=[True, False, True]).groupby("q").head(most)

    keys = ["t", "cell", "q", "c"]
    pairs = asked.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInPandas(score, "q long, rep long, score double")
    pairs = pairs.groupBy("q", "rep").agg(F.max("score").alias("score"))
    top = pairs.withColumn("k", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "rep"))).where(F.col("k") <= most)
    top = scratch.write(top.select("q", "rep", "score"), "top")
    # the smallest ids of each class: no more than these can be among the k best of any query
    reps = classes.select("class", "rep")
    low = good.select("class", "id").withColumn("k", F.row_number().over(Window.partitionBy("class").orderBy("id"))).where(F.col("k") <= most)
    low = low.join(reps, "class").select("rep", "id")
    best = top.join(low, "rep").withColumn("k", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).where(F.col("k") <= most)
    best = best.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("k", "id", "score"))).alias("best"))  # at most k + 1 of each class
    asks = good.where(F.col("id") % every == 0).join(reps, "class").select(F.col("id").alias("query_id"), F.col("rep").alias("q"))
    own = asks.join(best, "q").withColumn("best", F.slice(F.expr("filter(best, x -> x.id <> query_id)"), 1, k))
    out = own.select("query_id", F.posexplode("best").alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
    scratch.drop("index", "asked")
    return out
