"""Quality classifier: naive-Bayes features under a linear support vector machine.

Features are indicators of hashed word 1- and 2-grams and byte 3-grams. Class counts of all labelled learning rows
give each feature its log-count ratio; indicators scaled by these ratios, at unit length, train a linear model with
hinge loss by dual coordinate descent. Its margin becomes a probability by a logistic fit on rows left out of the descent.

The ratios cover all labelled learning rows; the descent and the logistic fit use at most `fit_rows` of them, those
with the smallest hash of the id, as long as their features stay within `fit_bytes`; of rows that repeat an id one teaches.

Defined cases: null and empty texts have no feature and get the score of the intercept; null labels teach nothing;
with one class only, or no labels, every score is that class's share or 0.5; repeated rows are scored as often as they
came; other columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .jaccard import bloomed
from .shared import dense_sum, small_batches

BITS = 18


def features(text: pa.Array):
    """Sorted distinct feature numbers of every row."""
    shift = np.uint64(64 - BITS)
    for lo, hi in K.chunks(text):
        data, offsets = K.utf8(text.slice(lo, hi - lo))
        h, at, _, _ = K.words(data, offsets)
        with np.errstate(over="ignore"):
            one, two = (K.mix(h + np.uint64(1)) >> shift).astype(np.int32), (K.shingle(h, 2) >> shift).astype(np.int32)
            wide = data.astype(np.uint64)
            tri = (K.mix((wide[:-2] << np.uint64(16)) | (wide[1:-1] << np.uint64(8)) | wide[2:] | np.uint64(1 << 32)) >> shift).astype(np.int32) if len(data) > 2 else one[:0]
        for k in range(hi - lo):
            a, b, c, d = at[k], at[k + 1], offsets[k], offsets[k + 1]
            yield np.unique(np.concatenate([one[a:b], two[a : max(a, b - 1)], tri[c : max(c, d - 2)]]))


class Model:
    """Weights by feature, their scale, and the logistic fit."""

    def __init__(self, ratio, weight, bias: float, slope: float, shift: float):
        self.square, self.weight = (ratio**2).astype(np.float32), (weight * ratio).astype(np.float32)
        self.bias, self.slope, self.shift = bias, slope, shift

    def margin(self, idx: np.ndarray) -> float:
        if not len(idx):
            return self.bias
        return float(self.weight[idx].sum(dtype=np.float64) / np.sqrt(self.square[idx].sum(dtype=np.float64) + 1e-12)) + self.bias

    def score(self, idx: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(idx) + self.shift, -40, 40))))


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float, epochs: int, seed: int = 3):
    """Weights and intercept of the hinge loss by dual coordinate descent, classes weighted to the same total."""
    w, bias = np.zeros(len(ratio)), 0.0
    values = []
    for r in rows:
        v = ratio[r]
        values.append(v / (np.sqrt((v * v).sum()) + 1e-6))
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    top = cost * share
    norm = np.array([(v * v).sum() + 1.0 for v in values])
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            r, v = rows[i], values[i]
            g = y[i] * (w[r] @ v + bias) - 1
            new = min(top[i], max(0.0, alpha[i] - g / norm[i]))
            if (step := (new - alpha[i]) * y[i]) != 0.0:
                w[r] += step * v
                bias += step
                worst = max(worst, abs(step))
                alpha[i] = new
        if worst < 1e-3:
            break
    return w, bias


def logistic(margin: np.ndarray, y01: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps on smoothed targets."""
    pos, neg = y01.sum(), (1 - y01).sum()
    t = np.where(y01 > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    x = np.stack([margin, np.ones(len(margin))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        grad = x.T @ (p - t) + 1e-6 * np.array([a, b])
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        da, db = np.linalg.solve(hess, grad)
        size = min(1.0, 5.0 / (abs(da) + abs(db) + 1e-12))
        a, b = a - size * da, b - size * db
        if abs(da) + abs(db) < 1e-8:
            break
    return (a, b) if a > 0 else (1.0, 0.0)


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int, fit_bytes: int, cost: float, epochs: int) -> Model:
    """`docs` has (doc_id, text) and `labels` (doc_id, label), both of the learning rows only."""
    # most texts without a label stay where they are; a merge join at every size, as labels grow with the documents
    both = bloomed(docs, labels.select("doc_id").where("doc_id is not null")).join(labels.hint("merge"), "doc_id").select("label", "doc_id", "text")
    size = 1 << BITS

    def count(batches):
        total = np.zeros(2 * size + 2)
        for batch in batches:
            for y, idx in zip(batch.column(0).to_pylist(), features(batch.column(2)), strict=True):
                total[idx + size * y] += 1
                total[2 * size + y] += 1
        return total

    total = dense_sum(both, count, 2 * size + 2)
    neg, pos = total[2 * size :]
    if not neg or not pos:
        share = pos / (neg + pos) if neg + pos else 0.5
        m = Model(np.zeros(size), np.zeros(size), 0.0, 1.0, 0.0)
        m.shift = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return m
    p, q = total[size : 2 * size] + 1, total[:size] + 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    ids = both.groupBy("doc_id").agg(F.max(F.octet_length("text")).alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).collect()
    fit, room = [], fit_bytes
    for r in ids:  # a text of n bytes has at most 2 n features, and 2**BITS different ones, of 4 bytes
        room -= 4 * min(2 * (r["n"] or 0), size)
        if room < 0 and fit:
            break
        fit.append((r["doc_id"],))
    some = F.broadcast(docs.sparkSession.createDataFrame(fit, "doc_id long").join(labels.groupBy("doc_id").agg(F.max("label").alias("label")), "doc_id"))  # at most fit_rows

    def rows(batches):
        for batch in batches:
            idx = [x.astype(np.int32) for x in features(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in idx], pa.binary())], ["label", "doc_id", "idx"])

    found = docs.join(some, "doc_id").select("label", "doc_id", "text").mapInArrow(rows, "label int, doc_id long, idx binary").groupBy("doc_id").agg(F.min(F.struct("label", "idx")).alias("x")).select("doc_id", "x.*").collect()
    found.sort(key=lambda r: r["doc_id"])
    x, y = [np.frombuffer(r["idx"], np.int32) for r in found], np.array([r["label"] for r in found])
    held = np.arange(len(x)) % 4 == 3
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        held[:] = False
    own = [v for v, h in zip(x, held, strict=True) if not h]
    w, bias = descend(own, np.where(y[~held] > 0, 1.0, -1.0), ratio, cost, epochs)
    model = Model(ratio, w, bias, 1.0, 0.0)
    check = held if held.any() else ~held
    model.slope, model.shift = logistic(np.array([model.margin(v) for v, c in zip(x, check, strict=True) if c]), y[check].astype(float))
    return model


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, threshold: float = 0.3, fit_rows: int = 6000, fit_bytes: int = 1 << 28, cost: float = 1.0, epochs: int = 12) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted). `docs` has (doc_id, text), `labels` (doc_id, label 0 or 1)."""
    small_batches(docs.sparkSession)
    out = F.crc32(F.col("doc_id").cast("string")) % folds == fold
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    labels = labels.where(F.col("label").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    model = docs.sparkSession.sparkContext.broadcast(learn(docs.where(~out), labels.where(~out), fit_rows, fit_bytes, cost, epochs))

    def run(batches):
        m = model.value
        for batch in batches:
            s = np.array([m.score(x) for x in features(batch.column(1))], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    scored = docs.mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "score", "predicted")
