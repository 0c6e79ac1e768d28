"""Fits and placements against plain readings: log-count ratios, dual descent, averaged softmax steps, best fit by a list."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gazetta.llm import jaccard, langid, quality
from gazetta.llm.packing import Bins, cut

LETTERS = "ta re mi no ku sa lo pe di vu".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 3))) for _ in range(n))


def plain_descent(rows, y, ratio, cost, epochs, order):
    """The hinge loss in its dual, one multiplier after the other, on full vectors and with weights summed anew at each step."""
    x = np.zeros((len(rows), len(ratio) + 1))
    for k, r in enumerate(rows):
        x[k, r] = ratio[r]
        x[k, :-1] /= math.sqrt((x[k, :-1] ** 2).sum()) + 1e-6
        x[k, -1] = 1.0  # the intercept is a feature of every row
    top = [cost * len(y) * 0.5 / sum(v == own for v in y) for own in y]
    alpha = np.zeros(len(rows))
    for turn in range(epochs):
        moved = 0.0
        for i in order[turn]:
            w = (alpha * y) @ x
            new = min(top[i], max(0.0, alpha[i] - (y[i] * (w @ x[i]) - 1) / (x[i] @ x[i])))
            moved, alpha[i] = max(moved, abs(new - alpha[i])), new
        if moved < 1e-3:
            break
    w = (alpha * y) @ x
    return w[:-1], w[-1]


@pytest.mark.parametrize("cost", [0.1, 1.0, 10.0])
def test_descent_equals_a_plain_one(cost):
    dice = np.random.default_rng(4)
    ratio = dice.normal(size=60)
    rows = [np.unique(dice.integers(0, 60, dice.integers(1, 12))) for _ in range(50)] + [np.zeros(0, int)]
    y = np.where(dice.random(len(rows)) < 0.3, 1.0, -1.0)
    shuffles = np.random.default_rng(3)
    order = [shuffles.permutation(len(rows)) for _ in range(12)]
    w, bias = quality.descend(rows, y, ratio, cost, 12)
    want, want_bias = plain_descent(rows, y, ratio, cost, 12, order)
    assert np.allclose(w, want, atol=1e-6) and bias == pytest.approx(want_bias, abs=1e-6)


def test_ratios_of_learning_rows(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(k, prose(rng, rng.choice([0, 3, 30])), rng.randint(0, 1)) for k in range(150)] + [(7, "again mi", 1), (151, None, 0)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").where("crc32(cast(doc_id as string)) % 5 <> 0")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:150]] + [(151, 0)], "doc_id long, label int").where("crc32(cast(doc_id as string)) % 5 <> 0")
    seen, model = [], quality.Model
    monkeypatch.setattr(quality, "Model", lambda ratio, *rest: (seen.append(ratio), model(ratio, *rest))[1])
    quality.learn(docs, labels, 40, 1 << 20, 1.0, 2)
    truth = {i: y for i, _, y in rows[:150]} | {151: 0}
    counts = Counter()
    for i, text, _ in rows:
        if zlib.crc32(str(i).encode()) % 5:
            counts.update((truth[i], int(f)) for f in next(quality.features(pa.array([text or ""]))))
    size = 1 << quality.BITS
    total = [sum(counts[y, f] + 1 for f in range(size)) for y in (0, 1)]
    want = [math.log((counts[1, f] + 1) / total[1]) - math.log((counts[0, f] + 1) / total[0]) for f in range(size)]
    assert len(seen) == 1 and np.allclose(seen[0], want, atol=1e-6)


def test_features_of_a_text_are_its_own():
    rng = random.Random(2)
    texts = [prose(rng, n) for n in (1, 2, 5, 80)] + ["", "é", "ab", "  a  b "]
    for text, got in zip(texts, quality.features(pa.array(texts)), strict=True):
        assert got.tolist() == next(quality.features(pa.array([text]))).tolist()
    n_words, n_bytes = 5, len(texts[2].encode())
    assert len(next(quality.features(pa.array([texts[2]])))) <= 2 * n_words - 1 + n_bytes - 2


def plain_softmax(bags, y, n_langs, dim, epochs, rate, seed=1):
    """Mean of embeddings, softmax and gradient steps, n-gram by n-gram."""
    dice = np.random.default_rng(seed)
    emb, out, bias = dice.uniform(-1 / dim, 1 / dim, (1 << langid.BITS, dim)), np.zeros((dim, n_langs)), np.zeros(n_langs)
    own = [i for i in range(len(bags)) if len(bags) < 8 or i % 4 != 3]
    step = 0
    for _ in range(epochs):
        for i in dice.permutation(own):
            grams = list(zip(*bags[i], strict=True))
            if not grams:
                continue
            lr, step = rate * (1 - step / (epochs * len(own))), step + 1
            x = sum(share * emb[g] for g, share in grams)
            p = np.exp(x @ out + bias)
            error = p / p.sum() - (np.arange(n_langs) == y[i])
            back = out @ error
            for d in range(dim):
                for k in range(n_langs):
                    out[d, k] -= lr * x[d] * error[k]
            bias = bias - lr * 0.1 * error
            for g, share in grams:
                emb[g] -= lr * share * math.sqrt(len(grams)) * back
    return emb @ out, bias


def test_softmax_steps_equal_plain_ones():
    rng = random.Random(6)
    texts = [prose(rng, 4) if k % 2 else " ".join(rng.choice(["ösch", "ür", "äck"]) for _ in range(4)) for k in range(12)] + ["", "a"]
    bags = [langid.bag(np.frombuffer(t.encode(), np.uint8)) for t in texts]
    y = np.array([k % 2 for k in range(len(texts))])
    model = langid.train(bags, y, ["aa", "bb"], 4, 3, 0.5)
    table, bias = plain_softmax(bags, y, 2, 4, 3, 0.5)
    assert np.allclose(model.table, table, atol=1e-6) and np.allclose(model.bias, bias, atol=1e-9)


def test_bags_are_shares_of_subwords():
    text = "Straße no NO\tno"
    data = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in text.encode())
    want = Counter(data[k : k + n] for n in langid.GRAMS for k in range(len(data) - n + 1))
    idx, share = langid.bag(np.frombuffer(text.encode(), np.uint8))
    assert sorted(np.rint(share * sum(want.values())).astype(int).tolist()) == sorted(want.values())  # this text has no colliding subwords
    assert share.sum() == pytest.approx(1) and len(set(idx.tolist())) == len(idx)


def plain_best_fit(lengths, size, most):
    """Open bins in a list, in the order of their opening or last use; the least free space that holds a piece, the latest of equal ones."""
    bins, free, opened = [], {}, 0
    out = []
    for n in lengths:
        fits = [b for b in bins if free[b] >= n]
        if fits:
            own = min(reversed(fits), key=lambda b: free[b])
            bins.remove(own)
        else:
            own, free[opened], opened = opened, size, opened + 1
        out.append((own, size - free[own]))
        free[own] -= n
        if not free[own]:
            continue
        if len(bins) == most:
            fullest = min(reversed(bins), key=lambda b: free[b])
            if free[own] <= free[fullest]:
                continue
            bins.remove(fullest)
        bins.append(own)
    return out


@pytest.mark.parametrize("size,most", [(16, 1), (16, 3), (64, 8), (64, 1000)])
def test_placement_equals_a_plain_best_fit(size, most):
    rng = random.Random(size * most)
    for _ in range(30):
        lengths = [p for _ in range(rng.randint(1, 200)) for p in cut(rng.choice([1, rng.randint(1, size), rng.randint(1, 3 * size)]), size)]
        bins = Bins(size, most, 0)
        assert [bins.put(n) for n in lengths] == plain_best_fit(lengths, size, most)


def test_boundary_equals_the_one_of_all_loads():
    def plain(hist, num, den, largest=64):
        load = sorted(2.0 ** (h / jaccard.OCTAVE) - 1 for h in hist.tolist() if h)
        if not load:
            return 2
        rare, mass = [], 0.0
        while mass < sum(load) / 4:
            rare.append(load[len(rare)])
            mass += rare[-1]
        met = max(1.0, sum(x * x for x in rare) / sum(rare) / max(1.0, float(np.median(load))))
        n = 2
        while n < largest and (p := n - jaccard.least(n, num, den) + 1) * (p + 1) / 2 <= p * (1 + met):
            n += 1
        return n

    dice, seen = np.random.default_rng(1), set()
    for k in range(60):
        hist = np.minimum(255, dice.exponential(dice.uniform(1, 90), int(dice.integers(1, 3000)))).astype(np.uint8) * (k > 0)
        seen.add(jaccard.boundary(hist, 3, 4))
        assert jaccard.boundary(hist, 3, 4) == plain(hist, 3, 4)
    assert len(seen) > 3


def test_lists_of_two_keep_what_a_pair_needs(spark):
    """Of two sets that link, the shared keys that are counted stand where `pair_fits` allows them, in both."""
    from pyspark.sql import functions as F

    rng, num, den, limit = random.Random(9), 3, 4, 16
    rows, pair = [], 0
    for n in (16, 17, 30, 99, 400):
        for _ in range(12):
            a = rng.sample(range(10 * n), n)
            gone = rng.sample(a, rng.randint(0, n // 5))
            b = sorted(set(a) - set(gone) | set(rng.sample(range(10 * n, 12 * n), rng.randint(0, n // 8))))
            a, both = sorted(a), len(set(a) & set(b))
            if den * both < num * (len(a) + len(b) - both):
                continue
            most = jaccard.shared_least(min(len(a), len(b)), limit, num, den)
            for x in sorted(set(a) & set(b))[:most]:
                rows.append((pair, len(a), a.index(x), len(b), b.index(x)))
            pair += 1
    df = spark.createDataFrame(rows, "pair int, n int, p int, m int, q int")
    assert pair > 20 and df.where(~jaccard.pair_fits(("n", "p"), ("m", "q"), limit, num, den)).count() == 0
    apart = spark.createDataFrame([(20, 0, 30, 0), (100, 90, 100, 1), (100, 1, 100, 40)], "n int, p int, m int, q int")
    assert apart.where(jaccard.pair_fits(("n", "p"), (F.col("m"), F.col("q")), limit, num, den)).count() == 0
