"""The stages of the pipeline against brute force, with nulls, repeats and empty tables."""

import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
STAGES = dict(corpus_pipeline.STAGES)
KIND = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def prose(rng, n):
    return " ".join("".join(rng.choice("ta re mi no ku sa lo pe di vu".split()) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    own = [(k, prose(rng, 60), "aa", "s", 1, "x") for k in range(60)]
    item = prose(rng, 40)
    edited = own[5][1].split()
    edited[2] = "changed"
    own += [(100, own[5][1], "aa", "s", 1, "x"), (None, own[6][1], "aa", "s", 1, "x"), (101, " ".join(edited), "aa", "s", 1, "x")]  # copies of 5, of 6, and near 5
    own += [own[7], own[7]]  # repeated rows
    own += [(None, prose(rng, 30) + " " + item, "aa", "s", 1, "x"), (102, item.upper() + " " + prose(rng, 9), "aa", "s", 1, "x")]  # leaks
    own += [(None, prose(rng, 50), "aa", "s", 1, "x")] * 2 + [(103, "password = abcdefgh1 " + prose(rng, 50), "aa", "s", 1, "x"), (104, None, None, None, None, None), (105, "", "aa", "s", 0, "x"), (106, "12 34", "aa", "s", 5, "x")]
    return own, item


@pytest.fixture(scope="module")
def tables(spark, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows[0], KIND).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, rows[1]), (None, "x"), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, rows, tables):
    docs = spark.createDataFrame(rows[0], KIND)
    own = lambda x: sorted((str(r["doc_id"]), str(r["text"])) for r in x.collect())
    near = STAGES["near_copies"](spark, docs, tables)
    assert near.columns == docs.columns
    gone = {100, 101}
    want, seen = [], set()
    for i, t, *_ in rows[0]:
        if i in gone or (i is None and t == rows[0][6][1]) or (i, t) in seen:
            continue
        seen.add((i, t))
        want.append((str(i), str(t)))
    assert own(near) == sorted(want)
    clean = STAGES["benchmark_leaks"](spark, docs, tables)
    assert clean.columns == docs.columns
    assert own(clean) == sorted((str(i), str(t)) for i, t, *_ in rows[0] if rows[1] not in (t or "").lower())
    masked = STAGES["secrets"](spark, docs, tables)
    assert masked.columns == docs.columns and masked.count() == len(rows[0])
    assert {r["doc_id"]: r["text"] for r in masked.collect()}[103].startswith("[SECRET] ")
    kept = STAGES["language"](spark, docs, tables)
    assert kept.columns == docs.columns and not {104, 105, 106} & {r["doc_id"] for r in kept.collect()}
    assert kept.count() == len(rows[0]) - 3


def test_run(spark, rows, tables):
    got = corpus_pipeline.run(spark, tables).collect()
    ids = [r["doc_id"] for r in got if r["piece"] == 0]
    assert sorted(i for i in ids if i is not None) == [*range(60), 103] and ids.count(None) == 1
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 1024


def test_empty(spark, tmp_path):
    spark.createDataFrame([], KIND).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
