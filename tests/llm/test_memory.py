"""What a Python worker holds: one operator a stage, bounded arrays and batches, no workers of another kind."""

import importlib.util
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gazetta.llm import jaccard, langid


def test_rows_of_few_ids_move_by_id(spark):
    docs = spark.range(2000).select(F.col("id"), F.concat_ws(" ", *[F.col("id") + k for k in range(9)]).alias("text"))
    got = jaccard.of_ids(docs, docs.where("id % 500 = 0").select("id"))
    assert sorted(r["id"] for r in got.collect()) == [0, 500, 1000, 1500]
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()  # else the UDF that reads `got` runs beside the filter's


def test_fit_rows_start_no_workers(spark, monkeypatch):
    seen, own = [], F.broadcast
    monkeypatch.setattr(F, "broadcast", lambda df: seen.append(df) or own(df))
    docs = spark.createDataFrame([(k, t * 9, "ab"[k % 2]) for k, t in enumerate(["ta re mi ", "no ku sa "] * 9)], "doc_id long, text string, lang string")
    assert langid.learn(docs, 3000, 1 << 27, 4, 1, 0.5).langs == ["a", "b"]
    assert "ExistingRDD" not in (plan := seen[0]._jdf.queryExecution().executedPlan().toString()) and "LocalTableScan" in plan


def test_language_arrays_are_bounded():
    fresh = importlib.util.module_from_spec(spec := importlib.util.find_spec("gazetta.llm.langid"))
    spec.loader.exec_module(fresh)  # other tests set its STRETCH
    rng = np.random.default_rng(1)
    model = fresh.Model(list("abcd"), rng.normal(size=(1 << fresh.BITS, 4)).astype(np.float32), np.zeros(4), 1.0, 0.0)
    text = pa.array(["".join(map(chr, rng.integers(97, 123, 2000)))] * 1000)
    tracemalloc.start()
    try:
        model.logits(text)
        assert tracemalloc.get_traced_memory()[1] < 32 << 20
    finally:
        tracemalloc.stop()


class Held:
    """In place of a DataFrame: the function that would run over its batches."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, kind):
        return run


def test_batches_are_bounded(monkeypatch):
    monkeypatch.setattr(jaccard, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("One", (), {"partitionId": lambda self: 3})())}))
    text = pa.array([" ".join(map(str, range(k, k + 60_000))) for k in range(0, 2_400_000, 60_000)])
    ids = pa.array(range(len(text)), pa.int64())
    sets = list(jaccard.whole_sets(Held(), 5)([pa.RecordBatch.from_arrays([text], ["text"])]))
    assert sum(x.num_rows for x in sets) == len(text) and max(x.nbytes for x in sets) < 6 << 20
    blocks = [x for x in jaccard.profile(Held(), 5)([pa.RecordBatch.from_arrays([ids, ids, text], ["doc_id", "rid", "text"])]) if x.column(4).null_count == 0]
    assert [b for x in blocks for b in x.column(4).to_pylist()] == list(range(jaccard.BUCKETS // jaccard.BLOCK)) and max(x.num_rows for x in blocks) <= 16


def test_second_tokenizer_is_read_when_needed():
    pytest.importorskip("public_tokenizers")
    from gazetta.llm import packing
    from gazetta.llm.queries import tokenizer

    packing.encode.cache_clear()
    packing.plain.cache_clear()
    code = packing.encode(tokenizer("byte_bpe_50k.json"), True)
    assert code("plain words") and not packing.plain.cache_info().currsize
    assert code(" " * 20_000) and packing.plain.cache_info().currsize == 1
