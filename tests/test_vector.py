"""Vector top-k: ties, blocks of rows, and the memory of a task."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa

from kgspark.operators import vector


def test_first_k_takes_ties_by_id():
    rng = np.random.default_rng(1)
    for width in (1, 3, 40):
        score, ids = rng.integers(0, 4, (5, width)).astype(float), np.tile(rng.permutation(width), (5, 1))
        got = vector._first_k(ids, score, 3)
        for r in range(5):
            want = sorted(zip(-score[r], ids[r]))[:3]
            assert [(-s, i) for i, s in zip(got[0][r], got[1][r])] == want


def test_top_k_against_brute_force_in_small_steps(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.integers(-2, 3, (300, 4)).astype(np.float32)
    rows = spark.createDataFrame(pd.DataFrame({"id": np.arange(300), "embedding": list(x.tolist())}), "id long, embedding array<float>").repartition(3)
    asked = rows.where("id % 25 = 0").withColumnRenamed("id", "query")
    monkeypatch.setattr(vector, "_SCORES", 64)
    got = {}
    for r in vector.top_k(rows, asked, 5, block=4).collect():
        got.setdefault(r["query"], {})[r["rank"]] = (r["score"], r["id"])
    u = x.astype(float) / np.maximum(np.linalg.norm(x.astype(float), axis=1, keepdims=True), 1e-12)
    for q in range(0, 300, 25):
        want = sorted((-round(float(s), 6), i) for i, s in enumerate(np.round(u @ u[q], 6)))[:5]
        assert [got[q][i] for i in range(1, 6)] == [(-s, i) for s, i in want]


def test_a_task_holds_few_scores(spark, monkeypatch):
    """A batch of rows against many queries is scored in steps."""
    kept = []
    asked = spark.range(2000).selectExpr("id AS query", "array(float(id + 1), 1f) AS embedding")
    monkeypatch.setattr(type(asked), "mapInArrow", lambda self, f, schema: kept.append(f) or self.limit(0).selectExpr("0L AS query", "id", "0D AS score"))
    vector.top_k(asked.withColumnRenamed("query", "id"), asked, 3)
    x = np.random.default_rng(3).random((10_000, 2)).astype(np.float32)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(10_000)), pa.ListArray.from_arrays(np.arange(0, 20_001, 2, dtype=np.int32), pa.array(x.ravel()))], names=["id", "embedding"])
    tracemalloc.start()
    out = list(kept[0](iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in out) == 6000 and most < 200 << 20
