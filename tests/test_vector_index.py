"""The stored vector index against brute force."""

from __future__ import annotations

import math
import re

import numpy as np

from cartolex.operators import search, vector_index


def rows(out):
    return [(r[0], r[1]) for r in out.collect()]


def test_recall_and_what_is_read(spark, tmp_path):
    rng = np.random.default_rng(2)
    x = np.repeat(rng.normal(size=(60, 24)), 50, 0) + rng.normal(size=(3000, 24)) * 0.3
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "list int, vector array<float>").repartition(4)
    path = str(tmp_path / "v")
    vector_index.write_index(df, "list", "vector", path, lists=32, parts=8)
    stored = spark.read.parquet(f"{path}/lists")
    assert stored.count() == 3000
    hits = 0
    for i in range(0, 3000, 500):
        q = df.where(f"list = {i}").first()["vector"]
        want = rows(search.vector_top_k(df, "list", "vector", q))
        assert rows(vector_index.search(spark, path, "list", q, probed=1.0, again=100)) == want
        got = rows(vector_index.search(spark, path, "list", q, probed=0.1))
        assert set(got) <= set(rows(search.vector_top_k(df, "list", "vector", q, 3000)))  # scores are exact
        hits += len(set(got) & set(want))
    assert hits >= 0.9 * 5 * 6
    plan = vector_index.search(spark, path, "list", x[0].tolist(), probed=0.1)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*list#\d+ IN", plan)


def test_odd_vectors(spark, tmp_path):
    odd = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]), (7, [1.0, 2.0, 3.0]), (8, [1e300, 0.0]), (9, [1e-300, 0.0]), (9, [0.0, 2.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(odd, "k int, v array<double>")
    path = str(tmp_path / "v")
    vector_index.write_index(df, "k", "v", path)
    assert sorted(str(r["key"]) for r in spark.read.parquet(f"{path}/lists").collect()) == ["8", "9", "9", "None"]
    assert [r[0] for r in vector_index.search(spark, path, "k", [1.0, 0.1], probed=1.0).collect()][:1] in ([8], [9])
    for q in ([], [0.0, 0.0], [1.0, 2.0, 3.0], [math.nan, 1.0], [None, 1.0]):
        out = vector_index.search(spark, path, "k", q)
        assert out.columns == ["k", "score"] and out.collect() == []
    empty = str(tmp_path / "none")
    vector_index.write_index(df.where("k = 1"), "k", "v", empty)
    assert vector_index.search(spark, empty, "k", [1.0, 0.0]).collect() == []


def test_all_lists_give_what_brute_force_gives(spark, tmp_path):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(rng.normal(size=(3000, 32)))], "k int, v array<float>").repartition(4)
    path = str(tmp_path / "v")
    vector_index.write_index(df, "k", "v", path, lists=8, parts=4)
    for i in range(4):  # without clusters, the best by code are seldom the best
        q = df.where(f"k = {i}").first()["v"]
        assert rows(vector_index.search(spark, path, "k", q, probed=1.0, again=2)) == rows(search.vector_top_k(df, "k", "v", q))
