"""Near-dedup of texts and of vectors against brute force; components; nearest neighbours."""

from __future__ import annotations

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartolex.llm import embedding_dedup, near_dedup, nearest, vectors, words
from cartolex.llm.components import connected_components


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_shingles_are_those_of_split_words():
    texts = ["A b\tc\x0bd e F", "one", "", "  ", None, "x " * 9, "é É a b c d e", "w" * 3_000_000 + " a b c d e f"]
    got = [s for _, part in words.distinct_shingles(pa.array(texts), 5) for s in part]
    assert [len(s) for s in got] == [len(shingle_set(t)) for t in texts]
    a, b = (next(words.distinct_shingles(pa.array([t]), 5))[1][0] for t in ("a b c d e f", "A  B\nc D e f"))
    assert (a == b).all()


def test_register_estimates_follow_similarity():
    rng = np.random.RandomState(1)
    for share in (0.3, 0.75, 0.95):
        every = rng.randint(1, 2**62, 3000).astype(np.uint64) * np.uint64(4) + np.uint64(1)
        both = int(3000 * share)
        a = np.sort(words.mix(np.concatenate([every[:both], every[both : both + (3000 - both) // 2]])))
        b = np.sort(words.mix(np.concatenate([every[:both], every[both + (3000 - both) // 2 :]])))
        r = near_dedup.registers([a, b])
        about, _ = near_dedup.estimate(r[:1], r[1:], np.array([len(a)]), np.array([len(b)]))
        assert abs(about[0] - share) < 0.2


def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    common = [rng.choice(vocabulary) for _ in range(60)]
    docs = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 7, 20, 90, 400]))]
        docs.append(base)
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, len(base) // 25])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(copy)
    docs += [common + [rng.choice(vocabulary) for _ in range(rng.randint(20, 60))] for _ in range(40)]
    texts = [" ".join(d) for d in docs] + ["", None, " \n", "Z", "z", docs[0][0].upper()]
    rng.shuffle(texts)
    return texts


def test_near_duplicates_equal_brute_force(spark):
    texts = corpus()
    sets = [shingle_set(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = components(len(sets), links)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, component_id string")
    got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()}
    assert got == {i: (len(s), want[i], want[i] == i) for i, s in enumerate(sets)}
    kept = near_dedup.keep_first(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i in range(len(texts)) if want[i] == i)


def test_near_duplicates_of_odd_tables(spark):
    schema = "doc_id long, text string"
    assert near_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None)]
    got = sorted(((r.id, r.component_id, r.kept) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (None, None, True), (None, None, True)], key=str)
    assert near_dedup.keep_first(spark.createDataFrame(rows, schema)).count() == 3


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (139, 138), (139, 138)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(21)} | {k: 100 for k in range(100, 140)}
    assert connected_components(spark.createDataFrame([("b", "a"), ("c", "b")], "src string, dst string")).where("component = 'a'").count() == 3
    assert connected_components(df.where("src is null")).count() == 0


def vector_rows(n=260, dim=16, seed=2):
    rng = np.random.RandomState(seed)
    x = rng.randn(n, dim).astype(np.float32)
    for i in range(0, n, 4):  # near copies, exact copies and multiples
        x[i + 1] = x[i] + 0.15 * rng.randn(dim).astype(np.float32)
        x[i + 2] = x[i] if i % 8 else 2 * x[i]
    x[40:80] = x[40] + 0.02 * rng.randn(40, dim).astype(np.float32)
    rows = [(i, [float(v) for v in r], 1) for i, r in enumerate(x)]
    odd = [None, [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] + [1.0] * (dim - 1), [float("inf")] + [1.0] * (dim - 1), [], [1.0, 2.0]]
    return x.astype(np.float64), rows + [(n + i, v, 2) for i, v in enumerate(odd)]


@pytest.mark.parametrize("block", [1024, 16])
def test_embedding_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    x, rows = vector_rows()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    want = components(len(rows), np.argwhere(near).tolist())
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, links int")
    got = {r.id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {i: (int(near[i].sum()) if i < len(x) else 0, want[i], want[i] == i) for i in range(len(rows))}


def test_embedding_duplicates_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = embedding_dedup.near_duplicates(spark.createDataFrame([(None, [1.0]), (3, [1.0]), (2, [1.0]), (9, None)], schema)).collect()
    assert sorted(((r.id, r.n_links, r.component_id, r.kept) for r in got), key=str) == sorted([(None, 0, None, True), (3, 1, 2, False), (2, 1, 2, True), (9, 0, 9, True)], key=str)


@pytest.mark.parametrize("bucket", [nearest.BUCKET, 1])
def test_nearest_against_brute_force(spark, bucket):
    x, rows = vector_rows(seed=4)
    u = vectors.unit(x)
    df = spark.createDataFrame([*rows, rows[5]], "vec_id long, embedding array<float>, score int")
    got: dict[int, list] = {}
    for r in nearest.search(df, F.col("vec_id") % 10 == 0, k=5, bucket=bucket).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    assert sorted(got) == list(range(0, len(x), 10))
    for q, found in got.items():
        exact = vectors.cosines(np.repeat(u[q : q + 1], len(u), 0), u)
        order = [i for i in np.lexsort((np.arange(len(u)), -exact)) if i != q][:5]
        assert [rank for rank, *_ in found] == [1, 2, 3, 4, 5]
        assert all(score == exact[i] for _, i, score in found)
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        hits += len(set(order) & {i for _, i, _ in found})
        total += 5
    assert hits / total >= 0.9


def test_cells_grow_with_rows():
    assert [nearest.axes(64, n, 1024) for n in (0, 131072, 131073, 600000, 10**7, 10**9)] == [[128], [128], [128, 2], [128, 8], [128, 128], [128, 128, 64]]
    assert nearest.axes(1, 10, 1) == [2, 2, 2, 2]
    assert [nearest.probes_of(c, 14) for c in (2, 128, 256, 4096)] == [14, 14, 24, 189]


def test_nearest_cells_are_those_of_all_cells():
    """Cells found one rotation after another, against the gaps of every cell."""
    x = vectors.unit(np.random.RandomState(3).randn(20, 8))
    widths = [16, 16, 4]
    for rotated in nearest.rotations(x, 2, 3, 5):
        gaps = []
        for y, w in zip(rotated, widths, strict=True):
            s = np.concatenate([y[:, : w // 2], -y[:, : w // 2]], 1)
            gaps.append((s.max(1, keepdims=True) - s) ** 2)
        every = (gaps[0][:, :, None, None] + gaps[1][:, None, :, None] + gaps[2][:, None, None, :]).reshape(len(x), -1)
        found = nearest.nearest_cells(rotated, widths, 30)
        assert all(len(set(line)) == 30 for line in found.tolist())
        assert (np.take_along_axis(every, found, 1) == np.sort(every, axis=1)[:, :30]).all()
        assert (nearest.nearest_cells(rotated, widths, 1)[:, 0] == every.argmin(1)).all()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
@pytest.mark.parametrize("bucket", [nearest.BUCKET, 8])
def test_recall_on_the_given_vectors(spark, bucket):
    """At least 0.9 of the five nearest, with the registered cells and with twice as many."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.where(vectors.usable(F.col("embedding"))).orderBy("vec_id").collect()
    ids, u = np.array([r.vec_id for r in rows]), vectors.unit(np.array([r.embedding for r in rows], float))
    got: dict[int, set] = {}
    for r in nearest.search(df, F.col("vec_id") % 50 == 0, bucket=bucket).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for at in np.flatnonzero(ids % 50 == 0):
        best = [j for j in np.argsort(-(u @ u[at]), kind="stable") if j != at][:5]
        hits.append(len(got[ids[at]] & set(ids[best].tolist())))
    assert len(got) == len(hits) and sum(hits) >= 0.9 * 5 * len(hits)


def test_nearest_in_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [-1.0, 0.0]), (50, None), (None, [1.0, 0.0])], schema)
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in nearest.search(df, F.col("vec_id") % 50 == 0).orderBy("rank").collect()] == [(0, 1, 1, 1.0), (0, 2, 2, -1.0)]
    assert nearest.search(spark.createDataFrame([], schema), F.lit(True)).count() == 0


def test_near_duplicates_of_one_large_group(spark, monkeypatch):
    """Components met by probes, in one block or several, equal those of brute force."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    texts = []
    for _ in range(150):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(9000)}"
        texts.append(" ".join(copy))
    sets = [shingle_set(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = components(len(sets), links)
    assert 1 < len(set(want)) < 100
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for held in (near_dedup.PROBE_SHINGLES, 1000):
        monkeypatch.setattr(near_dedup, "PROBE_SHINGLES", held)
        got = {r.id: r.component_id for r in near_dedup.near_duplicates(df).collect()}
        assert got == dict(enumerate(want))


def test_probes_take_the_place_of_many_pairs():
    ids, label = np.arange(12) * 10, np.array([0] * 10 + [100, 110])
    rows = near_dedup._pairs_and_probes(ids, label, np.array([*range(10), 10, 3]), np.array([10] * 10 + [11, 11])).to_pylist()
    assert sorted((r["a"], r["b"], r["target"]) for r in rows if r["target"] is None) == [(30, 110, None), (100, 110, None)]
    assert [r for r in rows if r["target"] is not None] == [{"a": 100, "b": None, "target": 0}]


def test_rows_that_repeat_an_id_have_one_component(spark):
    words_of = lambda k: " ".join(f"{k}{i}" for i in range(12))
    rows = [(5, words_of("a")), (5, words_of("b")), (1, words_of("a")), (2, words_of("b")), (5, None), (7, words_of("c")), (7, words_of("b") + " x"), (8, ""), (8, None), (9, None), (9, words_of("d"))]
    got = {(r.id, r.n_shingles): (r.component_id, r.kept) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: v[0] for k, v in got.items()} == {(5, 8): 1, (1, 8): 1, (2, 8): 1, (5, 0): 1, (7, 8): 1, (7, 9): 1, (8, 0): 8, (9, 0): 9, (9, 8): 9}
    kept = near_dedup.keep_first(spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept_id", F.lit("own")).withColumn("_kept", F.lit(3)))
    assert sorted((r.doc_id, r.kept_id) for r in kept.collect()) == [(1, "own"), (8, "own"), (9, "own")]
