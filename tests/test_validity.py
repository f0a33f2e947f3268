"""As-of joins and validity against plain versions."""

from __future__ import annotations

import random

import pytest

from cartolex.operators import validity


@pytest.mark.parametrize("strict", [False, True])
def test_as_of_equals_a_plain_version(spark, strict):
    rng = random.Random(6)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    left = [(i, key(), rng.choice([None, *range(20)]), "l") for i in range(400)]
    right = [(key(), rng.choice([None, *range(2, 22, 3)]), rng.choice([None, 1, 2, 3]), f"r{i}") for i in range(60)] + [("c", 1, 1, "x")]
    a = spark.createDataFrame(left, "i int, k string, t int, own string").repartition(5)
    b = spark.createDataFrame(right, "k string, u int, v int, w string")
    for n in (60, 0):
        some = spark.createDataFrame(right[:n], b.schema)
        out = validity.as_of(a, some, "k", "t", "u", ["v", "w"], strict)
        assert out.columns == ["i", "k", "t", "own", "v", "w"]
        got = {r.i: (r.v, r.w) for r in out.collect()}
        assert len(got) == 400
        for i, k, t, _ in left:
            fit = [(u, v if v is not None else -1, w) for x, u, v, w in right[:n] if x is not None and x == k and u is not None and t is not None and (u < t if strict else u <= t)]
            _, v, w = max(fit) if fit else (None, None, None)
            assert got[i] == (None if v == -1 else v, w), (i, k, t)


def test_validity_of_chains(spark):
    docs = spark.createDataFrame([("a", 1), ("b", None), ("c", 5), ("d", 9), ("x", 3), ("y", 4), ("late", 8), ("new", 2), ("z", None)], "documentId string, issued int")
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "c"), ("x", "y"), ("y", "x"), ("new", "late"), ("gone", "z"), (None, "a"), ("d", None)], "src string, dst string")
    out = {r.documentId: (r.validFrom, r.validUntil) for r in validity.validity(docs, edges).collect()}
    assert out == {"a": (1, 5), "b": (None, 5), "c": (5, 9), "d": (9, None), "x": (3, 4), "y": (4, 3), "late": (8, 2), "new": (2, None), "z": (None, None)}
    on = lambda day: sorted(r.documentId for r in validity.valid_on(validity.validity(docs, edges), day).collect())
    assert on(1) == ["a"] and on(5) == ["c", "new"] and on(9) == ["d", "new"] and on(0) == []


def test_validity_keeps_no_pair_of_every_chain(spark, monkeypatch):
    rng = random.Random(3)
    up = {(i + 1, i) for i in range(63)} | {(rng.randrange(64), rng.randrange(64, 90)) for _ in range(20)} | {(i + 1, i) for i in range(64, 90)} | {(64, 90), (70, 5)}
    issued = {i: rng.choice([None, rng.randrange(50)]) for i in range(91)}
    ahead = {i: {s for s, d in up if d == i} for i in issued}
    while any(ahead[i] != (more := ahead[i].union(*[ahead[j] for j in ahead[i]])) and (ahead.__setitem__(i, more) or True) for i in ahead):
        pass
    want = {i: min((issued[j] for j in ahead[i] - {i} if issued[j] is not None), default=None) for i in issued}
    docs, edges = spark.createDataFrame(sorted(issued.items()), "k int, issued int"), spark.createDataFrame(sorted(up), "src int, dst int")
    sizes, stage = [], validity.stage
    monkeypatch.setattr(validity, "stage", lambda df, name: (x := stage(df, name), sizes.append((name, x.count())))[0])
    assert {r.k: r.validUntil for r in validity.validity(docs, edges, "k").collect()} == want
    ends = [size for name, size in sizes if name == "ends"]
    assert ends and max(ends) <= 2 * len(issued)  # not a row for every pair of a chain
