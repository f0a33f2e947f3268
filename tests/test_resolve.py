"""Alike names against all pairs, and validity of documents against plain versions."""

from __future__ import annotations

import random

import pytest

from cartolex.operators import resolve


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("least", [0.6, 0.8, 1.0])
def test_similar_names_equal_all_pairs(spark, least):
    rng = random.Random(int(least * 10))
    base = ["".join(rng.choices("abcd", k=rng.randrange(1, 14))) for _ in range(60)] + ["a", "aa", "aaa", "aaaaaaaa", "è", "日本語日本語"]

    def edited(s):
        s = list(s)
        for _ in range(rng.randrange(0, 4)):
            i = rng.randrange(0, len(s) + 1)
            s[i : i + rng.randrange(0, 2)] = rng.choices("abcdè", k=rng.randrange(0, 2))
        return "".join(s)

    names = base + [edited(rng.choice(base)) for _ in range(140)] + ["", None, "aaa"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {(r.a, r.b): r.distance for r in resolve.similar_names(df, "n", least).collect()}
    distinct = sorted({n for n in names if n})
    want = {}
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (d := distance(a, b)) <= int((1 - least) * max(len(a), len(b)) + 1e-9):
                want[a, b] = d
    assert got == want


def test_topics_resolve(spark):
    rows = [("T_1", "Ecobonus"), ("T_2", "Eco-bonus"), ("T_3", "eco bonus "), ("T_4", "Superbonus"), ("T_5", "Superbonus 110"), ("T_6", "--"), ("T_7", None), ("T_8", "superbonu"), ("T_9", "Ecobonus")]
    got = {r.topicId: r.entity for r in resolve.resolve(spark.createDataFrame(rows, "topicId string, name string"), "topicId").collect()}
    assert got == {"T_1": "T_1", "T_2": "T_1", "T_3": "T_1", "T_9": "T_1", "T_4": "T_4", "T_8": "T_4", "T_5": "T_5", "T_6": "T_6", "T_7": "T_7"}
    edges = spark.createDataFrame([("D", "s", "T_1", None, 0.4), ("D", "s", "T_2", None, 0.9), ("D", "s", "X", None, 0.1)], "type string, src string, dst string, order int, relevanceScore double")
    entities = spark.createDataFrame(list(got.items()), "topicId string, entity string")
    assert sorted((r.dst, r.relevanceScore) for r in resolve.merged_topics(edges, entities).collect()) == [("T_1", 0.9), ("X", 0.1)]
