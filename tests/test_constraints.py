"""Declared constraints: seeded violations are found, one scan a table, offenders go to quarantine."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from cartolex.operators import topics
from cartolex.operators.constraints import Dense, Exists, Holds, Unique, graph_suite, name, report, split, violations
from cartolex.plans import knowledge_graph

SUITE = [Unique("a", ("i",)), Unique("a", ("g", "o"), "g <> 'y'"), Dense("a", "g", "o"), Exists("a", "up", "b", "k"), Holds("a", "size(v) = 2", "i > 1"), Holds("b", "k is not null")]


def tables(spark):
    eight = [(100 + k, "pte", o, None, [1.0, 1.0]) for k, o in enumerate((0, 0, 3, 4, 4, 5, 5, 7))]  # sums and squares of 0 to 7, but not these numbers
    a = [(1, "x", 0, "p", None), (2, "x", 1, "q", [1.0, 2.0]), (2, "y", 0, None, [1.0]), (3, "y", 2, "p", [1.0, 2.0]), (None, "z", 0, "none", [0.0, 0.0]), (5, None, 7, "p", None), (6, "w", None, "p", [1.0, 1.0]), (7, "ok", 1, "p", [1.0, 1.0]), (8, "ok", 0, "p", [1.0, 1.0])]
    return {"a": spark.createDataFrame(a + eight, "i int, g string, o int, up string, v array<double>").repartition(3), "b": spark.createDataFrame([("p",), ("q",), ("q",), (None,)], "k string")}


def test_seeded_violations_are_found(spark):
    got = {(r.constraint, r.key): r.rows for r in violations(tables(spark), SUITE).collect()}
    u, u2, d, e, h, hb = (name(c) for c in SUITE)
    assert got == {
        (u, '["2"]'): 2, (u2, '["pte","0"]'): 2, (u2, '["pte","4"]'): 2, (u2, '["pte","5"]'): 2,
        (d, '["y"]'): 2, (d, '["w"]'): 1, (d, '["pte"]'): 8, (e, '["none"]'): 1, (h, "*"): 2, (hb, "*"): 1,
    }
    assert {r.constraint: (r["keys"], r.rows) for r in report(violations(tables(spark), SUITE)).collect()}[u2] == (3, 6)
    empty = {k: df.limit(0) for k, df in tables(spark).items()}
    assert violations(empty, SUITE).collect() == []


def test_one_scan_a_table(spark, tmp_path):
    for k, df in tables(spark).items():
        df.write.parquet(f"{tmp_path}/{k}")
    stored = {k: spark.read.parquet(f"{tmp_path}/{k}") for k in ("a", "b")}
    plan = violations(stored, SUITE)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) == 2 and "Join" not in plan


def test_offenders_go_to_quarantine(spark):
    clean, bad, _ = split(tables(spark), SUITE)
    assert {(r.i, r.g) for r in clean["a"].collect()} == {(1, "x"), (7, "ok"), (8, "ok")}
    assert clean["a"].count() + bad["a"].count() == tables(spark)["a"].count()
    broken = {(r.i, r.g): r.broken for r in bad["a"].collect()}
    assert broken[2, "y"] == [name(SUITE[0]), name(SUITE[2]), name(SUITE[4])] and broken[None, "z"] == [name(SUITE[3])]
    assert [r.k for r in clean["b"].orderBy("k").collect()] == ["p", "q", "q"]
    again, _, found = split(clean, SUITE)
    assert found.where(F.col("key") != '["x"]').count() == 0 and again["a"].columns == clean["a"].columns


def test_a_built_graph_keeps_its_constraints(spark):
    text = "Circolare n. {i}, 1 marzo 2024\nOGGETTO: x\n\n\f1. Ambito\nVedi la legge n. {i} del 27/12/2006 sul bonus per la casa di tutti quanti loro.\n1.1 Altro\nriga\n"
    pages = spark.createDataFrame([(f"f{i}", 1, n + 1, p) for i in range(3) for n, p in enumerate(text.format(i=i).split("\f"))], "filename string, file_size long, page_no int, text string")
    g = knowledge_graph.build(pages, topic_extractor=topics.lexicon_extractor({"Bonus": ("about", "bonus")}))
    whole = {**g.nodes, "edges": g.edges}
    assert violations(whole, graph_suite()).collect() == []
    hurt = {**whole, "Chunk": g.nodes["Chunk"].where("documentId <> 'CIR_1_2024'"), "edges": g.edges.withColumn("relevanceScore", F.col("relevanceScore") * 3)}
    names = {r.constraint for r in violations(hurt, graph_suite()).collect()}
    assert {n.split(":")[1].split(" (")[0].strip() for n in names} == {"dst in Chunk.chunkId", "src in Chunk.chunkId", "relevanceScore between 0 and 1"}
