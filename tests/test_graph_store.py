"""The stored graph: what an ingest reads and writes, versions, and writers that meet."""

from __future__ import annotations

import os
import threading

import pytest
from pyspark.sql import functions as F

from cartolex.operators import topics
from cartolex.plans import graph_queries, graph_store, knowledge_graph

TEXT = "Circolare n. {i}, 1 marzo 2024\nOGGETTO: prova {tag}\n\n\f1. Ambito\nVedi la circolare n. {j} del 01/03/2024 e la legge n. {k} del 27/12/2006 sul bonus per la casa di tutti.\n1.1 Soggetti\n{tag} riga\n"
MODELS = {"topic_extractor": topics.lexicon_extractor({"Bonus": ("about", "bonus"), "Casa": ("home", "casa")})}


def pages(spark, numbers, tag="uno", more=""):
    rows = []
    for i in numbers:
        parts = (TEXT.format(i=i, j=i + 1, k=i % 5, tag=tag) + more).split("\f")
        rows += [(f"f{i}.pdf", 10, n + 1, text) for n, text in enumerate(parts)]
    return spark.createDataFrame(rows, "filename string, file_size long, page_no int, text string")


def contents(g):
    nodes = {label: sorted(tuple(sorted((k, str(v)) for k, v in r.asDict().items() if v is not None)) for r in df.collect()) for label, df in g.nodes.items()}
    return nodes, sorted((r.type, r.src, r.dst, str(r.order), str(r.relevanceScore and round(r.relevanceScore, 9))) for r in g.edges.collect())


def test_ingests_make_the_graph_of_one_build(spark, tmp_path):
    target = str(tmp_path / "g")
    graph_store.ingest(pages(spark, range(1, 9), "uno", "2. Vecchio\nvia\n"), target, buckets=8, **MODELS)
    report = graph_store.ingest(pages(spark, range(5, 12), "due"), target, **MODELS)
    assert report.first()["new_topics"] == 0
    want = knowledge_graph.build(pages(spark, range(1, 5), "uno", "2. Vecchio\nvia\n").union(pages(spark, range(5, 12), "due")), **MODELS)
    want.nodes = {label: graph_store.stored_form(df) for label, df in want.nodes.items()}
    got_nodes, got_edges = contents(graph_store.read(spark, target))
    nodes, edges = contents(want)
    words = [x for x in got_nodes.pop("Keyword") if x not in nodes["Keyword"]]  # words of what was replaced stay
    nodes.pop("Keyword")
    scored = lambda rows: [r[:3] for r in rows if r[0] == "DISCUSSES_KEYWORD"]
    plain = lambda rows: [r for r in rows if r[0] != "DISCUSSES_KEYWORD"]
    assert got_nodes == nodes and plain(got_edges) == plain(edges)
    assert {s for _, s, _ in scored(got_edges)} == {s for _, s, _ in scored(edges)} and len(words) <= 3
    assert contents(graph_store.read(spark, target, version=1))[0]["Document"][0][0] == ("documentId", "CIR_1_2024")
    assert graph_store.read(spark, target, version=1).nodes["Document"].count() == 8


def test_stale_rows_stay_if_asked_and_a_failed_ingest_changes_nothing(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "g")
    with pytest.raises(FileNotFoundError):
        graph_store.read(spark, target)
    graph_store.ingest(pages(spark, [1, 2], "uno", "2. Vecchio\nvia\n"), target)
    before = graph_store.read(spark, target).nodes["Section"].count()
    graph_store.ingest(pages(spark, [1], "due"), target, keep_stale=True)
    g = graph_store.read(spark, target)
    assert g.nodes["Section"].count() == before and g.edges.count() == g.edges.dropDuplicates(["type", "src", "dst", "order"]).count()
    assert "due riga" in " ".join(r.content for r in g.nodes["Section"].collect())
    graph_store.ingest(pages(spark, [1], "tre"), target)
    assert graph_store.read(spark, target).nodes["Section"].count() == before - 1
    monkeypatch.setattr(graph_store._Merge, "links", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        graph_store.ingest(pages(spark, [3]), target)
    assert graph_store.versions(spark, target) == [1, 2, 3] and len(os.listdir(tmp_path / "g" / "data")) == 3


def test_references_go_with_the_last_text_that_cites_them(spark, tmp_path):
    target, law = str(tmp_path / "g"), "2. Altro\nVedi la legge n. {} del 27/12/2001 e ancora altro\n"
    graph_store.ingest(pages(spark, [1], "uno", law.format(70) + law.format(71)).union(pages(spark, [2], "uno", law.format(71))), target, buckets=8)
    graph_store.ingest(pages(spark, [1], "due"), target)
    kept = lambda: {r.referenceId for r in graph_store.read(spark, target).nodes["LegalReference"].collect()}
    assert {"EXT_LEG_70_2001", "EXT_LEG_71_2001"} & kept() == {"EXT_LEG_71_2001"}  # the second document still cites one
    graph_store.ingest(pages(spark, [2], "due"), target, keep_stale=True)
    assert "EXT_LEG_71_2001" in kept()
    graph_store.ingest(pages(spark, [2], "tre"), target)
    assert "EXT_LEG_71_2001" not in kept() and {"CIR_2_2024", "CIR_3_2024"} <= kept()


def test_a_small_ingest_touches_few_files(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "g")
    graph_store.ingest(pages(spark, range(300)), target, buckets=256)
    first = graph_store.snapshot(spark, target)
    every = {f for own in first.parts.values() for b in own.values() for f in b}
    opened = set()
    folders = graph_store.Snapshot.folders
    monkeypatch.setattr(graph_store.Snapshot, "folders", lambda self, *a: (x := folders(self, *a), opened.update(x))[0])
    graph_store.ingest(pages(spark, [17, 118, 250], "due"), target)
    monkeypatch.undo()
    second = graph_store.snapshot(spark, target)
    now = {f for own in second.parts.values() for b in own.values() for f in b}
    assert len(now - every) < 0.03 * len(every) and len(every - now) < 0.03 * len(every)
    assert len(opened & every) < 0.04 * len(every)
    docs = graph_store.read(spark, target).nodes["Document"]
    assert docs.count() == 300 and {r.documentId for r in docs.where("oggetto = 'prova due'").collect()} == {"CIR_17_2024", "CIR_118_2024", "CIR_250_2024"}
    graph_store.ingest(pages(spark, [900], "tre"), target)  # a new document is appended
    third = graph_store.snapshot(spark, target)
    assert {f for own in third.parts["Document"].values() for f in own} >= {f for own in second.parts["Document"].values() for f in own}


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "g")
    graph_store.ingest(pages(spark, [1, 2]), target, buckets=2)
    claim, meanwhile = graph_store._claim, []

    def late(made):
        if not meanwhile:  # another ingest, of the same buckets, comes first
            meanwhile.append(True)
            graph_store.ingest(pages(spark, [2, 3], "altro"), target)
        return claim(made)

    monkeypatch.setattr(graph_store, "_claim", late)
    graph_store.ingest(pages(spark, [1, 4], "mio"), target)
    got = {r.documentId: r.oggetto for r in graph_store.read(spark, target).nodes["Document"].collect()}
    assert got == {"CIR_1_2024": "prova mio", "CIR_2_2024": "prova altro", "CIR_3_2024": "prova altro", "CIR_4_2024": "prova mio"}
    assert graph_store.versions(spark, target) == [1, 2, 3]
    links = {(r.src, r.dst) for r in graph_store.read(spark, target).edges.where("type = 'REFERS_TO'").collect()}
    assert links == {(f"CIR_{i}_2024", f"CIR_{i}_2024") for i in (2, 3, 4)}
    assert len(os.listdir(tmp_path / "g" / "data")) == 3  # what was written in vain is gone


def test_threads_that_ingest_at_once(spark, tmp_path):
    target, errors = str(tmp_path / "g"), []

    def one(i):
        try:
            graph_store.ingest(pages(spark, [i]), target, buckets=2)
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=one, args=(i,)) for i in (1, 2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and graph_store.read(spark, target).nodes["Document"].count() == 2


def test_lookups_read_few_buckets_in_few_folders_and_old_ones_go(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "g")
    monkeypatch.setattr(graph_store, "MOST_PARTS", 2)
    dated = lambda numbers, tag, year: pages(spark, numbers, tag).withColumn("text", F.regexp_replace("text", "marzo 2024", f"marzo {year}"))
    graph_store.ingest(pages(spark, range(60)).union(dated(range(100, 103), "due", 1999)), target, buckets=64, **MODELS)
    graph_store.ingest(dated([101, 200], "tre", 1999).union(dated([201], "tre", 1998)), target, **MODELS)
    graph_store.ingest(dated([202], "tre", 1998), target, **MODELS)
    asked, folders = [], graph_store.Snapshot.folders
    monkeypatch.setattr(graph_store.Snapshot, "folders", lambda self, table, *a: (asked.append((table, x := folders(self, table, *a))), x)[1])
    got = {r.documentId: r.oggetto for r in graph_store.lookup(spark, target, "Document", type="Circolare", year=1999).collect()}
    assert got == {"CIR_100_1999": "prova due", "CIR_101_1999": "prova tre", "CIR_102_1999": "prova due", "CIR_200_1999": "prova tre"}
    assert 1 <= len(dict(asked)["Document"]) <= 8 and len(dict(asked)["property/Document"]) <= 2
    look = lambda *a, **v: graph_store.lookup(spark, target, *a, **v)
    assert look("Document", type="Circolare").count() == 66 and look("Document", year=1998).count() == 2 and look("Document", type="Risposta").count() == 0
    assert [r.name for r in look("Topic", normalizedName="bonus").collect()] == ["Bonus"] and look("LegalReference", type="legge").count() == 5
    assert look("Document", version=1, year=1999).count() == 3
    with pytest.raises(ValueError, match="oggetto"):
        look("Document", oggetto="x")
    monkeypatch.setattr(graph_store.Snapshot, "folders", folders)
    last = graph_store.snapshot(spark, target)
    assert max(len(f) for own in last.parts.values() for f in own.values()) == 2
    before = contents(graph_store.read(spark, target))
    assert graph_store.vacuum(spark, target, keep=1) > 0 and graph_store.versions(spark, target) == [3]
    assert contents(graph_store.read(spark, target)) == before and graph_queries.counts_by_label(graph_store.read(spark, target)).count() >= 4


def test_keys_show_their_owner(spark):
    rows = [("HAS_SECTION", "CIR_1_2024", "CIR_1_2024"), ("HAS_CHUNK", "CIR_SEC_5_2024_SEC_12", "CIR_SEC_5_2024"), ("NEXT_CHUNK", "RIS_1_SEC_2_CHK_30", "RIS_1"), ("REFERENCES_LAW", "X_2020_SEC_0_CHK_0", "X_2020")]
    df = spark.createDataFrame(rows, "type string, src string, owner string")
    assert df.where(graph_store.owner_of(F.col("type"), F.col("src")) != F.col("owner")).count() == 0
