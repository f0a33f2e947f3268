"""References, topics, merges, links, search and reports, and the whole graph end to end."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartolex.config import EngineConfig
from cartolex.operators import embed, graph, link, references, reports, search, topics, validate
from cartolex.plans import graph_build, graph_queries, knowledge_graph
from cartolex.sources import files, links
from cartolex.streaming import ingest


def test_reference_gate_and_rules(spark):
    cases = {"legge n. 296 del 27/12/2006": ["EXT_LEG_296_2006"], "decreto-legge n. 63 del 4/6/2013": ["EXT_LEG_63_2013"], "circolare n. 20/E del 13.05.2011": ["CIR_20_2011"], "art. 5": [], "risposta n. 204 del 2025": []}
    df = spark.createDataFrame([(s, s) for s in cases], "chunkId string, content string")
    got: dict[str, list] = {s: [] for s in cases}
    for r in references.references(df).collect():
        got[r.sourceChunkId].append(r.referenceId)
    assert got == cases


@pytest.mark.parametrize(("number", "clean"), [("9/E", "9"), ("208-bis", "208"), ("52/E", "52"), ("E", "E"), ("13/2024", "13_2024"), ("20 E", "20")])
def test_canonical_numbers(spark, number, clean):
    row = spark.range(1).select(references.reference_id(F.lit("circolare"), F.lit(number), F.lit("2020"), F.lit("c")).alias("k")).first()
    assert row.k == f"CIR_{clean}_2020"


def test_years_and_hash_keys(spark):
    df = spark.createDataFrame([("2019",), (" 2020",), ("anno 1998, poi",), ("null",), ("99",), (None,)], "y string")
    assert [r[0] for r in df.select(references.validated_year(F.col("y"))).collect()] == ["2019", " 2020", "1998", None, None, None]
    row = spark.range(1).select(references.reference_id(F.lit("Legge"), F.lit(None).cast("string"), F.lit("2020"), F.lit("la legge")).alias("k")).first()
    assert row.k.startswith("REF_") and len(row.k) == 12


def test_merges(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, None)], "k string, seq int, v string")
    assert {r.k: r.v for r in graph.merge_last(df, ["k"], ["seq"]).collect()} == {"a": "y", "b": None}
    assert {r.k: r.v for r in graph.merge_first(df, ["k"], ["seq"]).collect()} == {"a": "x", "b": None}
    assert {r.k: r.created for r in graph.created_flags(df, ["k"]).collect()} == {"a": False, "b": True}
    assert {r.k: r.created for r in graph.created_flags(df, ["k"], df.where("k = 'b'")).collect()} == {"a": False, "b": False}


def test_linking(spark):
    refs = spark.createDataFrame([("CIR_9_2025", "circolare"), ("EXT_DL_1_2000", "x"), ("REF_1", "x"), ("CIR_8_2025", "circolare")], "referenceId string, type string")
    docs = spark.createDataFrame([("CIR_9_E_2025",), ("CIR_8_2025",)], "documentId string")
    status = lambda mode: {r.referenceId: r.status for r in link.categorise(refs, docs, mode).collect()}
    assert status("reference") == {"CIR_9_2025": "unmatched", "EXT_DL_1_2000": "external", "REF_1": "external", "CIR_8_2025": "matched"}
    assert status("strict")["CIR_9_2025"] == "matched"
    pivot = {r.type: (r.matched, r.unmatched, r.external) for r in link.status_pivot(link.categorise(refs, docs)).collect()}
    assert pivot == {"circolare": (1, 1, 0), "x": (0, 0, 2)}


def test_topic_analysis(spark):
    df = spark.createDataFrame([("s", "Il bonus casa e il bonus verde sono detrazioni per la casa e il giardino."), ("short", "bonus")], "sectionId string, content string")
    found = topics.analyses(df, topics.lexicon_extractor({"Bonus": ("about", "bonus"), "Casa": ("home", "casa")}))
    rows = topics.topic_rows(found).collect()
    assert {(r.sectionId, r.topicId, round(r.relevanceScore, 2)) for r in rows} == {("s", "T_bonus", 0.5), ("s", "T_casa", 0.5)}
    bad = lambda s: s.select("sectionId", F.array(F.struct(F.lit("a").alias("name"), F.lit("").alias("description"), F.lit(1.5).alias("relevance_score"))).alias("topics"), F.array(F.struct(F.lit("k").alias("keyword"), F.lit(0.5).alias("relevance_score"))).alias("keywords"))
    assert topics.analyses(df, bad).count() == 0


def test_search(spark):
    df = spark.createDataFrame([(1, "the cat sat", [1.0, 0.0]), (2, "a dog", [0.0, 1.0]), (3, "the dog and the cat", [0.6, 0.8]), (4, None, None), (5, "", [0.0, 0.0])], "i int, t string, v array<float>")
    assert [r.i for r in search.vector_top_k(df, "i", "v", [1.0, 0.0], 2).collect()] == [1, 3]
    assert [r.i for r in search.bm25(df, "i", "t", "cat dog").collect()] == [3, 2, 1]
    assert sorted(r.i for r in search.systematic_sample(spark.range(20).select(F.col("id").alias("i")), ["i"], 7).collect()) == [0, 7, 14]
    assert search.systematic_sample(spark.range(20), ["id"], 1, limit=0).count() == 20


def test_embedding_guard(spark):
    df = spark.createDataFrame([(i, f"w{i}") for i in range(5)], "i int, t string")
    assert embed.embed(df, "i", "t", embed.hash_embedder(8)).count() == 5
    assert embed.embed(df, "i", "t", lambda texts: [[1.0]] * (len(texts) + 1)).count() == 0


def test_reports_on_empty_input(spark):
    empty = spark.createDataFrame([], "success boolean, filename string, sections_count int, chunks_count int, processing_time double, toc_extracted boolean, toc_pages int")
    row = reports.processing_summary(empty).first()
    assert (row.total, row.sections, row.avg_seconds) == (0, 0, None)
    assert validate.best_and_worst(spark.createDataFrame([], "documentId string, match_rate double")).count() == 0


def test_links(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('﻿ID,LINK DOCUMENTI ESTRATTI\n1,"http://a/x.pdf\nhttp://a/y.pdf"\n2,N/A\n3,\n4," http://b/z ftp://no"\n', encoding="utf-8")
    got = links.urls(links.read_questions(spark, str(path)))
    assert [r.url for r in got.orderBy("ID", "url").collect()] == ["http://a/x.pdf", "http://a/y.pdf", "http://b/z"]
    cases = {"https://h.example/d/Risoluzione+n.+45_2025.pdf/aad-1?t=17": "Risoluzione_n._45_2025.pdf", "https://h.example/d/a%2Bb.pdf": "a_2Bb.pdf"}
    df = spark.createDataFrame([(u,) for u in cases], "u string").select("u", links.file_name(F.col("u")).alias("n"))
    assert {r.u: r.n for r in df.collect()} == cases
    names = spark.createDataFrame([(1, "a.pdf"), (2, "a.pdf"), (3, "b.pdf")], "k int, n string")
    assert [r.n for r in links.distinct_names(names, "n", "k").orderBy("k").collect()] == ["a.pdf", "a_1.pdf", "b.pdf"]
    fetched = links.fetch(got, lambda u: (b"x", "application/pdf", None) if "x" in u else (None, "", "404"))
    assert reports.download_summary(fetched).first().asDict() == {"total": 3, "ok": 1, "failed": 2}
    with pytest.raises(ValueError, match="no column"):
        links.read_questions(spark, str(path), "missing")


BOOK = "Circolare n. 7 del 1 marzo 2024\nOGGETTO: prova\nriga\f1. Indice 1\nPREMESSA ..... 3\fPREMESSA\nAi sensi della legge n. 296 del 27/12/2006.\n1. Ambito\n1.1 Soggetti\nVedi circolare n. 7 del 01/03/2024 e il bonus per la casa di tutti i soggetti.\n"


def test_graph_end_to_end(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("a.pdf", "b.pdf"):
        (tmp_path / "in" / name).write_text(BOOK.replace("prova", name), encoding="utf-8")
    (tmp_path / "in" / "skip.txt").write_text("no")
    pages, errors = files.pages(files.scan(spark, str(tmp_path / "in")))
    assert errors.count() == 0
    lexicon = topics.lexicon_extractor({"Bonus": ("about", "bonus")})
    g = knowledge_graph.build(pages, EngineConfig(embedding_dim=16), topic_extractor=lexicon, embedder=embed.hash_embedder(16))
    target = str(tmp_path / "graph")
    knowledge_graph.write(g, target)
    with pytest.raises(FileExistsError):
        knowledge_graph.write(g, target)
    stored = knowledge_graph.read(spark, target)
    count = lambda label: stored.nodes[label].count()
    edges = {r.type: r["count"] for r in graph_queries.counts_by_edge_type(stored).collect()}
    assert count("Document") == 1 and stored.nodes["Document"].first().oggetto.startswith("b.pdf")
    assert edges["HAS_SECTION"] == count("Section") and edges["HAS_CHUNK"] == count("Chunk") and edges["HAS_TOC"] == count("TableOfContents")
    assert edges["NEXT_SECTION"] == count("Section") - count("Document")
    assert edges.get("NEXT_CHUNK", 0) == count("Chunk") - count("Section")
    assert graph.unique_violations(stored.nodes["Chunk"], "chunkId").count() == 0
    assert {r.referenceId for r in stored.nodes["LegalReference"].collect()} == {"EXT_LEG_296_2006", "CIR_7_2024"}
    assert graph_queries.embedding_completeness(stored).first().embedded == count("Chunk")
    assert graph_queries.keyword_search(stored, "bonus casa").count() == 1
    assert graph_queries.most_discussed_topics(stored).first().name == "Bonus"
    assert knowledge_graph.clear(spark, target) is False and knowledge_graph.clear(spark, target, really=True)


def test_bad_file_is_a_row(spark, tmp_path):
    (tmp_path / "x.pdf").write_bytes(b"x")
    pages, errors = files.pages(files.scan(spark, str(tmp_path), limit=1), lambda b: 1 / 0)
    assert pages.count() == 0 and errors.first().error.startswith("ZeroDivisionError")


def test_incremental_ingest(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    for k in range(2):
        spark.createDataFrame([(k, "abc. " * 600)], "doc_id int, text string").write.mode("append").parquet(src)
        q = ingest.ingest(spark, src, out, ck)
        q.awaitTermination(120)
        assert spark.read.parquet(out).select("doc_id").distinct().count() == k + 1


def test_config(monkeypatch):
    monkeypatch.setenv("CARTOLEX_CHUNK_SIZE", "99")
    assert EngineConfig.from_env().chunk_size == 99
    with pytest.raises(ValueError):
        EngineConfig(chunk_overlap=0)


def test_models_are_asked_once_a_chunk_and_failures_stop_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_text(BOOK.replace("bonus", "bonus articolo 9"), encoding="utf-8")
    pages, _ = files.pages(files.scan(spark, str(tmp_path / "in")))
    log = tmp_path / "log"

    def ask(text):
        with open(log, "a") as f:
            f.write("x")
        if "n. 296" in text:
            raise ValueError("the model is out")
        return [{"type": "circolare", "number": "7", "year": "2024", "citation": "c", "article": None, "description": None}]

    g = knowledge_graph.build(pages, reference_extractor=references.model_extractor(ask))
    gated = g.nodes["Chunk"].where(references.gate(F.col("content"))).count()
    knowledge_graph.write(g, str(tmp_path / "graph"))
    assert gated >= 2 and len(log.read_text()) == gated
    assert [r.referenceId for r in g.nodes["LegalReference"].collect()] == ["CIR_7_2024"]
    bad = topics.model_extractor(lambda text: {"topics": [{"name": "n", "description": "d", "relevance_score": 0.5}]} if "bonus" in text else 1 / 0)
    found = topics.analyses(spark.createDataFrame([("a", "bonus " * 20), ("b", "altro " * 20)], "sectionId string, content string"), bad)
    assert [(r.sectionId, r.topics[0].name, r.keywords) for r in found.collect()] == [("a", "n", [])]
    half = embed.embed(spark.range(4).select("id", F.col("id").cast("string").alias("t")), "id", "t", lambda texts: [[1.0 / (int(texts[0]) - 2)]], batch=1)
    assert sorted(r.id for r in half.collect()) == [0, 1, 3]


def test_overwriting_keeps_a_whole_graph(spark, tmp_path):
    pages = spark.createDataFrame([("a.pdf", 1, 1, BOOK)], "filename string, file_size long, page_no int, text string")
    g, target = knowledge_graph.build(pages), str(tmp_path / "graph")
    knowledge_graph.write(g, target)
    broken = knowledge_graph.Graph(g.nodes, g.edges.withColumn("order", F.expr("raise_error('disk')").cast("int")))
    with pytest.raises(Exception, match="disk"):
        knowledge_graph.write(broken, target, overwrite=True)
    assert knowledge_graph.read(spark, target).nodes["Document"].count() == 1
    knowledge_graph.write(g, target, overwrite=True)
    assert [p.name for p in tmp_path.iterdir()] == ["graph"]


def test_files_of_one_name_in_two_folders_stay_apart(spark, tmp_path):
    for k, folder in enumerate(("x", "y")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "f.pdf").write_text(f"Circolare n. {k + 1}, 2020\n\fpagina {k}")
    (tmp_path / "x" / "none.pdf").write_text("-")
    pages, errors = files.pages(files.scan(spark, str(tmp_path), recursive=True), lambda b: b.decode().split("\f") if b != b"-" else [])
    docs = {r.documentId: r.fullText for r in knowledge_graph.structure(pages)["Document"].collect()}
    assert docs == {"CIR_1_2020": "Circolare n. 1, 2020\npagina 0", "CIR_2_2020": "Circolare n. 2, 2020\npagina 1"}
    assert [(r.filename, r.error) for r in errors.collect()] == [("none.pdf", "no pages")]


def test_systematic_sample_of_many_partitions(spark):
    rows = spark.range(300_000).select(F.xxhash64("id").alias("k"), F.md5(F.col("id").cast("string").cast("binary")).alias("v")).repartition(8)
    want = sorted(r.k for r in rows.select("k").collect())[::7]
    for _ in range(2):
        got = search.systematic_sample(rows, ["k"], 7)
        assert got.columns == ["k", "v"] and sorted(r.k for r in got.collect()) == want


def test_names_become_distinct(spark):
    import random

    rng = random.Random(3)
    names = [rng.choice(["a.pdf", "a_1.pdf", "a_2.pdf", "a_1_1.pdf", "b", "a_07.pdf", None]) for _ in range(200)]
    got = {r.k: r.n for r in links.distinct_names(spark.createDataFrame(list(enumerate(names)), "k int, n string"), "n", "k").collect()}
    made = [n for n in got.values() if n is not None]
    assert len(set(made)) == len(made) == sum(n is not None for n in names)
    for n in set(names) - {None}:
        assert got[names.index(n)] == n


def test_fetch_failures_are_rows(spark):
    urls = spark.createDataFrame([("http://a/x.pdf",), ("http://a/y",), ("http://b/z",), (None,)], "url string")
    got = {r.url: (r.ok, r.warning, r.error) for r in links.fetch(urls, lambda u: 1 / 0 if "z" in u else (b"x", "text/html", None)).collect()}
    assert got == {"http://a/x.pdf": (True, None, None), "http://a/y": (True, "content type is text/html", None), "http://b/z": (False, None, "ZeroDivisionError: division by zero")}
    content, _, error = links.http_fetcher(timeout=0.2, pause=0.0)("http://127.0.0.1:1/x")
    assert content is None and error


def test_fetching_by_http(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Site(BaseHTTPRequestHandler):
        def do_GET(self):
            if self.headers["User-Agent"] != "a test":
                return self.send_error(403)
            status, kind, body = {"/a.pdf": (200, "application/pdf", b"%PDF"), "/page": (200, "text/html; charset=utf-8", b"<p>"), "/moved": (302, "", b""), "/loop": (302, "", b"")}.get(self.path, (404, "text/plain", b"none"))
            self.send_response(status)
            if status == 302:
                self.send_header("Location", "/a.pdf" if self.path == "/moved" else "/loop")
            self.send_header("Content-Type", kind)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    site = HTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=site.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{site.server_port}"
    urls = spark.createDataFrame([(base + p,) for p in ("/a.pdf", "/page", "/moved", "/loop", "/gone", "/gone")], "url string")
    got = {r.url.removeprefix(base): r for r in links.fetch(urls, links.http_fetcher(timeout=5.0, pause=0.0, agent="a test")).collect()}
    site.shutdown()
    assert set(got) == {"/a.pdf", "/page", "/moved", "/loop", "/gone"}
    assert (bytes(got["/a.pdf"].content), got["/a.pdf"].content_type, got["/a.pdf"].warning) == (b"%PDF", "application/pdf", None)
    assert bytes(got["/moved"].content) == b"%PDF" and got["/moved"].ok and got["/moved"].warning is None
    assert got["/page"].ok and got["/page"].warning == "content type is text/html"
    assert not got["/gone"].ok and "404" in got["/gone"].error and not got["/loop"].ok and "HTTPError" in got["/loop"].error


def test_pages_of_a_file_are_handed_on_in_slices(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    want = [f"{i} " + "x" * (i % 7) for i in range(5000)]
    (tmp_path / "in" / "a.txt").write_text("\f".join(want))
    monkeypatch.setattr(files, "stage", lambda df, name: df)
    pages, errors = files.pages(files.scan(spark, str(tmp_path / "in"), "*.txt"))
    assert [(r.page_no, r.text) for r in pages.collect()] == [(i + 1, t) for i, t in enumerate(want)] and errors.count() == 0
    slices = [(first, len(some)) for first, some in files._slices(["x" * 600_000] * 3 + ["y"] * 5000)]
    assert slices == [(0, 1), (1, 1), (2, 4096), (4098, 905)] and list(files._slices([])) == [(0, [None])]


def test_more_documents_are_more_files_not_larger_ones(spark, tmp_path, monkeypatch):
    spark.range(2500).selectExpr("id * 16 AS doc_id", "concat('text ', id) AS text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    scanned, scan = [], files.scan
    monkeypatch.setattr(files, "scan", lambda *a, **k: (x := scan(*a, **k), scanned.append(x))[0])
    assert graph_build.file_pages(spark, str(tmp_path)).count() == 2500
    assert scanned[0].count() == 3  # all of one shelf: 1000 documents a file


def test_structure_reads_pages_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(f"f{i}.pdf", 10, n, t) for i in range(6) for n, t in ((1, f"Circolare n. {i}, 1 marzo 2024\nOGGETTO: x\n\n"), (2, "INDICE\nPREMESSA ..... 3\n"), (3, "PREMESSA\nun testo\n"))]
    pages = spark.createDataFrame(rows, "filename string, file_size long, page_no int, text string")
    made = knowledge_graph.structure(pages.mapInArrow(counted, pages.schema))
    assert made["TableOfContents"].count() == 6 and made["Section"].count() == 6 and seen.value == 18


def test_words_meet_a_small_vocabulary_where_they_are(spark):
    sections = spark.createDataFrame([(f"s{i}", "parole comuni a tutte " + f"rara{i} " * 3) for i in range(20)], "sectionId string, content string")
    found = topics.lexicon_extractor({})(sections)
    assert "hashpartitioning(word" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.sectionId: r.keywords[0]["keyword"] for r in found.collect()} == {f"s{i}": f"rara{i}" for i in range(20)}
