"""Files that stream into a stored graph, in any order, late and again."""

from __future__ import annotations

import os
import random

from cartolex.plans import graph_store, knowledge_graph
from cartolex.sources import files
from cartolex.streaming import upsert

TEXT = "Circolare n. {i}, 1 marzo 2024\nOGGETTO: prova {tag}\n\n\f1. Ambito\nVedi la circolare n. {j} del 01/03/2024 e la legge n. {k} del 27/12/2006 sul bonus per la casa.\n1.1 Soggetti\n{tag} riga\n"


def put(folder, name, i, tag, time):
    path = folder / name
    path.write_text(TEXT.format(i=i, j=i + 1, k=i % 5, tag=tag))
    os.utime(path, (time, time))


def contents(g):
    edges = {(r.type, r.src, r.dst, r.order) for r in g.edges.collect()}
    owned = {label: sorted(tuple(sorted((k, str(v)) for k, v in r.asDict().items() if v is not None)) for r in g.nodes[label].collect()) for label in ("Document", "TableOfContents", "Section", "Chunk")}
    cited = {dst for kind, _, dst, _ in edges if kind == "REFERENCES_LAW"}
    return owned, edges, sorted(r.referenceId for r in g.nodes["LegalReference"].collect() if r.referenceId in cited)


def test_shuffled_late_and_repeated_files_make_the_graph_of_one_build(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "graph")
    source.mkdir()
    versions = [(f"f{i}_v{v}.txt", i, f"v{v}x{i}", 1_700_000_000 + (v if i % 3 else 9 - v) * 1000) for i in range(4) for v in range(3)]
    versions += [("same_a.txt", 1, "gleich a", 1_700_000_000 + 2000), ("zz.txt", 2, "gleich zz", 1_700_000_000 + 2000)]  # as new as the newest: names decide
    random.Random(3).shuffle(versions)

    def run():
        query = upsert.upsert(upsert.file_stream(spark, str(source), "*.txt", 5), target, str(tmp_path / "state"), failed=str(tmp_path / "failed"), buckets=4)
        assert query.awaitTermination(300) and query.exception() is None

    for name, i, tag, time in versions[:8]:
        put(source, name, i, tag, time)
    run()
    half = len(graph_store.versions(spark, target))
    for name, i, tag, time in versions[8:]:
        put(source, name, i, tag, time)
    (source / "bad.txt").write_bytes(b"")
    run()
    pages, _ = files.pages(files.scan(spark, str(source), "*.txt"), modified=True)
    want = knowledge_graph.build(pages)
    want.nodes = {label: graph_store.stored_form(df) for label, df in want.nodes.items()}
    assert half >= 2 and contents(graph_store.read(spark, target)) == contents(want)
    titles = {r.documentId: r.oggetto for r in graph_store.read(spark, target).nodes["Document"].collect()}
    assert titles["CIR_0_2024"] == "prova v0x0" and titles["CIR_1_2024"] == "prova gleich a" and titles["CIR_2_2024"] == "prova gleich zz"
    before = contents(graph_store.read(spark, target))
    again = files.scan(spark, str(source), "f*.txt")
    upsert.upsert_files(again, target)  # as after a crash: all of it was there
    upsert.upsert_files(again.limit(0), target)
    assert contents(graph_store.read(spark, target)) == before
