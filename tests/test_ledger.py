"""The ledger of model calls: nothing is asked twice, failures are rows, a run that died goes on."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cartolex.config import EngineConfig
from cartolex.operators import embed, ledger, references, topics
from cartolex.plans import knowledge_graph

KIND = "struct<n:int,first:string>"


def model(log, bad=()):
    def call(text):
        with open(log, "a") as f:
            f.write(f"{text}\n")
        if text in bad:
            raise ValueError(f"no answer to {text}")
        return {"n": len(text), "first": text[:1]}

    return call


def calls(log):
    return sorted(open(log).read().splitlines()) if os.path.exists(log) else []


def answers(out):
    return sorted(((r.k, r.result and r.result.n, r.error) for r in out.collect()), key=str)


def test_equal_texts_are_asked_once_and_never_again(spark, tmp_path):
    kept, log = ledger.Ledger(str(tmp_path / "l"), "m", pause=0.0, wave=3), str(tmp_path / "log")
    rows = spark.createDataFrame([(1, "aa"), (2, "bbb"), (3, "aa"), (4, None), (5, ""), (None, "c"), (1, "dddd"), (7, "ee"), (8, "ff")], "k int, t string")
    want = answers(ledger.ask(rows, "k", "t", model(log), KIND, kept))
    assert want == sorted([(1, 2, None), (2, 3, None), (3, 2, None), (4, 0, None), (5, 0, None), (None, 1, None), (1, 4, None), (7, 2, None), (8, 2, None)], key=str)
    assert calls(log) == ["", "aa", "bbb", "c", "dddd", "ee", "ff"]
    assert answers(ledger.ask(rows, "k", "t", model(log), KIND, kept)) == want and len(calls(log)) == 7
    other = ledger.Ledger(kept.path, "m2", pause=0.0)  # another model is asked by itself
    ledger.ask(rows.where("k = 2"), "k", "t", model(log), KIND, other)
    assert len(calls(log)) == 8
    assert answers(ledger.ask(rows.limit(0), "k", "t", model(log), KIND, kept)) == []
    assert {r.state: (r["items"], r.tries) for r in ledger.report(spark, kept).collect()} == {"answered": (7, 7)}


def test_failures_are_tried_again_until_they_are_dead(spark, tmp_path):
    kept, log = ledger.Ledger(str(tmp_path / "l"), "m", tries=2, pause=0.0, runs=2), str(tmp_path / "log")
    rows = spark.createDataFrame([(1, "good"), (2, "bad")], "k int, t string")
    for n, state in ((2, "failed"), (4, "dead"), (4, "dead")):  # tries of the bad item after each run
        out = answers(ledger.ask(rows, "k", "t", model(log, {"bad"}), KIND, kept))
        assert out == [(1, 4, None), (2, None, "ValueError: no answer to bad")]
        assert calls(log).count("bad") == n and calls(log).count("good") == 1
        assert {r.state for r in kept.items(spark).where("error is not null").collect()} == {state}
    assert [(r.text, r.tries) for r in kept.dead(spark).collect()] == [("bad", 4)]
    ledger.revive(spark, kept)
    assert answers(ledger.ask(rows, "k", "t", model(log), KIND, kept)) == [(1, 4, None), (2, 3, None)]
    assert {r.state: (r["items"], r.tries) for r in ledger.report(spark, kept).collect()} == {"answered": (2, 6)}


def test_a_call_is_tried_again_within_a_run(spark, tmp_path):
    log = str(tmp_path / "log")

    def shaky(text):
        with open(log, "a") as f:
            f.write(f"{text}\n")
        if len(open(log).readlines()) < 3:
            raise TimeoutError
        return {"n": 1, "first": "x"}

    kept = ledger.Ledger(str(tmp_path / "l"), "m", tries=4, pause=0.01)
    assert answers(ledger.ask(spark.createDataFrame([(1, "a")], "k int, t string"), "k", "t", shaky, KIND, kept)) == [(1, 1, None)]
    assert kept.items(spark).first().tries == 3


def test_a_run_that_died_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    kept, log = ledger.Ledger(str(tmp_path / "l"), "m", pause=0.0, wave=5), str(tmp_path / "log")
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(40)], "k int, t string")
    append, waves = ledger._append, []

    def dies(made, to):
        if len(waves) == 3:
            raise KeyboardInterrupt
        waves.append(1)
        append(made, to)

    monkeypatch.setattr(ledger, "_append", dies)
    with pytest.raises(KeyboardInterrupt):
        ledger.ask(rows, "k", "t", model(log), KIND, kept)
    monkeypatch.undo()
    done = kept.items(spark).count()
    assert 0 < done < 40 and len(calls(log)) == done
    assert len(answers(ledger.ask(rows, "k", "t", model(log), KIND, kept))) == 40
    assert calls(log) == sorted(f"t{i}" for i in range(40))


def test_answers_of_another_form_are_errors_and_batches_fail_as_one(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(6)], "k int, t string").coalesce(1)
    odd = ledger.ask(rows.limit(1), "k", "t", lambda t: "words", KIND, ledger.Ledger(str(tmp_path / "a"), "m"))
    assert [(r.result, r.error) for r in odd.collect()] == [(None, "answer of another form")]
    short = ledger.Ledger(str(tmp_path / "b"), "m", tries=1, batch=4)
    out = ledger.ask(rows, "k", "t", lambda texts: [[1.0]] * min(2, len(texts)), "array<float>", short)
    assert sorted(str(r.error) for r in out.collect()) == ["None"] * 2 + ["ValueError: 2 answers to 4 texts"] * 4


def test_a_second_build_asks_nothing(spark, tmp_path):
    text = "Circolare n. {i}, 1 marzo 2024\nOGGETTO: x\n\n\f1. Ambito\nVedi la legge n. {i} del 27/12/2006 sul bonus per la casa di tutti quanti loro.\n"
    pages = spark.createDataFrame([(f"f{i}", 1, n + 1, p) for i in range(3) for n, p in enumerate(text.format(i=i).split("\f"))], "filename string, file_size long, page_no int, text string")
    log = str(tmp_path / "log")

    def heard(name, call):
        def f(x):
            with open(log, "a") as out:
                out.write(f"{name}\n")
            return call(x)

        return f

    of = lambda name: ledger.Ledger(str(tmp_path / "ledger"), name, pause=0.0)
    cite = heard("cite", lambda t: [{"type": "legge", "number": "1", "year": "2006", "citation": "c", "article": None, "description": None}])
    themes = heard("themes", lambda t: {"topics": [{"name": "Casa", "description": "d", "relevance_score": 0.5}], "keywords": []})
    vectors = heard("vectors", embed.hash_embedder(4))

    def build():
        g = knowledge_graph.build(pages, EngineConfig(embedding_dim=4), reference_extractor=references.model_extractor(cite, 2, of("cite")), topic_extractor=topics.model_extractor(themes, 2, of("themes")), embedder=vectors, vectors=of("vectors"))
        return {label: df.count() for label, df in g.nodes.items()}, g.edges.count(), g.nodes["Chunk"].where(F.size("embedding") == 4).count()

    first = build()
    asked = calls(log)
    assert {"cite", "themes", "vectors"} == set(asked) and first[2] == first[0]["Chunk"]
    assert build() == first and calls(log) == asked
