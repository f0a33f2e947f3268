"""Keyword search: queries as they are typed, the stored index against the texts, and what a query reads."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartolex.operators import search, text_index

LAWS = [
    (1, "Ai sensi dell'articolo 5 della legge n. 190 del 2014, la legge di bilancio prevede detrazioni."),
    (2, "La legge, di bilancio in bilancio, cambia: articolo 5-bis."),
    (3, "Il bilancio di legge non prevede altro. Co-operative e cooperative."),
    (4, "n n n 190"),
    (5, ""),
    (6, None),
    (7, "Legge DI Bilancio legge di bilancio"),
]


def found(out):
    return [(r[0], round(r.score, 9)) for r in out.collect()]


@pytest.fixture(scope="module")
def laws(spark, tmp_path_factory):
    df = spark.createDataFrame(LAWS, "term int, text string")  # a key with the name of a column of the index
    path = str(tmp_path_factory.mktemp("index") / "laws")
    text_index.write_index(df, "term", "text", path)
    return df, path


def test_clauses(spark):
    assert search.clauses(spark, "dell'Articolo 5, n. \"Legge di bilancio\" legge legge") == [("5",), ("articolo",), ("dell",), ("legge",), ("legge", "di", "bilancio"), ("n",)]
    assert search.clauses(spark, "") == search.clauses(spark, ' "" . "..." ') == []
    assert search.clauses(spark, '"senza fine') == [("senza", "fine")]


@pytest.mark.parametrize(("query", "ids"), [("dell'articolo 5", {1, 2}), ("n. 190", {1, 4}), ('"legge di bilancio"', {1, 2, 7}), ('"bilancio legge"', {7}), ("co-operative", {3}), ("legge,", {1, 2, 3, 7}), ("nulla", set()), ("...", set()), ('"legge n" bilancio', {1, 2, 3, 7}), ('"nulla di" 190', {1, 4})])
def test_queries_as_they_are_typed(spark, laws, query, ids):
    df, path = laws
    direct, stored = (found(x) for x in (search.bm25(df, "term", "text", query), text_index.search(spark, path, "term", query)))
    assert {i for i, _ in direct} == ids and stored == direct


def test_phrases_count_all_their_places(spark, tmp_path):
    df = spark.createDataFrame([(1, "a a a a b a b"), (2, "a b a b a b"), (3, "b a")], "i int, t string")
    text_index.write_index(df, "i", "t", str(tmp_path / "x"))
    for q in ('"a a"', '"a b a"', '"b a b"', '"a a" b'):
        assert found(text_index.search(spark, str(tmp_path / "x"), "i", q)) == found(search.bm25(df, "i", "t", q))


def test_index_equals_texts_and_reads_little(spark, tmp_path):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(words, [1 / (j + 1) for j in range(400)], k=rng.randrange(1, 60)))) for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, t string").repartition(5)
    path = str(tmp_path / "x")
    text_index.write_index(df, "i", "t", path, file_blocks=20)
    files = spark.read.parquet(f"{path}/files").count()
    blocks = spark.read.parquet(f"{path}/blocks")
    assert files >= 15 and blocks.select(F.max(F.size("texts"))).first()[0] <= text_index.BLOCK
    for query in ("w0", "w0 w1 w399", "w3 w250", "w300 w301 w302", 'w399 "w0 w1"', "w0 w0 w0"):
        assert found(text_index.search(spark, path, "i", query)) == found(search.bm25(df, "i", "t", query)), query
    p = text_index.plan(spark, path, "w0 w399")
    assert len(p.files) < files / 2
    of_word = lambda w: blocks.where(F.col("term") == w)
    alone = text_index.plan(spark, path, "w0").least["w0"]
    assert of_word("w0").count() > 15 and of_word("w0").where(F.col("best") >= alone).count() <= 2
    one = text_index.plan(spark, path, "w350")
    assert len(one.files) <= 2


def test_no_texts(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "i int, t string")
    text_index.write_index(df, "i", "t", str(tmp_path / "x"))
    out = text_index.search(spark, str(tmp_path / "x"), "i", "a")
    assert out.columns == ["i", "score"] and out.collect() == []
    assert search.bm25(df, "i", "t", "a").collect() == []


def test_rows_shuffled_follow_words_of_slices_not_of_texts(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices([f"w{j}" for j in range(50)], k=40))) for i in range(2000)]
    df = spark.createDataFrame(rows, "i int, t string").coalesce(2)
    entries = sum(len(set(t.split())) for _, t in rows)
    dealt, deal = [], type(df).repartitionByRange
    monkeypatch.setattr(type(df), "repartitionByRange", lambda self, *a: dealt.append(self.count()) or deal(self, *a))
    text_index.write_index(df, "i", "t", str(tmp_path / "x"))
    assert dealt[0] < entries / 8
    assert found(text_index.search(spark, str(tmp_path / "x"), "i", '"w1 w2" w3')) == found(search.bm25(df, "i", "t", '"w1 w2" w3'))


def test_keys_and_letters_of_any_kind(spark, tmp_path):
    df = spark.createDataFrame([("b", "Perché ΣΑΣ 𝔘x، ١٢ straße İI"), ("a", "perché, perché!  _x_ ß"), ("c", "؟ … \n\t"), (None, "straße"), ("d", "x" * 70_000 + " perché")], "k string, t string")
    text_index.write_index(df, "k", "t", str(tmp_path / "x"))
    for q in ("perché", "ΣΑΣ", "𝔘x", "١٢", "straße", "İI", "_x_", "ß", '"perché perché"', "x" * 70_000):
        assert found(text_index.search(spark, str(tmp_path / "x"), "k", q)) == found(search.bm25(df, "k", "t", q)) != [], q[:9]


def test_slices_runs_and_goes_of_any_size_give_all_places(monkeypatch):
    rng, mean = random.Random(6), 30.0
    texts = {i: " ".join(rng.choices("abcdef", [1, 3, 9, 20, 1, 0.02], k=rng.choice([0, 1, 7, 90]))) for i in range(700)}
    want = {(w, i): [p for p, v in enumerate(t.split()) if v == w] for i, t in texts.items() for w in set(t.split())}
    for name, value in {"SLICE": 900, "RUN": 3, "HELD": 400}.items():
        monkeypatch.setattr(text_index, name, value)
    batches = [pa.RecordBatch.from_arrays([pa.array(list(texts)[a : a + 300], pa.int64()), pa.array(list(texts.values())[a : a + 300], pa.string())], ["k", "w"]) for a in (0, 300, 600, 900)]
    rows = pa.Table.from_batches(text_index._cut(iter(batches))).to_pylist()
    assert sum(r["n"] for r in rows if r["term"] is None) == 700 and sum(r["words"] for r in rows) == sum(len(t.split()) for t in texts.values())
    rows = sorted((r for r in rows if r["term"]), key=lambda r: (r["term"], r["texts"][0]))
    table = pa.Table.from_pylist([{c: r[c] for c in ("term", "texts", "counts", "steps")} for r in rows], pa.schema([("term", pa.string()), ("texts", pa.list_(pa.int64())), ("counts", pa.binary()), ("steps", pa.binary())]))
    got, blocks = {}, pa.Table.from_batches(text_index._blocks(iter(table.to_batches(max_chunksize=37)), mean)).to_pylist()
    led = defaultdict(int)
    for b in blocks:
        adds = [tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean)) for n, tf in zip(b["lengths"], np.diff([0, *b["ends"]]), strict=True)]
        assert len(adds) == b["n"] <= text_index.BLOCK and adds == sorted(adds, reverse=True) and adds[0] == pytest.approx(b["best"])
        led[b["term"]] += b["lead"]
        for key, n, start, end in zip(b["texts"], b["lengths"], [0, *b["ends"]], b["ends"], strict=False):
            assert (b["term"], key) not in got and n == len(texts[key].split())
            got[b["term"], key] = b["positions"][start:end]
    assert got == want and min(led.values()) == 1 < led["d"]


def test_packed_numbers():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**28 - 1, 2**28, 2**31 - 1, 5])
    rows = text_index._packed(np.array([0, 3, 4]), values)
    assert text_index._unpacked(rows).tolist() == values.tolist() and text_index._unpacked(rows.slice(1, 1)).tolist() == [128]
