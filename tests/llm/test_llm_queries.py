"""Registered queries of the training-data operators against their SQL, and the learned ones against plain versions."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartolex.llm import language, quality, queries, words

duckdb = pytest.importorskip("duckdb")
TABLES = os.environ.get("CARTOLEX_TEST_TABLES", "/root/testdata/sf0.001")
MASK = (1 << 64) - 1


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
@pytest.mark.parametrize("name", ["op1_embedding_dedup", "op2_preference", "op3_minhash", "op6_mixing", "op10_url_rules", "op11_fill_in_middle", "op12_centroids"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
    df = queries.QUERIES[name](spark, TABLES)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted([tuple(r) for r in df.collect()], key=str) == sorted(want, key=str)


TEXTS = ["the house and the river", "der Fluss und das Haus", "la casa e il fiume!", "  ...the", "a", "É", "!!", "x 1 y  2 z", "und " * 3000, "the", "das\n\nHaus"]
ROWS = [(i, t, ("en", "de", "it")[i % 3]) for i, t in enumerate(TEXTS * 3)]


def plain_cells(text):
    """Counts of the n-grams of a text between two spaces, hashed by whole numbers."""
    raw = [b + 32 if 65 <= b <= 90 else b for b in text.encode()]
    letters = "".join(chr(b) if 97 <= b <= 122 or b >= 128 else " " for b in raw)
    signs = [ord(c) for c in " " + " ".join(letters.split(" ")).strip() + " "]
    signs = [c for k, c in enumerate(signs) if c != 32 or k == 0 or signs[k - 1] != 32]
    a, b, c, low = 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0xFFFFFFFF
    cell = lambda x: ((((x ^ (x >> 13)) & low) * b) & low) >> (32 - language.DIM_BITS)
    counts = {}
    two = [(x * a + y * b) & low for x, y in zip(signs, signs[1:], strict=False)]
    three = [((((t ^ (t >> 15)) * c) & low) + z * a) & low for t, z in zip(two, signs[2:], strict=False)]
    for x in two + three:
        counts[cell(x)] = counts.get(cell(x), 0) + 1
    return counts if letters.strip() else {}


def test_language_equals_a_plain_version(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").withColumn("lettered", F.lit("own")).withColumn("_lettered", F.lit(1))
    model = language.train(docs, F.lit(True))
    out = model.predict(docs)
    assert out.columns == [*docs.columns, "lang_pred", "score", "rejected"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    for i, text, _ in ROWS:
        counts = plain_cells(text)
        if not any(c.isalpha() for c in text):
            assert got[i] == ("und", 0.0)
            continue
        v = {k: (1 + np.log(n)) * model.idf[k] for k, n in counts.items()}
        norm = sum(x * x for x in v.values()) ** 0.5
        cosines = [sum(x * model.centroids[k, c] for k, x in v.items()) / norm for c in range(model.centroids.shape[1])]
        best = int(np.argmax(cosines))
        assert got[i][1] == pytest.approx(min(1.0, cosines[best]), abs=1e-5)
        assert max(c for c, o in zip(cosines, model.owners, strict=True) if model.languages[o] == got[i][0]) == pytest.approx(cosines[best], abs=1e-5)


def test_a_language_score_depends_on_its_text_alone(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    model = language.train(docs, F.lit(True))
    again = language.train(docs.orderBy(F.desc("doc_id")).repartition(3), F.lit(True))
    assert (model.centroids == again.centroids).all()
    together = {r.doc_id: (r.lang_pred, r.score) for r in model.predict(docs.coalesce(1)).collect()}
    apart = {r.doc_id: (r.lang_pred, r.score) for r in model.predict(docs.coalesce(1).orderBy(F.desc("text"))).collect()}
    assert together == apart
    single = [r.lang_pred for r in model.predict(spark.createDataFrame([("a",), ("É",)], "text string")).collect()]
    assert all(x in model.languages for x in single)


def plain_tokens(text):
    kind = lambda b: 0 if b in (9, 10, 11, 12, 13, 32) else 2 if 48 <= b <= 57 else 1 if b >= 128 or chr(b).isalpha() else 3
    out, last = [], 0
    for b in (text or "").encode():
        k = kind(b)
        if k and k == last:
            out[-1].append(b)
        elif k:
            out.append([b])
        last = k
    return [bytes(x) for x in out]


def cell_of(token):
    data = np.frombuffer(token, np.uint8)
    return int(words.hashes(data, np.array([0]), np.array([len(data)]))[0] >> np.uint64(64 - quality.VOCABULARY_BITS))


def test_quality_features_equal_plain_random_indexing(spark):
    texts = [*TEXTS, None, "", "12%abc"]
    vectors = quality.word_vectors(spark.createDataFrame([(t,) for t in texts], "text string"))
    sums, counts = np.zeros((quality.VOCABULARY, quality.DIM)), np.zeros(quality.VOCABULARY)
    tokens = [[cell_of(t) for t in plain_tokens(x)] for x in texts]
    for line in tokens:
        for i, x in enumerate(line):
            counts[x] += 1
            for y in line[max(0, i - quality.WINDOW) : i] + line[i + 1 : i + 1 + quality.WINDOW]:
                for k in range(2):
                    sums[x, quality._POSITION[y, k]] += quality._SIGN[y, k]
    unit = sums / np.maximum(1e-9, np.linalg.norm(sums, axis=1, keepdims=True))
    want = unit * (1e-2 / (1e-2 + counts / counts.sum()))[:, None]
    assert np.allclose(vectors, np.where(counts[:, None] > 0, want, 0), atol=1e-6)
    network = quality.fit(np.random.RandomState(0).randn(40, 2 * quality.DIM), np.arange(40) % 2.0)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality.QualityModel(vectors, network).transform(docs).collect()}
    for i, line in enumerate(tokens):
        drawn = vectors[line].astype(float) if line else np.zeros((1, quality.DIM))
        x = np.concatenate([drawn.mean(0), (drawn * drawn).mean(0)])
        h = np.tanh((x - network.mean) / network.scale @ network.w1 + network.b1) @ network.w2 + network.b2
        assert got[i] == pytest.approx(1 / (1 + np.exp(-h / network.temperature)), abs=1e-6)
