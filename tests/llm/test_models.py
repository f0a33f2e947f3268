"""Quality, language and LM models: held-out accuracy, plain versions, odd rows."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartolex.llm import language, lm_scoring, quality

WORDS = {"en": "the and of that with from this which house river", "de": "der die und das nicht mit einem welche haus fluss", "it": "il la che non con una questo quale casa fiume"}
ODD = [(9001, None, None), (9002, "", "en"), (9003, " \n", None), (9004, "123 !!!", "de"), (9005, "the " * 60_000, "en"), (None, "der die und", "de")]


def documents(spark, n=300):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        good = rng.random() < 0.6
        words = [rng.choice(WORDS[lang].split()) + ("" if good else rng.choice(["!!", "***", "$$"])) for _ in range(rng.randint(5, 80))]
        rows.append((i, " ".join(words), lang, int(good)))
    docs = spark.createDataFrame([r[:3] for r in rows] + ODD, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(0, rows[0][3]), (9002, None), (None, 1)], "doc_id long, quality int")
    return docs, labels, rows


def test_quality_held_out(spark):
    docs, labels, rows = documents(spark)
    model = quality.train(docs, labels, F.coalesce(F.col("doc_id") % 4 != 2, F.lit(False)))
    out = model.transform(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    got = {r.doc_id: r.score for r in out.collect()}
    held = [(got[i], y) for i, _, _, y in rows if i % 4 == 2]
    assert np.mean([(s >= 0.7) == y for s, y in held]) > 0.9
    assert all(0 <= s <= 1 for s in got.values()) and got[9001] == got[9002] == got[9003]


def test_word_vectors_count_whole_texts_alike_in_any_order(spark):
    docs, _, _ = documents(spark, 60)
    a = quality.word_vectors(docs.select("text"))
    b = quality.word_vectors(docs.select("text").orderBy(F.desc("text")).repartition(3))
    assert (a == b).all()


def test_quality_without_labels_or_rows(spark):
    docs, labels, _ = documents(spark, 10)
    scores = [r.score for r in quality.train(docs, labels.limit(0), F.lit(True)).transform(docs).collect()]
    assert scores == [0.5] * len(scores)
    assert quality.train(docs.limit(0), labels, F.lit(True)).transform(docs.limit(0)).count() == 0


def test_language_held_out(spark):
    docs, _, rows = documents(spark)
    model = language.train(docs, F.coalesce(F.col("doc_id") % 3 != 1, F.lit(False)))
    out = model.predict(docs)
    got = {r.doc_id: r for r in out.collect()}
    assert np.mean([got[i].lang_pred == lang for i, _, lang, _ in rows if i % 3 == 1]) > 0.95
    assert not any(got[i].rejected for i, *_ in rows)
    for i in (9001, 9002, 9003, 9004):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[9005].lang_pred == "en" and got[None].lang_pred == "de"
    foreign = spark.createDataFrame([(1, "щука плыла по реке мимо большого дома и смотрела вокруг " * 3)], "doc_id long, text string")
    assert model.predict(foreign).first().rejected


def test_language_without_training_rows(spark):
    docs, _, _ = documents(spark, 5)
    assert {r.lang_pred for r in language.train(docs, F.lit(False)).predict(docs).collect()} == {"und"}
    assert language.train(docs, F.lit(True)).predict(docs.limit(0)).count() == 0


def plain_losses(texts, marked, size):
    """The same models over dictionaries instead of cells."""
    from collections import Counter

    tokens = [(t or "").encode().lower().split() for t in texts]
    vocabulary = {w for w, _ in Counter(w for t in tokens for w in t).most_common(size)}
    known = [[w if w in vocabulary else None for w in t] for t in tokens]
    out = []
    for use in (lambda i: True, lambda i: marked[i]):
        uni, bi, history = Counter(), Counter(), Counter()
        for i, t in enumerate(known):
            if use(i):
                uni.update(t)
                bi.update(zip(["<s>", *t], t, strict=False))
                history.update(["<s>"] * bool(t) + t)
        total, n = max(1, sum(uni.values())), len(vocabulary) + 1
        losses = []
        for t in known:
            loss = []
            for before, w in zip(["<s>", *t], t, strict=False):
                h, u = history[before], uni[w] / total
                p = (lm_scoring.BIGRAM * bi[before, w] / h + lm_scoring.UNIGRAM * u) if h else (lm_scoring.BIGRAM + lm_scoring.UNIGRAM) * u
                loss.append(-np.log(p + lm_scoring.UNIFORM / n))
            losses.append(np.mean(loss) if loss else None)
        out.append(losses)
    return out


def test_lm_scores_equal_plain_counts(spark):
    rng = random.Random(9)
    few = WORDS["it"].split()  # so few bigrams that no two share a cell
    rows = [(i, " ".join(rng.choice(few[: 4 + 6 * (i % 2)]) for _ in range(rng.randint(1, 40))), "it", i % 2) for i in range(80)]
    docs = spark.createDataFrame([r[:3] for r in rows] + ODD, "doc_id long, text string, lang string").withColumn("n_words", F.lit("old"))
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(1, 1), (None, 1)], "doc_id long, quality int")
    texts = [r[1] for r in rows] + [t for _, t, _ in ODD]
    ids = [r[0] for r in rows] + [i for i, *_ in ODD]
    good = {r[0] for r in rows if r[3]}
    background, target = plain_losses(texts, [i in good for i in ids], 1 << 15)
    model = lm_scoring.train(docs, labels.where("quality = 1").select("doc_id"))
    out = model.score(docs)
    got = {r.doc_id: r for r in out.collect()}
    assert set(docs.columns) < set(out.columns) and out.count() == docs.count()
    for i, b, t in zip(ids, background, target, strict=True):
        if b is None:
            assert (got[i].n_words, got[i].ce_target, got[i].ce_difference) == (0, None, None)
        else:
            assert got[i].ce_background == pytest.approx(b, rel=1e-5) and got[i].ce_difference == pytest.approx(t - b, abs=1e-5)


def test_lm_of_nothing(spark):
    docs, labels, _ = documents(spark, 5)
    assert lm_scoring.train(docs.limit(0), labels.select("doc_id")).score(docs.limit(0)).count() == 0
    assert lm_scoring.train(docs, labels.select("doc_id").limit(0)).score(docs).where("ce_difference is not null").count() == 8


def test_bigrams_of_one_text_do_not_reach_into_the_next():
    vocabulary = np.zeros(0, np.uint64)
    _, ids, cells, first = next(lm_scoring._bigrams(pa.array(["a b", None, "", "c"]), vocabulary))
    assert list(ids) == [0, 0, 0] and list(first) == [0, 2, 2, 2, 3] and cells[0] == cells[2] != cells[1]


def test_lm_counts_stay_exact_as_words_and_pairs_grow(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 200_000)
    monkeypatch.setattr(lm_scoring, "PART_BYTES", 300_000)
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{int(rng.random() ** 2 * 60_000)}" for _ in range(400))) for i in range(400)]  # more words than 2^15, and many pairs
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm_scoring.train(docs, docs.where("doc_id % 3 = 0").select(F.col("doc_id").cast("int")))
    assert model.blocks > 3 and model.parts > 1
    background, target = plain_losses([t for _, t in rows], [i % 3 == 0 for i, _ in rows], 1 << 30)
    for scored in (docs, docs.where("doc_id < 100").withColumn("more", F.lit(1))):  # the same documents, and a part of them
        got = {r.doc_id: r for r in model.score(scored).collect()}
        assert len(got) == scored.count()
        for i in got:
            assert got[i].ce_background == pytest.approx(background[i], rel=1e-9) and got[i].ce_target == pytest.approx(target[i], rel=1e-9)
    new = model.score(spark.createDataFrame([("never seen",)], "text string")).first()
    assert new.n_words == 2 and new.ce_background == pytest.approx(-np.log(lm_scoring.UNIFORM / (len({w for _, t in rows for w in t.split()}) + 1)))


def test_lm_counts_climb_and_descend_a_tree_of_several_levels(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 8_000)
    monkeypatch.setattr(lm_scoring, "PART_BYTES", 30_000)
    monkeypatch.setattr(lm_scoring, "FAN", 4)
    rng = random.Random(8)
    rows = [(i % 150, " ".join(f"w{int(rng.random() ** 2 * 900)}" for _ in range(150))) for i in range(200)]  # some ids with two texts
    rows += [(7, f"hot id {i}") for i in range(300)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = lm_scoring.train(docs, docs.where("doc_id % 3 = 1").select("doc_id"))
    parts = lm_scoring.levels(model.blocks, model.size)
    assert len(parts) == 3 and parts[-1] > parts[0] > 0 and all(b % a == 0 for a, b in zip(parts, parts[1:], strict=False))
    background, target = plain_losses([t for _, t in rows], [i % 3 == 1 for i, _ in rows], 1 << 30)
    expected = sorted((i, round(b, 9), round(t, 9)) for (i, _), b, t in zip(rows, background, target, strict=True) if b is not None)
    for scored in (docs, docs.withColumn("more", F.lit(1))):  # counted documents themselves, and others that ask
        got = [(r.doc_id, round(r.ce_background, 9), round(r.ce_target, 9)) for r in model.score(scored).collect() if r.n_words]
        assert len(got) == len(expected)
        assert np.allclose(sorted(got), expected, atol=2e-9)


def test_lm_tree_keeps_rows_of_a_task_level():
    for size in (1 << 29, 30 << 30, 100 << 40):
        parts = lm_scoring.levels(-(-size // lm_scoring.BLOCK_BYTES), size)
        assert parts[0] <= lm_scoring.FAN * lm_scoring.BLOCK_BYTES // lm_scoring.PART_BYTES
        assert all(b // a <= lm_scoring.FAN for a, b in zip(parts, parts[1:], strict=False)) and parts[-1] < 1 << 32
