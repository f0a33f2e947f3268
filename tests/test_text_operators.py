"""Chunks, sections, metadata and tables of contents against plain models and worked cases."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from cartolex.functions.text import normalized_id, normalized_name
from cartolex.operators import chunks, metadata, sections, toc


def plain_sentences(text):
    parts = [p.strip() for p in re.split(r"(?<=[.!?])\s+", text)]
    return [p for p in parts if p] or [text]


def plain_chunks(text, size, overlap):
    if text is None or len(text) < 100:
        return [text]
    cur, out = "", []
    for s in plain_sentences(text):
        if cur and len(cur) + len(s) > size * 4:
            out.append(cur.strip())
            tail = cur if len(cur) <= overlap * 4 else cur[-overlap * 4 :]
            if tail != cur and (m := re.search(r"[.!?]\s+", tail)):
                tail = tail[m.end() :]
            cur = tail + " " + s
        else:
            cur = cur + " " + s
    return out + ([cur.strip()] if cur.strip() else [])


def random_text(rng, n):
    return "".join(rng.choice(["abc ", "È lungo ", "fine. ", "Che? ", "No!\n", " ", "x" * 30, ". "]) for _ in range(n))


def test_chunks_equal_the_plain_model(spark):
    rng = random.Random(3)
    texts = [random_text(rng, rng.randint(0, 120)) for _ in range(200)] + ["", "a" * 99, "a" * 100, "x" * 3000, None, "w. " * 900]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for size, overlap in ((512, 50), (40, 5)):
        got = {r.i: r.c for r in rows.select("i", chunks.chunk_texts(F.col("t"), size, overlap).alias("c")).collect()}
        assert all(got[i] == plain_chunks(t, size, overlap) for i, t in enumerate(texts))


def plain_sections(text):
    named = re.compile("|".join(sections.ITALIAN.named), re.I)
    numbered = re.compile("|".join(sections.ITALIAN.numbered))
    lines, out, cur = text.split("\n"), [], None

    def flush(n):
        body = "\n".join(cur[2]).strip()
        if cur[2]:
            out.append((cur[0][:200], cur[1], body, n // 50 + 1))

    for n, line in enumerate(lines, 1):
        s = line.strip()
        if not s:
            continue
        kind = "named" if named.match(s) else "numbered" if numbered.match(s) else None
        if kind:
            if cur:
                flush(n)
            cur = (s, kind, [])
        elif cur:
            cur[2].append(s)
    if cur:
        flush(len(lines))
    levels = [m.group(0).count(".") + 1 if (m := re.match(r"\d+(\.\d+)*", t)) else 1 for t, *_ in out]
    stack, parents = {}, []
    for i, level in enumerate(levels):
        parents.append(stack.get(level - 1) if level > 1 else None)
        stack = {k: v for k, v in stack.items() if k < level} | {level: i}
    return [(*x, level, parent) for x, level, parent in zip(out, levels, parents, strict=True)]


def test_sections_equal_the_plain_model(spark):
    rng = random.Random(5)
    lines = ["PREMESSA", "1. Ambito", "1.1 Oggetto del caso", "1.1.1 Prova", "2. è vero", "testo di prova", "", "  altro testo  ", "Oggetto dell’interpello", "2 PARERE SULLE SPESE", "1.1. Titolo", "RISPOSTE", "Risposta n. 204"]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randint(1, 160))) for _ in range(60)] + [""]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "documentId string, fullText string")
    got: dict[str, list] = {}
    for r in sections.sections(docs).orderBy("order").collect():
        parent = r.parentSectionId and int(r.parentSectionId.rsplit("_", 1)[1])
        got.setdefault(r.documentId, []).append((r.title, r.sectionType, r.content, r.pageNumber, r.level, parent))
    assert all(got.get(str(i), []) == plain_sections(t) for i, t in enumerate(texts))


@pytest.mark.parametrize(
    ("line", "kind", "number", "level"),
    [
        ("Oggetto dell’interpello", "named", "OGGETTO DELL", 1),
        ("Risposta n. 204", "named", "RISPOSTA N", 1),
        ("risposta al contribuente è", "named", "RISPOSTA AL CONTRIBUENTE È", 1),
        ("1.1 Titolo", "numbered", "1.1", 2),
        ("1.1. Titolo", None, None, None),
        ("1. è", "numbered", "1", 1),
        ("2 PARERE SULLE SPESE VARIE", "numbered", "2", 1),
        ("RISPOSTE", None, None, None),
    ],
)
def test_headers(spark, line, kind, number, level):
    row = spark.createDataFrame([(line,)], "s string").select(sections.ITALIAN.kind(F.col("s")).alias("k"), sections.number(F.col("s"), F.lit(kind)).alias("n"), sections.level(F.col("s")).alias("l")).first()
    assert row.k == kind
    if kind:
        assert (row.n, row.l) == (number, level)


def test_toc_filter_renumbers_but_keeps_ids(spark):
    text = "INDICE\n1.1 voce\nPREMESSA\n" + "x" * 120 + "\n1. Uno\ncorpo"
    docs = spark.createDataFrame([("d", text)], "documentId string, fullText string")
    tocs = spark.createDataFrame([("d", 1, 1)], "documentId string, startPage int, endPage int")
    got = [(r.sectionId, r.order) for r in sections.sections(docs, tocs).orderBy("order").collect()]
    assert got == [("d_SEC_1", 0)]


def test_metadata(spark):
    rows = [
        ("a.pdf", "Circolare n. 20 del 13/05/2011\n", ("Circolare", "20/d", 2011), "CIR_20_d_2011"),
        ("b.pdf", "Circolare N. 9/E del 24 giugno 2025", ("Circolare", "9/E", 2025), "CIR_9_E_2025"),
        ("Circolare_9_2025.pdf", "CIRCOLARE N. 9/E\nRoma, 24 giugno 2025", ("Circolare", "9", 2025), "CIR_9_2025"),
        ("x.pdf", "niente", ("Unknown", "unknown", 2024), "UNK_unknown_2024"),
        ("Risposta_7.pdf", "", ("Risposta", "7", 2024), "RIP_7_2024"),
    ]
    df = spark.createDataFrame([(f, c) for f, c, *_ in rows], "f string, c string").select(metadata.kind(F.col("f"), F.col("c"), F.lit(2024)).alias("k"))
    got = df.select("k.*", metadata.document_id(F.col("k.type"), F.col("k.number"), F.col("k.year")).alias("d")).collect()
    assert [((r.type, r.number, r.year), r.d) for r in got] == [(k, d) for *_, k, d in rows]


def test_subject_and_title(spark):
    df = spark.createDataFrame([("f", "12345678901234\n  Un  titolo lungo\nOGGETTO: una\n cosa \n\naltro"), ("f", "x")], "f string, t string")
    got = df.select(metadata.subject(F.col("t")).alias("s"), metadata.title(F.col("t"), F.col("f")).alias("t")).collect()
    assert [tuple(r) for r in got] == [("una cosa", "Un titolo lungo"), ("No OGGETTO found", "f")]


def pages_of(spark, docs):
    return spark.createDataFrame([(d, i + 1, t) for d, pages in docs.items() for i, t in enumerate(pages)], "documentId string, page_no int, text string")


def test_tocs(spark):
    docs = {
        "a": ["p1", "INDICE\n1.1 Ambito 4\n1. Uno 4\nPREMESSA ..... 4", "2. Due 5", "Premessa qui", "fine"],
        "b": ["p1", "sommario\n1.1 Ambito .... 3", "1.1 Ambito", "fine"],
        "c": ["p1", "PREMESSA ..... 3", "nulla"],
        "d": ["solo una"],
    }
    records = spark.createDataFrame([(d, "Circolare", len(p)) for d, p in docs.items()], "documentId string, type string, pageCount int")
    got = {r.documentId: (r.endPage, r.detectionMethod, r.hasHeader, r.headerText, r.entryCount, r.rawText) for r in toc.tocs(records, pages_of(spark, docs)).collect()}
    assert got == {"a": (3, "PREMESSA", True, "INDICE", 3, docs["a"][1] + "\n" + docs["a"][2]), "b": (2, "FIRST_SECTION", True, "SOMMARIO", 1, docs["b"][1])}


def test_toc_entries(spark):
    plain = {"1.1 Ambito soggettivo 5": ("1.1", "Ambito soggettivo", 5), "1.1 Ambito soggettivo ...... 5": ("1.1", "Ambito soggettivo", 5), "1.1. Ambito soggettivo ......14": None, "PREMESSA ........12": None, "2 Detrazioni per spese 7": ("2", "Detrazioni per spese", 7)}
    dotted = {"1.1 Ambito soggettivo 5": None, "1.1 Ambito soggettivo ...... 5": ("1.1", "Ambito soggettivo", 5), "1.1. Ambito soggettivo ......14": ("1.1", "Ambito soggettivo", 14), "PREMESSA ........12": ("PREMESSA", "PREMESSA", 12), "1.1 Art. 16 del TUIR ..... 9": None, "3.2 Spese.....8": None}
    for cases, parse in ((plain, toc.plain_entries), (dotted, toc.dotted_entries)):
        df = spark.createDataFrame([(s,) for s in cases], "s string").select("s", parse(F.col("s")).alias("e"))
        assert {r.s: tuple(r.e[0]) if r.e else None for r in df.collect()} == cases


def test_normal_forms(spark):
    cases = {"50%": "T_50", "Eco-bonus": "T_eco_bonus", "eco bonus": "T_eco_bonus", "Ecobonus": "T_ecobonus", "Credito d'imposta": "T_credito_dimposta", " Ecobonus": "T__ecobonus", "pannelli  solari": "T_pannelli_solari"}
    df = spark.createDataFrame([(s,) for s in [*cases, "%"]], "s string").select("s", normalized_id(F.col("s")).alias("k"), normalized_name(F.col("s")).alias("n"))
    got = {r.s: (r.k, r.n) for r in df.collect()}
    assert {s: got[s][0] for s in cases} == cases
    assert got["%"][0] != "T_" and got[" Ecobonus"][1] == "ecobonus"


def test_long_numbers_are_null(spark):
    row = spark.range(1).select(toc.plain_entries(F.lit("1.1 Ambito 99999999999\n2 Altro 7")).alias("p"), toc.dotted_entries(F.lit("1.1 Telefono ..... 06123456789012\n")).alias("d")).first()
    assert [(e.section_number, e.page_number) for e in row.p] == [("1.1", None), ("2", 7)] and [e.page_number for e in row.d] == [None]
    docs = spark.createDataFrame([("d", "Circolare", 3)], "documentId string, type string, pageCount int")
    pages = spark.createDataFrame([("d", 2, "PREMESSA 99999999999\n1.1 x 3"), ("d", 3, "1.1 x")], "documentId string, page_no int, text string")
    assert [(r.endPage, r.detectionMethod) for r in toc.tocs(docs, pages).collect()] == [(2, "FIRST_SECTION")]


def test_parents_equal_the_plain_model(spark):
    rng = random.Random(5)
    levels = [[rng.randint(1, 5) for _ in range(rng.randint(0, 60))] for _ in range(50)]
    rows = spark.createDataFrame([(i, [(k, x) for k, x in enumerate(v)]) for i, v in enumerate(levels)], "i int, f array<struct<position:int,level:int>>")
    got = {r.i: r.p for r in rows.select("i", sections.parent_positions(F.col("f")).alias("p")).collect()}
    for i, v in enumerate(levels):
        nearest = [next((j for j in range(k - 1, -1, -1) if v[j] < x), None) for k, x in enumerate(v)]
        assert got[i] == [j if j is not None and v[j] == x - 1 else None for j, x in zip(nearest, v, strict=True)]
