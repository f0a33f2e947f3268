"""Search over chunks: vectors by cosine, words by BM25, and top rows by score."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolex.functions.text import let
from cartolex.operators.numbering import numbered
from cartolex.staging import stage

#: BM25 parameters.
K1, B = 1.2, 0.75
#: A word, in texts and queries alike.
WORD = r"([\p{L}\p{N}_]+)"

#: Words that follow one another in a text.
Clause = tuple[str, ...]


def dot(a: Column, b: Column) -> Column:
    """The inner product of two arrays, in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null where either is null or has no length."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def vector_top_k(rows: DataFrame, key: str, vector: str, query: Sequence[float], k: int = 5) -> DataFrame:
    """The ``k`` rows nearest one query vector: a scan and a top-k, no sort of the whole."""
    q = F.array(*[F.lit(float(x)) for x in query])
    scored = rows.where(F.col(vector).isNotNull()).select(key, cosine(F.col(vector), q).alias("score"))
    return scored.where("score is not null").orderBy(F.desc("score"), key).limit(k)


def tokens(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), 1)


def vector_top_k_of(rows: DataFrame, key: str, vector: str, query: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` rows nearest the one vector of ``query`` (one row, one column); nothing if it has no row."""
    q = query.select(F.col(query.columns[0]).alias("_query")).limit(1)
    scored = rows.where(F.col(vector).isNotNull()).join(F.broadcast(q)).select(key, cosine(F.col(vector), F.col("_query")).alias("score"))  # q: one row
    return scored.where("score is not null").orderBy(F.desc("score"), key).limit(k)


def clauses(spark: SparkSession, query: str) -> list[Clause]:
    """A query's clauses, each once: its words, and as a clause of several words what stands between double quotes.

    Words are cut as those of texts are, by the same expression: ``dell'articolo`` is two words, ``n.`` is one.
    """
    pieces = [(quoted, plain) for quoted, plain in re.findall(r'"([^"]*)"?|([^"]+)', query)]
    cut = spark.range(1).select(F.array(*[tokens(F.lit(q or p)) for q, p in pieces], F.array().cast("array<string>"))).first()[0]
    found = [(tuple(words),) if quoted else [(w,) for w in words] for (quoted, _), words in zip(pieces, cut, strict=False) if words]
    return sorted({c for some in found for c in some})


def _count(words: Column, clause: Clause) -> Column:
    """How often a clause stands in a text's words."""
    if len(clause) == 1:
        return F.size(F.filter(words, lambda w: w == clause[0]))
    here = lambda w, i: reduce(lambda a, b: a & b, [F.coalesce(F.get(words, i + j) == x, F.lit(False)) for j, x in enumerate(clause)])
    return F.size(F.filter(words, here))


def bm25(rows: DataFrame, key: str, text: str, query: str, k: int = 10) -> DataFrame:
    """The ``k`` rows that fit a query best, from the texts themselves; ``"..."`` asks for words that follow one another.

    Texts are read and cut into words once; lengths and counts of the query's clauses are staged, and both
    the corpus's figures and the scores come from that narrow table.
    """
    wanted = clauses(rows.sparkSession, query)
    counts = lambda w: F.struct(F.size(w).alias("length"), *[_count(w, c).alias(f"t{i}") for i, c in enumerate(wanted)])
    words = rows.where(F.col(text).isNotNull()).select(F.col(key).alias("_key"), let(tokens(F.col(text)), counts).alias("c"))
    counted = stage(words.select("_key", "c.*"), "term_counts")
    stats = counted.agg(F.count("*").alias("n"), F.avg("length").alias("mean"), *[F.count_if(F.col(f"t{i}") > 0).alias(f"d{i}") for i in range(len(wanted))])
    hit = counted.where(F.greatest(F.lit(0), F.lit(0), *[F.col(f"t{i}") for i in range(len(wanted))]) > 0)
    score = F.lit(0.0)
    for i in range(len(wanted)):
        idf = F.log(1 + (F.col("n") - F.col(f"d{i}") + 0.5) / (F.col(f"d{i}") + 0.5))
        f = F.col(f"t{i}")
        score = score + idf * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    scored = hit.join(F.broadcast(stats)).select("_key", score.alias("score")).where("score > 0")  # stats: one row
    return scored.orderBy(F.desc("score"), "_key").limit(k).select(F.col("_key").alias(key), "score")


def top_by_score(edge_rows: DataFrame, dst: str, k: int = 10) -> DataFrame:
    """The sources of the best scored edges to one node."""
    return edge_rows.where(F.col("dst") == dst).orderBy(F.desc("relevanceScore"), "src").limit(k).select("src", "relevanceScore")


def most_linked(edge_rows: DataFrame, k: int = 20) -> DataFrame:
    """The nodes with most edges."""
    return edge_rows.groupBy("dst").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dst").limit(k)


def systematic_sample(rows: DataFrame, order: Sequence[str], every: int, limit: int = 0) -> DataFrame:
    """Every ``every``-th of the first ``limit`` rows in order, from the first on; 0 and 1 mean all.

    ``order`` must tell any two rows apart. No task sees more than one range of rows; see :func:`numbered`.
    """
    if limit:
        rows = rows.orderBy(*order).limit(limit)
    if every <= 1:
        return rows
    return numbered(rows, order, name="_place").where(F.col("_place") % every == 0).drop("_place")
