"""A corpus pipeline over ``documents``: quality, language, near-dedup, mixing, tokens.

Each stage is one training-data operator applied to all that its predecessor kept. A stage that filters
returns exactly the columns it was given, with their own values, whatever they are called; the last returns
token ids in place of texts.

Any column may hold nulls, ids may repeat, and there may be further columns of any name: each stage says what it does
with them. A stage of an empty table is empty and has the columns it would have.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolex.llm import mixing, near_dedup, pieces, queries
from cartolex.staging import new_path, release, released_after

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document goes if its calibrated chance of good quality is below this; lower than the classifier's own
#: cut of 0.7, so that clean documents in a style the labels hardly show are kept. The README has what the lower cut lets through.
LEAST_QUALITY = 0.4


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns c0, c1, ..., and their names by the given ones, so that no operator's column clashes with one of theirs."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names, strict=True))


def _given(plain: DataFrame, docs: DataFrame) -> DataFrame:
    return plain.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects.

    Null and empty texts are scored like any other, and alike; repeated rows are scored alike and stay or go together. Null ids and sources
    play no part; a label without a document, or of a repeated id, teaches once. Without any usable label nothing can be learned, and all
    documents have a score of one half and stay.
    """
    plain, c = _plain(docs)
    scored = queries.quality_model(spark, docs, sf_dir).transform(plain, c["text"], "quality_score")
    return _given(scored.where(F.col("quality_score") >= LEAST_QUALITY), docs)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that language ID rejects.

    Null texts, and those without a letter, are rejected; repeated rows are judged alike. A null lang teaches nothing and is no reason to go.
    If no language can be learned (all langs null, or no text with a letter), all documents are rejected.
    """
    plain, c = _plain(docs)
    return _given(queries.language_model(docs).predict(plain, c["text"]).where(~F.col("rejected")), docs)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: that of the smallest doc_id.

    Documents without a word (null and empty texts too) are like nothing else and stay. All rows of one id are one document, of which
    one row stays. Rows with a null id all stay.
    """
    plain, c = _plain(docs)
    return _given(near_dedup.keep_first(plain, c["doc_id"], c["text"]), docs)


def keep_sampled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents sampled to the target mix.

    A null source or language is a value of its own. A document without words weighs nothing and
    follows its cell; it is kept where the whole cell has no words. Equal ids have equal draws, so those of one cell stay or go together.
    """
    plain, c = _plain(docs)
    return _given(mixing.mix(plain, id_col=c["doc_id"], text_col=c["text"], source_col=c["source"], lang_col=c["lang"]).where("sampled"), docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document: doc_id, source, lang, and the encoder's columns; further columns go.

    Null and empty texts have no ids. Repeated rows are encoded alike, each by itself; texts of any length are encoded whole.
    """
    plain = docs.select("doc_id", "source", "lang", "text")
    return pieces.encode(plain, queries.PIECE_MODEL).drop("text")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("language ID", keep_known_language),
    ("MinHash near-dedup", keep_distinct),
    ("mixing sources", keep_sampled),
    ("SentencePiece encoding", to_pieces),
]
#: Trained models and 64-bit hashes are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each one's rows are written before the next reads them.

    What a stage staged for itself, and the rows that it read, are deleted as soon as its own rows are written.
    """
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, step) in enumerate(STAGES):
        with released_after():
            made = step(spark, docs, sf_dir)
            made.write.parquet(path := new_path(spark, f"stage_{k}"))
        docs = spark.read.schema(made.schema).parquet(path)
        if read is not None:
            release(read)
        read = docs
    return docs
