"""Topics and keywords of sections: gates, extraction behind an interface, checks, keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartolex.functions.text import let, normalized_id, normalized_name, strip
from cartolex.operators.ledger import Ledger
from cartolex.operators.models import Call, each_item
from cartolex.schemas import ANALYSIS_KEYWORDS, ANALYSIS_TOPICS
from cartolex.staging import stage

#: Shortest section that is analysed (a fixed value).
LEAST_CHARS = 50
#: Words that make no keyword by themselves.
LEAST_WORD = 5

Extractor = Callable[[DataFrame], DataFrame]


def gate(content: Column) -> Column:
    """Whether a section is long enough."""
    return F.coalesce(F.length(strip(content)) >= LEAST_CHARS, F.lit(False))


def word_counts(text: Column, least: int = LEAST_WORD) -> Column:
    """``array<struct<word, n>>``: a text's distinct words of ``least`` letters or more; words are sorted once and runs measured."""
    words = F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)(\w+)"), 1), lambda w: F.length(w) >= least)

    def runs(s: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.greatest(F.size(s) - 1, F.lit(0))), lambda i: (F.size(s) > 0) & ((i == 0) | (F.get(s, i) != F.get(s, i - 1))))
        return let(begins, lambda at: F.transform(at, lambda i, k: F.struct(F.get(s, i).alias("word"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).alias("n"))))

    return let(F.sort_array(words), runs)


def lexicon_extractor(lexicon: dict[str, tuple[str, str]], keywords: int = 5) -> Extractor:
    """The offline default: topics whose pattern a section holds, and its best long words by TF-IDF.

    ``lexicon`` maps a topic's name to (description, pattern). A topic's score is its share of all topics'
    finds, a keyword's its TF-IDF over the section's highest. Words are counted inside the row; only (section, word,
    count) rows meet the corpus's document frequencies, and each task keeps a section's best before they are shuffled.
    """

    def topics_of(text: Column) -> Column:
        hits = [F.struct(F.lit(name).alias("name"), F.lit(about).alias("description"), F.regexp_count(text, F.lit("(?iuU)" + pattern)).cast("double").alias("n")) for name, (about, pattern) in lexicon.items()]
        if not hits:
            return F.array().cast(ANALYSIS_TOPICS)
        shares = lambda x: F.transform(x["found"], lambda h: F.struct(h["name"], h["description"], (h["n"] / x["total"]).alias("relevance_score")))
        summed = lambda found: F.struct(found.alias("found"), F.aggregate(found, F.lit(0.0), lambda a, h: a + h["n"]).alias("total"))
        return let(let(F.filter(F.array(*hits), lambda h: h["n"] > 0), summed), shares).cast(ANALYSIS_TOPICS)

    def extract(sections: DataFrame) -> DataFrame:
        counted = stage(sections.select("sectionId", topics_of(F.lower("content")).alias("topics"), word_counts(F.col("content")).alias("words")), "section_words")
        tf = counted.select("sectionId", F.explode("words").alias("w")).select("sectionId", "w.word", "w.n")
        df = stage(tf.groupBy("word").agg(F.count("*").alias("df")), "document_frequencies")  # a table of known size: a small one is broadcast, and (section, word) rows stay where they are
        size = counted.agg(F.count("*").alias("sections"))
        weighed = tf.join(df, "word").join(F.broadcast(size)).select("sectionId", "word", (F.col("n") * (F.log((1 + F.col("sections")) / (1 + F.col("df"))) + 1)).alias("weight"))  # size: one row
        place = F.row_number().over(Window.partitionBy("sectionId").orderBy(F.desc("weight"), "word"))
        best = weighed.withColumn("place", place).where(F.col("place") <= keywords)
        ranked = best.groupBy("sectionId").agg(F.sort_array(F.collect_list(F.struct("place", "word", "weight"))).alias("b"))
        scored = F.transform("b", lambda x: F.struct(x["word"].alias("keyword"), (x["weight"] / F.get("b", F.lit(0))["weight"]).alias("relevance_score"))).cast(ANALYSIS_KEYWORDS)
        return counted.join(ranked, "sectionId", "left").select("sectionId", "topics", F.coalesce(scored, F.array().cast(ANALYSIS_KEYWORDS)).alias("keywords"))

    return extract


def model_extractor(call: Call, max_concurrent: int | None = 10, kept: Ledger | None = None) -> Extractor:
    """An extractor that asks ``call`` for each section's dict of topics and keywords; a section whose call fails has no analysis. With a ledger, only what it lacks is asked."""

    def extract(sections: DataFrame) -> DataFrame:
        said = each_item(sections, "sectionId", "content", call, f"struct<topics:{ANALYSIS_TOPICS},keywords:{ANALYSIS_KEYWORDS}>", max_concurrent, kept)
        none = lambda c, kind: F.coalesce(F.col(f"result.{c}"), F.array().cast(kind)).alias(c)
        return said.where("error is null").select("sectionId", none("topics", ANALYSIS_TOPICS), none("keywords", ANALYSIS_KEYWORDS))

    return extract


def analyses(sections: DataFrame, extractor: Extractor) -> DataFrame:
    """(sectionId, topics, keywords) of the sections that pass the gate and yield something valid.

    One score outside 0 to 1 makes a section's whole analysis invalid.
    """
    made = extractor(sections.where(gate(F.col("content"))))
    within = lambda x: x["relevance_score"].between(0.0, 1.0)
    valid = F.forall("topics", within) & F.forall("keywords", within)
    return made.where(valid & ((F.size("topics") > 0) | (F.size("keywords") > 0)))


def topic_rows(found: DataFrame) -> DataFrame:
    """One row for each topic of each section: (sectionId, topicId, name, description, normalizedName, relevanceScore, position)."""
    x = found.select("sectionId", F.posexplode("topics").alias("position", "t"))
    name = F.col("t.name")
    return x.select("sectionId", normalized_id(name).alias("topicId"), name.alias("name"), F.col("t.description").alias("description"), normalized_name(name).alias("normalizedName"), F.col("t.relevance_score").alias("relevanceScore"), "position")


def keyword_rows(found: DataFrame) -> DataFrame:
    """One row for each keyword of each section: (sectionId, keywordId, name, normalizedName, relevanceScore, position)."""
    x = found.select("sectionId", F.posexplode("keywords").alias("position", "k"))
    name = F.col("k.keyword")
    return x.select("sectionId", normalized_id(name).alias("keywordId"), name.alias("name"), normalized_name(name).alias("normalizedName"), F.col("k.relevance_score").alias("relevanceScore"), "position")
