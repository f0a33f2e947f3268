"""Sentences and overlapping chunks, folded inside each row: no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolex.functions.text import let, strip

#: Characters a token stands for, and the length under which a text is one chunk (fixed values).
CHARS_PER_TOKEN, SHORT = 4, 100


def sentences(text: Column) -> Column:
    """Texts cut after ``.``, ``!`` or ``?`` and white space; stripped, empties dropped, the text itself if none is left."""
    def trimmed(cuts: Column) -> Column:  # only the outer cuts may begin or end with white space
        outer = lambda s, i: F.when((i == 0) | (i == F.size(cuts) - 1), strip(s)).otherwise(s)
        return F.filter(F.transform(cuts, outer), lambda s: s != "")

    parts = let(F.split(text, r"(?U)(?<=[.!?])\s+", -1), trimmed)
    return let(parts, lambda p: F.when(F.size(p) > 0, p).otherwise(F.array(text)))


def overlap_tail(buffer: Column, chars: int) -> Column:
    """The last ``chars`` of a buffer, from its first sentence start on if it holds one."""
    tail = F.substring(buffer, -chars, chars)
    return F.when(F.length(buffer) <= chars, buffer).when(tail.rlike(r"(?U)[.!?]\s+"), F.regexp_replace(tail, r"(?Us)^.*?[.!?]\s+", "")).otherwise(tail)


def chunk_texts(text: Column, size: int = 512, overlap: int = 50) -> Column:
    """The chunks of a text as an array.

    Sentences fill a buffer until the next would pass ``size`` tokens; the next buffer starts with the
    overlap of the last. A sentence is never cut. A null text has one null chunk.

    The fold carries where the buffer's sentences begin, its overlap and its length; a buffer's text is made
    once, when it is full.
    """
    most, tail = size * CHARS_PER_TOKEN, overlap * CHARS_PER_TOKEN
    start = F.struct(F.lit(0).alias("first"), F.lit(0).alias("next"), F.lit("").alias("head"), F.lit(0).alias("chars"), F.array().cast("array<string>").alias("done"))

    def fold(parts: Column) -> Column:
        def buffer(acc: Column) -> Column:
            held = F.array_join(F.slice(parts, acc["first"] + 1, acc["next"] - acc["first"]), " ")
            return F.concat(acc["head"], F.lit(" "), held)

        def emit(acc: Column, s: Column) -> Column:
            def cut(text: Column) -> Column:
                return F.struct(overlap_tail(text, tail).alias("head"), strip(text).alias("chunk"))

            def begin(x: Column) -> Column:
                return F.struct(acc["next"].alias("first"), (acc["next"] + 1).alias("next"), x["head"].alias("head"), (F.length(x["head"]) + 1 + F.length(s)).alias("chars"), F.concat(acc["done"], F.array(x["chunk"])).alias("done"))

            return let(let(buffer(acc), cut), begin)

        def step(acc: Column, s: Column) -> Column:
            full = (acc["next"] > 0) & (acc["chars"] + F.length(s) > most)
            more = F.struct(acc["first"], (acc["next"] + 1).alias("next"), acc["head"], (acc["chars"] + 1 + F.length(s)).alias("chars"), acc["done"])
            return F.when(full, emit(acc, s)).otherwise(more)

        def finish(acc: Column) -> Column:
            return let(strip(buffer(acc)), lambda last: F.when(last != "", F.concat(acc["done"], F.array(last))).otherwise(acc["done"]))

        return F.aggregate(parts, start, step, finish)

    return F.when(text.isNull() | (F.length(text) < SHORT), F.array(text)).otherwise(let(sentences(text), fold))


def chunk_sections(sections: DataFrame, size: int = 512, overlap: int = 50) -> DataFrame:
    """Chunk records of section records; ``nextChunkId`` is the section's following chunk, null for its last."""
    numbered = let(chunk_texts(F.col("content"), size, overlap), lambda c: F.transform(c, lambda piece, i: F.struct(piece.alias("piece"), i.alias("i"), (i < F.size(c) - 1).alias("more"))))
    made = sections.select("documentId", "sectionId", "pageNumber", "sectionNumber", "sectionType", F.explode(numbered).alias("c"))
    key = lambda at: F.concat_ws("_", "sectionId", F.lit("CHK"), at.cast("string"))
    return made.select(
        key(F.col("c.i")).alias("chunkId"),
        "documentId",
        "sectionId",
        F.col("c.piece").alias("content"),
        F.col("c.i").alias("chunkIndex"),
        "pageNumber",
        F.create_map(F.lit("section_number"), "sectionNumber", F.lit("section_type"), "sectionType").alias("metadata"),
        F.lit(None).cast("array<float>").alias("embedding"),
        F.when(F.col("c.more"), key(F.col("c.i") + 1)).alias("nextChunkId"),
    )
