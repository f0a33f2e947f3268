"""Summaries of runs and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The cost model of an embedding service: tokens a chunk, and dollars a million tokens (fixed values).
TOKENS_A_CHUNK, DOLLARS_A_MILLION = 600, 0.020


def processing_summary(results: DataFrame) -> DataFrame:
    """Counts, sums and mean time of processing results."""
    n = F.count("*")
    return results.agg(
        n.alias("total"),
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.sum("sections_count"), F.lit(0)).alias("sections"),
        F.coalesce(F.sum("chunks_count"), F.lit(0)).alias("chunks"),
        F.coalesce(F.sum("processing_time"), F.lit(0.0)).alias("seconds"),
        F.try_divide(F.sum("processing_time"), n).alias("avg_seconds"),
        F.count_if("toc_extracted").alias("docs_with_toc"),
        F.coalesce(F.sum("toc_pages"), F.lit(0)).alias("toc_pages"),
        F.try_divide(100.0 * F.count_if("success"), n).alias("success_percent"),
    )


def file_tags(filename: Column) -> Column:
    """The classes a file name shows; more than one may fit."""
    return F.filter(F.array(F.when(filename.contains("Circolare") | filename.contains("CIRCOLARE"), "Circolare"), F.when(filename.contains("Ris_"), "Risoluzione"), F.when(filename.contains("Risposta"), "Risposta")), lambda t: t.isNotNull())


def breakdown(results: DataFrame) -> DataFrame:
    """Documents, sections and chunks of successful results by file class."""
    tagged = results.where("success").select(F.explode(file_tags(F.col("filename"))).alias("docType"), "sections_count", "chunks_count")
    return tagged.groupBy("docType").agg(F.count("*").alias("documents"), F.sum("sections_count").alias("sections"), F.sum("chunks_count").alias("chunks"))


def yield_summary(items: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """How many finds there are, how many items have any, and means over all items and over those."""
    total = items.agg(F.count("*").alias("items"))
    got = found.agg(F.count("*").alias("found"), F.count_distinct(key).alias("with_any"))
    return total.join(got).select("items", "found", "with_any", F.try_divide("found", "items").alias("avg_all"), F.try_divide("found", "with_any").alias("avg_with_any"))


def embedding_summary(chunks: DataFrame) -> DataFrame:
    """Chunks, those with a vector, their share, and the cost of all."""
    n, e = F.count("*"), F.count("embedding")
    return chunks.agg(n.alias("chunks"), e.alias("embedded"), F.try_divide(100.0 * e, n).alias("percent"), (n * TOKENS_A_CHUNK * DOLLARS_A_MILLION / 1_000_000).alias("dollars"))


def download_summary(fetched: DataFrame) -> DataFrame:
    """Total, good and failed fetches."""
    return fetched.agg(F.count("*").alias("total"), F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("failed"))
