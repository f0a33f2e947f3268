"""Quality reports: tables of contents against sections, and invariants of a finished graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolex.functions.text import strip


def set_compare(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of both sides with status: both, left_only or right_only; one full outer join."""
    a = left.select(*keys).distinct().withColumn("_l", F.lit(True))
    b = right.select(*keys).distinct().withColumn("_r", F.lit(True))
    status = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left_only").otherwise("right_only")
    return a.join(b, keys, "full_outer").select(*keys, status.alias("status"))


def last_of_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key."""
    values = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("v")).select(*keys, "v.*")


def titles_differ(toc_title: Column, title: Column) -> Column:
    """Whether two titles share neither text nor half of the first one's words."""
    a = F.upper(strip(toc_title))
    b = F.regexp_replace(F.upper(strip(title)), r"(?U)^\d+(?:\.\d+)*\s+", "")
    words = lambda c: F.array_distinct(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != ""))
    share = F.size(F.array_intersect(words(a), words(b))) / F.greatest(F.size(words(a)), F.lit(1))
    return ~b.contains(a) & ~a.contains(b) & (share < 0.5)


def pages_differ(toc_page: Column, page: Column) -> Column:
    """Whether two pages are more than one apart."""
    return F.abs(toc_page - page) > 1


def compare_tocs(entries: DataFrame, sections: DataFrame) -> DataFrame:
    """One row for each (documentId, section number) of either side, with status and differences.

    ``entries`` has (documentId, position, section_number, title, page_number), ``sections`` are section
    records; of equal numbers in a document the last counts.
    """
    toc = last_of_key(entries.select("documentId", F.col("section_number").alias("number"), "position", F.col("title").alias("toc_title"), "page_number"), ["documentId", "number"], "position")
    own = last_of_key(sections.select("documentId", F.col("sectionNumber").alias("number"), "order", "title", "pageNumber"), ["documentId", "number"], "order")
    joined = toc.join(own, ["documentId", "number"], "full_outer")
    status = F.when(F.col("toc_title").isNull(), "only_in_sections").when(F.col("title").isNull(), "only_in_toc").otherwise("matched")
    both = F.col("status") == "matched"
    return joined.withColumn("status", status).select("documentId", "number", "status", "toc_title", "title", "page_number", "pageNumber", (both & titles_differ(F.col("toc_title"), F.col("title"))).alias("title_mismatch"), (both & pages_differ(F.col("page_number"), F.col("pageNumber"))).alias("page_mismatch"))


def document_report(compared: DataFrame, entries: DataFrame, sections: DataFrame) -> DataFrame:
    """Counts and rates for each document; entries and sections count with repetitions, matches without."""
    n_toc = entries.groupBy("documentId").agg(F.count("*").alias("toc_entries_count"))
    n_own = sections.groupBy("documentId").agg(F.count("*").alias("actual_sections_count"))
    sums = compared.groupBy("documentId").agg(
        F.count_if(F.col("status") == "matched").alias("matched_count"),
        F.count_if(F.col("status") == "only_in_toc").alias("only_in_toc_count"),
        F.count_if(F.col("status") == "only_in_sections").alias("only_in_sections_count"),
        F.count_if("title_mismatch").alias("title_mismatches"),
        F.count_if("page_mismatch").alias("page_mismatches"),
    )
    out = sums.join(n_toc, "documentId", "left").join(n_own, "documentId", "left").na.fill(0, ["toc_entries_count", "actual_sections_count"])
    rate = lambda n: F.coalesce(F.try_divide(F.col("matched_count"), F.col(n)), F.lit(0.0))
    return out.withColumn("match_rate", rate("toc_entries_count")).withColumn("coverage_rate", rate("actual_sections_count"))


def corpus_report(reports: DataFrame) -> DataFrame:
    """Sums over documents, unweighted means of rates, and how many documents have an issue."""
    return reports.agg(
        F.count("*").alias("documents"),
        F.sum("toc_entries_count").alias("toc_entries"),
        F.sum("actual_sections_count").alias("sections"),
        F.sum("matched_count").alias("matched"),
        F.avg("match_rate").alias("avg_match_rate"),
        F.avg("coverage_rate").alias("avg_coverage_rate"),
        F.count_if(F.col("only_in_toc_count") > 0).alias("docs_missing_sections"),
        F.count_if(F.col("title_mismatches") > 0).alias("docs_with_title_issues"),
        F.count_if(F.col("page_mismatches") > 0).alias("docs_with_page_issues"),
    )


def best_and_worst(reports: DataFrame, key: str = "documentId", rate: str = "match_rate") -> DataFrame:
    """The best and the worst document; of equals the first by key. Two aggregates, no sort."""
    best = F.min_by(F.struct(key, rate), F.struct(-F.col(rate), F.col(key)))
    worst = F.min_by(F.struct(key, rate), F.struct(F.col(rate), F.col(key)))
    both = reports.agg(best.alias("b"), worst.alias("w"))
    return both.select(F.explode(F.array(F.struct(F.lit("best").alias("which"), "b.*"), F.struct(F.lit("worst").alias("which"), "w.*"))).alias("x")).select("x.*").where(F.col(key).isNotNull())
