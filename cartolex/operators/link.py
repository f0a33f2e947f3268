"""Linking references to documents, and the report on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolex.operators.graph import edges

STATUSES = ("matched", "unmatched", "external")


def canonical_document_id(document_id: Column, mode: str = "reference") -> Column:
    """The key that references use: the document's own, or (``strict``) without a letter after its number."""
    if mode == "reference":
        return document_id
    return F.regexp_replace(document_id, r"^((?:CIR|RIS|RIP)_.*?\d)(?:_[A-Za-z]+)+(_\d{4})$", "$1$2")


def categorise(references: DataFrame, documents: DataFrame, mode: str = "reference") -> DataFrame:
    """Reference records with status (matched, unmatched or external) and the document's key if matched.

    Where two documents share a canonical key, the smaller document key is linked.
    """
    outside = F.col("referenceId").startswith("EXT_") | F.col("referenceId").startswith("REF_")
    known = documents.groupBy(canonical_document_id(F.col("documentId"), mode).alias("referenceId")).agg(F.min("documentId").alias("linked"))
    joined = references.join(known, "referenceId", "left")
    status = F.when(outside, "external").when(F.col("linked").isNotNull(), "matched").otherwise("unmatched")
    return joined.withColumn("status", status).withColumn("linked", F.when(F.col("status") == "matched", F.col("linked")))


def refers_to(categorised: DataFrame) -> DataFrame:
    """REFERS_TO edges of the matched references."""
    return edges("REFERS_TO", categorised.where("status = 'matched'"), "referenceId", "linked")


def status_report(categorised: DataFrame) -> DataFrame:
    """(status, n, percent) over all references."""
    counts = categorised.groupBy("status").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(total).select("status", "n", (100.0 * F.col("n") / F.col("total")).alias("percent"))


def status_pivot(categorised: DataFrame, by: str = "type") -> DataFrame:
    """Counts by type and status."""
    return categorised.groupBy(by).pivot("status", list(STATUSES)).count().na.fill(0, list(STATUSES))
