"""Tables of contents: finding them in page text, and reading their entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolex.functions.text import let, strip

#: Patterns of the second page, of entries, and lengths that are looked at (fixed values).
HEADER = r"(?imU)^\s*(INDICE|SOMMARIO)\s*$"
FOREWORD = r"(?imuU)PREMESSA[\s.]+(\d+)"
FIRST_SECTION = r"(?mU)1\.1[^\d]*(\d+)"
ENTRY_LINE = r"(?mU)^\s*\d+\."
FOREWORD_HEAD, FIRST_SECTION_HEAD = 500, 200
PLAIN_ENTRY = r"(?U)^(\d+(?:\.\d+)*)\s+(.+?)\s+(\d+)$"
DOTTED_ENTRY = r"(?imuU)^\s*(?:(\d+(?:\.\d+)*\.?)\s*)?([A-ZÀÈÌÒÙÁÉÍÓÚ][^\n\.]{3,}?)\s+\.{3,}\s*(\d+)\s*$"
NAMED_ENTRY = r"(?imuU)^\s*(PREMESSA|INDICE|SOMMARIO|OGGETTO|PARTE\s+[IVX]+|CONCLUSIONI?)\s+\.{3,}\s*(\d+)\s*$"


def entry_count(raw: Column) -> Column:
    """How many lines of a table of contents start with a numbered entry."""
    return F.coalesce(F.regexp_count(raw, F.lit(ENTRY_LINE)), F.lit(0)).cast("int")


def of_pages(pages: Column, page_count: Column) -> Column:
    """The table of contents of a document's pages (an array of (page_no, text), in order), as a struct; null without one.

    The second page names the page where the text begins; that page must bear it out. A page number of 0 counts as the last page, one
    beyond 32 bits as none. All of it happens inside the document's row.
    """
    at = lambda n: F.get(F.filter(pages, lambda p: p["page_no"] == n), F.lit(0))["text"]

    def begins(second: Column) -> Column:
        number = lambda pattern: F.when(second.rlike(pattern), F.regexp_extract(second, pattern, 1).try_cast("int"))
        return F.struct(second.alias("second"), number(FOREWORD).alias("p1"), number(FIRST_SECTION).alias("p2"))

    def bounded(x: Column) -> Column:
        there = lambda p, n: F.substring(at(F.when(p == 0, page_count).otherwise(p)), 1, n)
        end = lambda p, name: F.struct((p - 1).alias("page"), F.lit(name).alias("method"))
        foreword = F.substring(F.upper(there(x["p1"], FOREWORD_HEAD)), 1, FOREWORD_HEAD).contains("PREMESSA")
        e = F.when(foreword, end(x["p1"], "PREMESSA")).when(there(x["p2"], FIRST_SECTION_HEAD).contains("1.1"), end(x["p2"], "FIRST_SECTION"))
        return let(e, lambda e: F.when(e.isNotNull(), F.struct(x["second"].alias("second"), e.alias("e"), raw(e["page"]).alias("raw"))))

    def raw(end: Column) -> Column:
        inside = F.filter(pages, lambda p: p["page_no"].between(2, end))
        return F.array_join(F.transform(inside, lambda p: F.concat(p["text"], F.lit("\n"))), "")

    def record(x: Column) -> Column:
        has = x["second"].rlike(HEADER)
        made = F.struct(
            strip(x["raw"]).alias("rawText"),
            F.lit(2).alias("startPage"),
            x["e"]["page"].alias("endPage"),
            has.alias("hasHeader"),
            F.when(has, F.upper(F.regexp_extract(x["second"], HEADER, 1))).alias("headerText"),
            entry_count(x["raw"]).alias("entryCount"),
            x["e"]["method"].alias("detectionMethod"),
        )
        return F.when(x.isNotNull(), made)

    return let(let(let(at(F.lit(2)), begins), bounded), record)


def records(documents: DataFrame) -> DataFrame:
    """Table-of-contents records of documents with a column ``toc``, of :func:`of_pages`."""
    names = ("rawText", "startPage", "endPage", "hasHeader", "headerText", "entryCount", "detectionMethod")
    return documents.where("toc is not null").select(F.concat("documentId", F.lit("_TOC")).alias("tocId"), "documentId", *[F.col(f"toc.{c}").alias(c) for c in names])


def tocs(documents: DataFrame, pages: DataFrame, kind: str = "Circolare") -> DataFrame:
    """Table-of-contents records of documents of one type with two pages or more; ``pages`` has (documentId, page_no, text)."""
    few = documents.where((F.col("type") == kind) & (F.col("pageCount") >= 2)).select("documentId", "pageCount")
    held = pages.join(few, "documentId").groupBy("documentId", "pageCount").agg(F.sort_array(F.collect_list(F.struct("page_no", "text"))).alias("pages"))
    return records(held.select("documentId", of_pages(F.col("pages"), F.col("pageCount")).alias("toc")))


def on_toc_page(page: Column, start: Column, end: Column) -> Column:
    """Whether a page belongs to a table of contents; false without one."""
    return F.coalesce(page.between(start, end), F.lit(False))


_ENTRIES = "array<struct<section_number:string,title:string,page_number:int>>"


def plain_entries(raw: Column) -> Column:
    """Entries of lines ``number title page``; a page beyond 32 bits is null."""
    lines = F.filter(F.transform(F.split(raw, "\n", -1), strip), lambda s: s.rlike(PLAIN_ENTRY))
    part = lambda s, k: F.regexp_extract(s, PLAIN_ENTRY, k)
    return F.transform(lines, lambda s: F.struct(part(s, 1).alias("section_number"), strip(F.regexp_replace(part(s, 2), r"[. ]+$", "")).alias("title"), part(s, 3).try_cast("int").alias("page_number")))


def dotted_entries(raw: Column) -> Column:
    """Entries with dotted leaders, numbered or not; then named ones whose number isn't there yet. A page beyond 32 bits is null."""
    every = lambda pattern, k: F.regexp_extract_all(raw, F.lit(pattern), k)
    first = F.transform(F.arrays_zip(every(DOTTED_ENTRY, 1), every(DOTTED_ENTRY, 2), every(DOTTED_ENTRY, 3)), lambda x: F.struct(F.when(x["0"] != "", F.regexp_replace(x["0"], r"\.+$", "")).otherwise(F.upper(strip(x["1"]))).alias("section_number"), strip(x["1"]).alias("title"), x["2"].try_cast("int").alias("page_number")))
    named = F.transform(F.arrays_zip(every(NAMED_ENTRY, 1), every(NAMED_ENTRY, 2)), lambda x: F.struct(strip(x["0"]).alias("section_number"), strip(x["0"]).alias("title"), x["1"].try_cast("int").alias("page_number")))
    start = first.cast(_ENTRIES)
    add = lambda acc, x: F.when(F.exists(acc, lambda y: y["section_number"] == x["section_number"]), acc).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(named.cast(_ENTRIES), start, add)
