"""Document records from page text: type, number, year, subject, title and key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolex.functions.text import collapse, strip
from cartolex.operators import toc

#: Document types by content pattern, in this order (fixed values).
CONTENT_PATTERNS = {"Circolare": r"Circolare.*?n[.\s]*(\d+)[/\s]*([A-Z])?.*?(\d{4})", "Risoluzione": r"Risoluzione.*?n[.\s]*(\d+).*?(\d{4})", "Risposta": r"Risposta.*?n[.\s]*(\d+).*?(\d{4})"}
#: Codes of document keys (fixed values).
TYPE_CODES = {"circolare": "CIR", "risoluzione": "RIS", "risposta": "RIP"}
#: Subject pattern, default and lengths (fixed values).
SUBJECT = r"(?isuUd)OGGETTO\s*:?\s*(.+?)(?=\n\n|QUESITO|PREMESSA|\z)"
NO_SUBJECT, SUBJECT_CHARS, HEAD_CHARS, TITLE_LINES, TITLE_LEAST, TITLE_CHARS = "No OGGETTO found", 500, 2000, 20, 10, 200


def kind(filename: Column, content: Column, as_of_year: Column) -> Column:
    """Struct of type, number and year: by content, else by file name, else unknown."""
    head = F.substring(F.coalesce(content, F.lit("")), 1, HEAD_CHARS)
    made = lambda t, n, y: F.struct(F.lit(t).alias("type"), n.alias("number"), y.try_cast("int").alias("year"))
    out = None
    for name, pattern in CONTENT_PATTERNS.items():
        flagged = "(?iuUd)" + pattern
        year_group = 3 if name == "Circolare" else 2
        digits = F.regexp_extract(head, flagged, 1)
        letter = F.regexp_extract(head, flagged, 2) if name == "Circolare" else F.lit("")
        found = made(name, F.when(letter != "", F.concat(digits, F.lit("/"), letter)).otherwise(digits), F.regexp_extract(head, flagged, year_group))
        out = F.when(head.rlike(flagged), found) if out is None else out.when(head.rlike(flagged), found)
    for name in CONTENT_PATTERNS:
        digits, year = F.regexp_extract(filename, r"(?U)(\d+)", 1), F.regexp_extract(filename, r"(?U)((?:19|20)\d{2})", 1)
        named = made(name, F.when(digits != "", digits).otherwise("unknown"), F.when(year != "", year.try_cast("int")).otherwise(as_of_year))
        out = out.when(F.lower(filename).contains(name.lower()), named)
    return out.otherwise(made("Unknown", F.lit("unknown"), as_of_year))


def subject(content: Column) -> Column:
    """The subject that a text states, else a fixed text."""
    found = F.substring(collapse(strip(F.regexp_extract(content, SUBJECT, 1))), 1, SUBJECT_CHARS)
    return F.when(content.rlike(SUBJECT), found).otherwise(NO_SUBJECT)


def title(content: Column, filename: Column) -> Column:
    """The first of the first lines that is long enough and not all digits, else the file name."""
    lines = F.transform(F.slice(F.split(content, "\n", TITLE_LINES + 1), 1, TITLE_LINES), strip)
    good = F.filter(lines, lambda s: (F.length(s) > TITLE_LEAST) & ~s.rlike(r"(?U)^\d+$"))
    return F.coalesce(F.substring(collapse(F.get(good, F.lit(0))), 1, TITLE_CHARS), filename)


def document_id(kind_name: Column, number: Column, year: Column) -> Column:
    """The document's key: code, number and year."""
    code = F.upper(F.substring(kind_name, 1, 3))
    for name, short in TYPE_CODES.items():
        code = F.when(F.lower(kind_name) == name, short).otherwise(code)
    return F.concat_ws("_", code, F.regexp_replace(number, r"(?U)[^\w]", "_"), year.cast("string"))


def documents(pages: DataFrame, as_of_year: int = 0, toc_of: str | None = None) -> DataFrame:
    """Document records of page records (filename, file_size, page_no, text, and path if names repeat): one for each file.

    With ``toc_of``, documents of that type and two pages or more have their table of contents as a struct ``toc``, made while their pages are in one row.

    Pages with a time ``modified`` make one record for each version of a file; its metadata then name time (microseconds since 1970) and path.
    """
    year = F.lit(as_of_year) if as_of_year else F.year(F.current_date())
    named = pages if "path" in pages.columns else pages.withColumn("path", F.col("filename"))
    versions = ["modified"] if "modified" in pages.columns else []
    whole = named.groupBy("path", *versions).agg(
        F.min("filename").alias("filename"),
        F.first("file_size").alias("file_size"),
        F.count("*").cast("int").alias("pageCount"),
        F.sort_array(F.collect_list(F.struct("page_no", "text"))).alias("_pages"),
    ).withColumn("fullText", F.array_join(F.transform("_pages", lambda p: p["text"]), ""))
    more = [F.lit("modified"), F.unix_micros(F.col("modified").cast("timestamp")).cast("string"), F.lit("path"), F.col("path")] if versions else []
    known = whole.withColumn("k", kind(F.col("filename"), F.col("fullText"), year))
    own = [F.when((F.col("k.type") == toc_of) & (F.col("pageCount") >= 2), toc.of_pages(F.col("_pages"), F.col("pageCount"))).alias("toc")] if toc_of else []
    return known.select(
        document_id(F.col("k.type"), F.col("k.number"), F.col("k.year")).alias("documentId"),
        "k.type",
        "k.number",
        "k.year",
        title(F.col("fullText"), F.col("filename")).alias("title"),
        subject(F.col("fullText")).alias("oggetto"),
        F.lit(None).cast("date").alias("publicationDate"),
        F.lit("").alias("url"),
        "pageCount",
        "fullText",
        "path",
        *versions,
        F.create_map(F.lit("filename"), "filename", F.lit("file_size"), F.col("file_size").cast("string"), *more).alias("metadata"),
        F.lit(None).cast("array<float>").alias("fullTextEmbedding"),
        *own,
    )
