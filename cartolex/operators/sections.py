"""Sections of a text: headers found by patterns, bodies, pages, levels, parents.

All of it happens inside the document's row, on its array of lines: no window, no shuffle. Only the
finished sections are exploded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolex.functions.text import let, strip


@dataclass(frozen=True)
class HeaderProfile:
    """Patterns that open a section: ``named`` ignore case, ``numbered`` don't."""

    named: tuple[str, ...]
    numbered: tuple[str, ...]

    def kind(self, line: Column) -> Column:
        """``named``, ``numbered`` or null for a stripped line."""
        named = F.lit(False) if not self.named else line.rlike("(?iuU)^(?:" + "|".join(self.named) + ")")
        numbered = F.lit(False) if not self.numbered else line.rlike("(?U)^(?:" + "|".join(self.numbered) + ")")
        return F.when(named, "named").when(numbered, "numbered")


#: Headers of Italian tax circulars (fixed values).
ITALIAN = HeaderProfile(
    named=(r"OGGETTO\s*:?", r"QUESITO\s*:?", r"SOLUZIONE\s+INTERPRETATIVA", r"PARERE\s+DELL", r"MOTIVAZIONE\s*:?", r"CONCLUSIONE\s*:?", r"INDICE\s*:?", r"PREMESSA\s*:?", r"RISPOSTA\s*:?", r"ISTANZA\s*:?", r"SOMMARIO\s*:?"),
    numbered=(r"\d+\.\s+[A-ZÀ-Ÿ]", r"\d+\.\d+\s+[A-ZÀ-Ÿ]", r"\d+\.\d+\.\d+\s+[A-ZÀ-Ÿ]", r"\d+\s+[A-ZÀ-Ÿ][A-ZÀ-Ÿ\s]{10,}"),
)
#: Title and the longest content of a section of the table of contents (fixed values).
TITLE_CHARS, TOC_CONTENT_CHARS = 200, 100


def level(header: Column) -> Column:
    """1 more than the dots in a header's leading number; 1 without one."""
    number = F.regexp_extract(header, r"^(\d+(?:\.\d+)*)", 1)
    return F.greatest(F.size(F.split(number, r"\.")), F.lit(1))


def number(header: Column, kind: Column) -> Column:
    """A header's leading number, or the upper-cased leading words of a named one."""
    digits = F.regexp_extract(header, r"(?U)^(\d+(?:\.\d+)*)", 1)
    name = F.upper(strip(F.regexp_extract(header, r"(?iuU)^([A-ZÀ-Ÿ\s]+)", 1)))
    return F.when(digits != "", digits).when((kind == "named") & (name != ""), name).otherwise("UNKNOWN")


def section_array(text: Column, profile: HeaderProfile = ITALIAN, lines_per_page: int = 50) -> Column:
    """A text's sections in order, as structs; a header without body lines makes none, and lines before the first header belong to none.

    ``page`` is where the section ends: the page of the next header line, or of the text's last line.
    """
    lines = F.transform(F.split(text, "\n", -1), lambda s, i: F.struct((i + 1).alias("n"), strip(s).alias("s")))
    kinds = F.transform(lines, lambda x: F.struct(x["n"].alias("n"), x["s"].alias("s"), F.when(x["s"] != "", profile.kind(x["s"])).alias("kind")))

    def of_doc(all_lines: Column, all_heads: Column) -> Column:
        def one(h: Column, i: Column) -> Column:
            last = F.size(all_lines)
            flush = F.coalesce(F.get(all_heads, i + 1)["n"], last)
            stop = F.coalesce(F.get(all_heads, i + 1)["n"], last + 1)
            body = F.filter(F.transform(F.slice(all_lines, h["n"] + 1, F.greatest(stop - h["n"] - 1, F.lit(0))), lambda x: x["s"]), lambda s: s != "")
            return F.struct(h["s"].alias("header"), h["kind"].alias("kind"), body.alias("body"), flush.alias("flush"))

        found = F.filter(F.transform(all_heads, one), lambda x: F.size(x["body"]) > 0)
        return F.transform(
            found,
            lambda x, i: F.struct(
                i.alias("position"),
                number(x["header"], x["kind"]).alias("sectionNumber"),
                F.substring(x["header"], 1, TITLE_CHARS).alias("title"),
                strip(F.array_join(x["body"], "\n")).alias("content"),
                x["kind"].alias("sectionType"),
                level(x["header"]).alias("level"),
                (F.floor(x["flush"] / lines_per_page) + 1).cast("int").alias("pageNumber"),
            ),
        )

    found = let(let(kinds, lambda k: F.struct(k.alias("l"), F.filter(k, lambda x: x["kind"].isNotNull()).alias("h"))), lambda x: of_doc(x["l"], x["h"]))
    return F.coalesce(found, F.array().cast("array<struct<position:int,sectionNumber:string,title:string,content:string,sectionType:string,level:int,pageNumber:int>>"))


def without_toc(found: Column, start_page: Column, end_page: Column) -> Column:
    """Sections without those of the table of contents: within its pages and short."""
    inside = lambda x: F.coalesce(x["pageNumber"].between(start_page, end_page) & (F.length(x["content"]) < TOC_CONTENT_CHARS), F.lit(False))
    return F.filter(found, lambda x: ~inside(x))


def parent_positions(found: Column) -> Column:
    """For each section the position of the last earlier one of a lower level, if that level is just one less; else null.

    One pass with a stack of (level, position) whose levels rise: a section takes off what is not lower than itself.
    """
    start = F.struct(F.array().cast("array<struct<level:int,position:int>>").alias("open"), F.array().cast("array<int>").alias("parents"))

    def step(acc: Column, x: Column) -> Column:
        lower = F.filter(acc["open"], lambda o: o["level"] < x["level"])
        top = F.get(lower, F.size(lower) - 1)
        own = F.struct(x["level"].cast("int").alias("level"), x["position"].cast("int").alias("position"))
        parent = F.when(top["level"] == x["level"] - 1, top["position"])
        return F.struct(F.concat(lower, F.array(own)).alias("open"), F.concat(acc["parents"], F.array(parent)).alias("parents"))

    return F.aggregate(F.transform(found, lambda x: F.struct(x["level"].alias("level"), x["position"].alias("position"))), start, step, lambda acc: acc["parents"])


def hierarchy(found: Column) -> Column:
    """Each section ``s`` with its ``order``, the position of its ``parent``, and that of the one ``after`` it."""

    def linked(held: Column) -> Column:
        after = lambda i: F.get(held["found"], i + 1)["position"]
        return F.transform(held["found"], lambda x, i: F.struct(x.alias("s"), i.alias("order"), F.get(held["parents"], i).alias("parent"), after(i).alias("after")))

    return let(let(found, lambda f: F.struct(f.alias("found"), parent_positions(f).alias("parents"))), linked)


def sections(documents: DataFrame, tocs: DataFrame | None = None, profile: HeaderProfile = ITALIAN, lines_per_page: int = 50) -> DataFrame:
    """Section records of document records (documentId, fullText), with order and parents.

    ``tocs``, or columns ``startPage`` and ``endPage`` of the documents, take out the sections of tables of contents; ids keep the numbers from before. ``nextSectionId``
    is the document's following section, null for its last, so that no later step has to order sections again.
    """
    if tocs is not None:
        documents = documents.join(tocs.select("documentId", "startPage", "endPage"), "documentId", "left")
    bounds = [c for c in ("startPage", "endPage") if c in documents.columns]
    rows = documents.select("documentId", section_array(F.col("fullText"), profile, lines_per_page).alias("found"), *bounds)
    if bounds:
        rows = rows.select("documentId", without_toc(F.col("found"), F.col("startPage"), F.col("endPage")).alias("found"))

    key = lambda at: F.concat(F.col("documentId"), F.lit("_SEC_"), at.cast("string"))
    x = rows.select("documentId", F.explode(hierarchy(F.col("found"))).alias("x"))
    return x.select(
        key(F.col("x.s.position")).alias("sectionId"),
        "documentId",
        *[F.col(f"x.s.{c}").alias(c) for c in ("sectionNumber", "title", "content", "sectionType", "level", "pageNumber")],
        F.col("x.order").cast("int").alias("order"),
        key(F.col("x.parent")).alias("parentSectionId"),
        F.lit(None).cast("array<float>").alias("embedding"),
        key(F.col("x.after")).alias("nextSectionId"),
    )
