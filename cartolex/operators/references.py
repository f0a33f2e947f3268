"""Legal references: gate, extraction behind an interface, validation, canonical keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolex.functions.text import non_empty, strip
from cartolex.operators.ledger import Ledger
from cartolex.operators.models import Call, each_item
from cartolex.schemas import RAW_REFERENCES

_DATE = r"(\d{1,2}[\./]\d{1,2}[\./]\d{2,4})"
#: Patterns of Italian references by type (fixed values).
PATTERNS = {
    "decreto_legislativo": r"decreto\s+legislativo\s+(?:n\.\s*)?(\d+)[/\s]+del[/\s]+" + _DATE,
    "decreto_legge": r"decreto\s+legge\s+(?:n\.\s*)?(\d+)[/\s]+del[/\s]+" + _DATE,
    "legge": r"legge\s+(?:n\.\s*)?(\d+)[/\s]+del[/\s]+" + _DATE,
    "articolo": r"articolo\s+(\d+(?:-[a-z]+)?)",
    "circolare": r"circolare\s+(?:n\.\s*)?(\d+)[/\s]*([E-]?)[/\s]+del[/\s]+" + _DATE,
    "risoluzione": r"risoluzione\s+(?:n\.\s*)?(\d+)[/\s]*([E-]?)[/\s]+del[/\s]+" + _DATE,
}
#: Codes of reference keys by type (fixed values).
CODES = {"circolare": "CIR", "risoluzione": "RIS", "risposta": "RIP", "decreto_legislativo": "EXT_DL", "decreto_legge": "EXT_DEC", "legge": "EXT_LEG", "altro": "EXT_OTH"}
OTHER_CODE = "REF"

Extractor = Callable[[DataFrame], DataFrame]


def gate(content: Column, patterns: dict[str, str] | None = None) -> Column:
    """Whether a text may hold references: one alternation, before any model sees it."""
    return F.coalesce(content.rlike("(?iuU)" + "|".join(f"(?:{p})" for p in (patterns or PATTERNS).values())), F.lit(False))


def _find(kind: str, pattern: str) -> Callable[[Column], Column]:
    groups, none = pattern.replace("(?:", "").replace("(?iuU)", "").count("("), F.lit(None).cast("string")

    def made(cited: Column) -> Column:
        number = F.regexp_extract(cited, pattern, 1)
        year = F.nullif(F.regexp_extract(F.regexp_extract(cited, pattern, groups), r"(\d{4})$", 1), F.lit("")) if groups > 1 else none
        return F.struct(F.lit("altro" if kind == "articolo" else kind).alias("type"), number.alias("number"), year.alias("year"), (number if kind == "articolo" else none).alias("article"), cited.alias("citation"), none.alias("description"))

    return made


def rule_extractor(chunks: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """The offline default: (chunkId, references) from the patterns, types in their order.

    Each text is searched once for each pattern; the groups are read from the finds, so patterns may not look beyond
    them. The number is the first group, the year the last four digits of a date group, if any.
    """
    parts = []
    for kind, pattern in (patterns or PATTERNS).items():
        flagged = "(?iuU)" + pattern
        parts.append(F.transform(F.regexp_extract_all("content", F.lit(flagged), 0), _find(kind, flagged)).cast(RAW_REFERENCES))
    return chunks.select("chunkId", F.concat(*parts).alias("references"))


def model_extractor(call: Call, max_concurrent: int | None = 10, kept: Ledger | None = None) -> Extractor:
    """An extractor that asks ``call`` for each chunk's list of references (dicts of :data:`RAW_REFERENCES`); a chunk whose call fails has none. With a ledger, only what it lacks is asked."""

    def extract(chunks: DataFrame) -> DataFrame:
        said = each_item(chunks, "chunkId", "content", call, RAW_REFERENCES, max_concurrent, kept)
        return said.where("error is null").select("chunkId", F.col("result").alias("references"))

    return extract


def validated_year(year: Column) -> Column:
    """A year of four digits, as given; else the first one inside; else null."""
    bare = strip(year)
    inside = F.regexp_extract(bare, r"(?U)\b((?:19|20)\d{2})\b", 1)
    return F.when(F.lower(bare).isin("null", "none", "") | year.isNull(), None).when(bare.rlike(r"(?U)^\d{4}$"), year).when(inside != "", inside)


def reference_id(kind: Column, number: Column, year: Column, citation: Column) -> Column:
    """The canonical key of a reference, or one from its hash if number or year is missing."""
    code = F.lit(OTHER_CODE)
    for name, short in CODES.items():
        code = F.when(F.lower(kind) == name, short).otherwise(code)
    n, y = strip(F.coalesce(number, F.lit(""))), strip(F.coalesce(year, F.lit("")))
    bare = strip(F.regexp_replace(n, r"(?U)[/\-\s]*[A-Za-z]+$", ""))
    clean = F.regexp_replace(F.regexp_replace(F.when(bare == "", n).otherwise(bare), r"(?U)[^\w]", "_"), r"^_+|_+$", "")
    hashed = F.concat(F.lit("REF_"), F.substring(F.md5(F.concat(F.lower(kind), F.lit("_"), F.coalesce(citation, F.lit(""))).cast("binary")), 1, 8))
    return F.when((n != "") & (F.length(y) == 4), F.concat_ws("_", code, clean, y)).otherwise(hashed)


def references(chunks: DataFrame, extractor: Extractor = rule_extractor, patterns: dict[str, str] | None = None) -> DataFrame:
    """Reference records of chunk records, one for each valid find, with its position in the chunk."""
    few = chunks.where(gate(F.col("content"), patterns)).select("chunkId", "content")
    return validate(extractor(few))


def validate(raw: DataFrame) -> DataFrame:
    """Reference records of (chunkId, references): finds without a type or citation go, years and keys are made canonical."""
    found = raw.select("chunkId", F.posexplode("references").alias("position", "r")).where(non_empty(F.col("r.type")) & non_empty(F.col("r.citation")))
    year = validated_year(F.col("r.year"))
    return found.select(
        reference_id(F.col("r.type"), F.col("r.number"), year, F.col("r.citation")).alias("referenceId"),
        F.lower("r.type").alias("type"),
        F.col("r.citation").alias("citation"),
        F.col("r.number").alias("number"),
        year.alias("year"),
        F.col("r.article").alias("article"),
        F.col("r.description").alias("description"),
        F.col("chunkId").alias("sourceChunkId"),
        "position",
    )
