"""Declared constraints over several tables, checked with one scan a table and one aggregate for all, in two steps.

Every table is read once and says, for each of its constraints, which key a row stands for: small rows of (constraint, key, order). Their
union is counted by (constraint, key, order) and then by (constraint, key), with sums that combine before each shuffle, so a key of millions of rows costs a task one row. What breaks a
constraint is a table of (constraint, key); :func:`split` sends the rows behind it to quarantine before they reach a sink.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolex.staging import stage


@dataclass(frozen=True)
class Unique:
    """No two rows of ``table`` (those for which ``where`` holds) share their ``columns``; rows with a null among them are left out."""

    table: str
    columns: tuple[str, ...]
    where: str = "true"


@dataclass(frozen=True)
class Exists:
    """Every value of ``column`` that isn't null is a ``key`` of the table ``of``."""

    table: str
    column: str
    of: str
    key: str
    where: str = "true"


@dataclass(frozen=True)
class Dense:
    """Within each value of ``group``, ``order`` is 0, 1, 2, ... without gaps, nulls or repeats."""

    table: str
    group: str
    order: str
    where: str = "true"


@dataclass(frozen=True)
class Holds:
    """``rule``, a SQL condition, is true of every row: a required column, a range, a vector's length."""

    table: str
    rule: str
    where: str = "true"


Constraint = Unique | Exists | Dense | Holds
#: The key that :class:`Holds` counts its rows under.
_ALL = "*"


def _key(*columns: str) -> Column:
    return F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))


def name(c: Constraint) -> str:
    """How a constraint is called in results."""
    what = {Unique: lambda: f"{', '.join(c.columns)} unique", Exists: lambda: f"{c.column} in {c.of}.{c.key}", Dense: lambda: f"{c.order} dense in {c.group}", Holds: lambda: c.rule}[type(c)]()
    return f"{c.table}: {what}" + ("" if c.where == "true" else f" ({c.where})")


def _said(c: Constraint, table: str) -> list[Column]:
    """What a row of a table says about a constraint: (constraint, key, order, whether it is the key that others need), or null."""
    of = lambda key, order=F.lit(None), needed=False: F.struct(F.lit(name(c)).alias("constraint"), key.alias("key"), order.cast("long").alias("order"), F.lit(needed).alias("needed"))
    out, mine = [], F.coalesce(F.expr(c.where), F.lit(False))
    if c.table == table:
        if isinstance(c, Unique):
            out.append(F.when(mine & reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in c.columns]), of(_key(*c.columns))))
        elif isinstance(c, Exists):
            out.append(F.when(mine & F.col(c.column).isNotNull(), of(_key(c.column))))
        elif isinstance(c, Dense):
            out.append(F.when(mine & F.col(c.group).isNotNull(), of(_key(c.group), F.col(c.order))))
        else:
            out.append(F.when(mine & ~F.coalesce(F.expr(c.rule), F.lit(False)), of(F.lit(_ALL))))
    if isinstance(c, Exists) and c.of == table:
        out.append(F.when(F.col(c.key).isNotNull(), of(_key(c.key), needed=True)))
    return out


def violations(tables: dict[str, DataFrame], suite: Sequence[Constraint]) -> DataFrame:
    """(constraint, key, rows): what breaks the constraints, with how many rows it concerns.
    """
    parts = []
    for table, df in tables.items():
        said = [x for c in suite for x in _said(c, table)]
        if said:
            parts.append(df.select(F.explode(F.filter(F.array(*said), lambda x: x.isNotNull())).alias("s")).select("s.*"))
    kinds = {kind: [name(c) for c in suite if isinstance(c, kind)] for kind in (Unique, Exists, Dense, Holds)}
    if not parts:
        raise ValueError("no constraint is about a given table")
    each = reduce(DataFrame.unionByName, parts).groupBy("constraint", "key", "order").agg(F.count_if(~F.col("needed")).alias("n"), F.max("needed").alias("needed"))
    sums = [F.sum("n").alias("rows"), F.max("needed").alias("there"), F.count("order").alias("orders"), F.min("order").alias("low"), F.max("order").alias("high")]
    found = each.groupBy("constraint", "key").agg(*sums)
    dense = (F.col("orders") == F.col("rows")) & (F.col("low") == 0) & (F.col("high") == F.col("rows") - 1)  # as many different orders as rows
    broken = F.when(F.col("constraint").isin(kinds[Unique]), F.col("rows") > 1).when(F.col("constraint").isin(kinds[Exists]), ~F.col("there") & (F.col("rows") > 0)).when(F.col("constraint").isin(kinds[Dense]), ~F.coalesce(dense, F.lit(False))).otherwise(True)
    return found.where(broken).select("constraint", "key", "rows")


def report(found: DataFrame) -> DataFrame:
    """(constraint, keys, rows) of what :func:`violations` found."""
    return found.groupBy("constraint").agg(F.count("*").alias("keys"), F.sum("rows").alias("rows"))


def split(tables: dict[str, DataFrame], suite: Sequence[Constraint]) -> tuple[dict[str, DataFrame], dict[str, DataFrame], DataFrame]:
    """The tables without the rows that break a constraint, those rows by table with the names of what they break (``broken``), and the violations.

    Violations are staged; a row goes to quarantine once, whatever number of constraints it breaks. Rows that only lose what they refer to, because it
    goes to quarantine, are found by another pass.
    """
    found = stage(violations(tables, suite), "violations")
    clean, bad = {}, {}
    for table, df in tables.items():
        own = [c for c in suite if c.table == table]
        marks = []
        marked = df
        for i, c in enumerate(own):
            mine = F.coalesce(F.expr(c.where), F.lit(False))
            if isinstance(c, Holds):
                marks.append(F.when(mine & ~F.coalesce(F.expr(c.rule), F.lit(False)), name(c)))
                continue
            columns = c.columns if isinstance(c, Unique) else (c.column,) if isinstance(c, Exists) else (c.group,)
            keys = found.where(F.col("constraint") == name(c)).select(F.col("key").alias(f"_key{i}"))
            marked = marked.join(keys, _key(*columns) == F.col(f"_key{i}"), "left")
            marks.append(F.when(mine & F.col(f"_key{i}").isNotNull(), name(c)))
        broken = F.filter(F.array(*marks), lambda x: x.isNotNull()) if marks else F.array().cast("array<string>")
        marked = marked.select(*df.columns, broken.alias("broken"))
        clean[table], bad[table] = marked.where(F.size("broken") == 0).drop("broken"), marked.where(F.size("broken") > 0)
    return clean, bad, found


def graph_suite(dims: int | None = None) -> list[Constraint]:
    """The constraints of a graph's tables, with ``edges`` as one more table."""
    keys = {"Document": "documentId", "TableOfContents": "tocId", "Section": "sectionId", "Chunk": "chunkId", "LegalReference": "referenceId", "Topic": "topicId", "Keyword": "keywordId"}
    ends = {"HAS_TOC": ("Document", "TableOfContents"), "HAS_SECTION": ("Document", "Section"), "HAS_SUBSECTION": ("Section", "Section"), "HAS_CHUNK": ("Section", "Chunk"), "NEXT_SECTION": ("Section", "Section"), "NEXT_CHUNK": ("Chunk", "Chunk"), "REFERENCES_LAW": ("Chunk", "LegalReference"), "REFERS_TO": ("LegalReference", "Document"), "DISCUSSES_TOPIC": ("Section", "Topic"), "DISCUSSES_KEYWORD": ("Section", "Keyword")}
    suite: list[Constraint] = [Unique(label, (key,)) for label, key in keys.items()] + [Holds(label, f"{key} is not null") for label, key in keys.items()]
    suite += [Exists("edges", end, label, keys[label], f"type = '{kind}'") for kind, pair in ends.items() for end, label in zip(("src", "dst"), pair, strict=True)]
    suite += [Unique("edges", ("type", "src", "dst"), "order is null"), Dense("Section", "documentId", "`order`"), Dense("Chunk", "sectionId", "chunkIndex")]
    suite += [Holds("edges", "relevanceScore between 0 and 1", "type like 'DISCUSSES%'")]
    return suite + ([Holds("Chunk", f"embedding is null or size(embedding) = {dims}")] if dims else [])
