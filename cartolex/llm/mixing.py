"""Mixing sources to target weights by iterative proportional fitting; DataFrame operations only.

Documents are counted into cells of source, language and topic. Each round scales the cells so that
one marginal after another meets its target share; what a cell gained or lost is its factor. A document
is sampled with its cell's factor over the largest factor, so expected tokens follow the targets. The
cells are pre-aggregated once; a factor is a product of one number for each marginal value, and a
round is one job that writes one table of those numbers to the shared folder.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolex.llm.scratch import cut, fresh, release

DIMENSIONS = ("source", "lang", "topic")
#: Without given targets, a marginal's target shares are its observed shares to this power, made to sum to 1.
TEMPER = {"source": 0.7, "lang": 0.8, "topic": 1.0}
#: Rounds go on until each marginal value is this close to its goal (as a share of the goal), or a round no longer
#: brings them closer by a hundredth (targets that no weights meet), or there were so many.
TOLERANCE, ROUNDS = 1e-8, 60
#: Topics by a sign or word that their texts hold; the first that fits, else ``prose``.
TOPICS = {"credentials": "token = ", "tables": " | ", "markup": "***", "shouting": "!! "}


def topic(text: Column, topics: dict[str, str] | None = None) -> Column:
    """The topic of a text; ``none`` for a null one."""
    out = F.when(text.isNull(), "none")
    for name, sign in (TOPICS if topics is None else topics).items():
        out = out.when(text.contains(sign), name)
    return out.otherwise("prose")


def tokens(text: Column) -> Column:
    """Runs of signs outside white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(id_col: Column, seed: int) -> Column:
    """A number from 0 to 1 that depends on the id and the seed only."""
    digits = F.substring(F.md5(F.concat_ws(":", F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(str(seed))).cast("binary")), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 48)


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, temper: dict[str, float] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with calibrated ``weight`` (shares that sum to 1) and ``factor``.

    ``targets`` may give a (value, share) table for a dimension; values it lacks have no tokens, and
    its shares are made to sum to 1 over the values that have any. Cells without tokens have a
    weight of 0 and a factor of 0. If marginals stay further than ``TOLERANCE`` from their goals after at most
    ``rounds`` rounds, a warning names the largest gap of each.
    """
    temper = TEMPER if temper is None else temper
    start = cut(cells, "cells")
    whole = float(start.agg(F.sum("tokens")).first()[0] or 0)
    state = {}  # by dimension: (value, goal, scale, gap)
    for d in DIMENSIONS:
        seen = start.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").alias("t")).where("t > 0")
        if targets and d in targets:
            seen = seen.join(targets[d].select("value", F.col("share").alias("raw")), "value")
        else:
            seen = seen.withColumn("raw", F.pow(F.col("t").cast("double"), F.lit(float(temper[d]))))
        seen = cut(seen.select("value", "raw"), f"shares_{d}")
        every = float(seen.agg(F.sum("raw")).first()[0] or 1)
        state[d] = cut(seen.select("value", (F.col("raw") / every).alias("goal"), F.lit(1.0).alias("scale"), F.lit(1.0).alias("gap")), f"goal_{d}")
        release(seen)

    def scaled(dims: Iterable[str]) -> DataFrame:
        table = start.withColumn("factor", F.lit(1.0))
        for d in dims:
            table = table.join(state[d].select(F.col("value").alias(d), "scale"), d, "left").withColumn("factor", F.col("factor") * F.coalesce("scale", F.lit(0.0))).drop("scale")
        return table

    k, gap, last = 0, {}, float("inf")
    while k < rounds:
        for d in DIMENSIONS:
            margin = scaled(x for x in DIMENSIONS if x != d).groupBy(F.col(d).alias("value")).agg(F.sum(F.col("tokens") * F.col("factor")).alias("m")).where("m > 0")
            new = F.coalesce(F.col("goal") * whole / F.col("m"), F.lit(0.0))
            fitted = state[d].where("goal > 0").join(margin, "value", "left").select("value", "goal", new.alias("scale"), F.coalesce(F.abs(F.col("scale") / new - 1), F.lit(1.0)).alias("gap"))
            fitted = cut(fitted, f"round_{k}_{d}")
            release(state[d])
            state[d] = fitted
        gaps = reduce(DataFrame.union, [state[d].agg(F.lit(d).alias("d"), F.max("gap").alias("gap")) for d in DIMENSIONS])
        gap = {r["d"]: r["gap"] or 0.0 for r in gaps.collect()}  # one row a dimension
        k += 1
        most = max(gap.values())
        if most <= TOLERANCE or most > 0.99 * last:
            break
        last = most
    if gap and max(gap.values()) > TOLERANCE:
        warnings.warn(f"after {k} rounds, marginals are off their goals by up to {gap}", stacklevel=2)
    share = F.col("tokens") * F.col("factor") / whole if whole else F.lit(0.0)
    return scaled(DIMENSIONS).select(*DIMENSIONS, "tokens", share.alias("weight"), F.when(F.col("tokens") > 0, F.col("factor")).otherwise(0.0).alias("factor"))


def measure(docs: DataFrame, text_col: str = "text", topics: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with mix_topic and mix_tokens, from the whole texts. Columns already called so are replaced."""
    kept = docs.drop("mix_topic", "mix_tokens")
    return kept.select("*", topic(F.col(text_col), topics).alias("mix_topic"), tokens(F.col(text_col)).alias("mix_tokens"))


def calibrate(measured: DataFrame, targets: dict[str, DataFrame] | None = None, temper: dict[str, float] | None = None, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang", rounds: int = ROUNDS, most: float | None = None, seed: int = 7) -> DataFrame:
    """What :func:`measure` returned, with mix_factor, mix_prob and sampled; see :func:`mix`."""
    docs = measured.drop("mix_factor", "mix_prob", "sampled")
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    keys = {"source": named(source_col), "lang": named(lang_col), "topic": F.col("mix_topic")}
    cells = docs.select(*[v.alias(k) for k, v in keys.items()], F.col("mix_tokens").alias("n")).groupBy(*DIMENSIONS).agg(F.sum("n").alias("tokens"))
    raked = cut(rake(cells, targets, temper, rounds), "raked")
    top = raked.agg((F.max("factor") if most is None else F.least(F.max("factor"), F.lit(float(most)))).alias("top"))
    prob = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("factor") / F.col("top"))).otherwise(1.0)
    own = fresh(docs.columns, *(f"mix_key_{d}" for d in DIMENSIONS))
    cell = raked.join(top).select(*[F.col(d).alias(k) for d, k in zip(DIMENSIONS, own, strict=True)], F.col("factor").alias("mix_factor"), prob.alias("mix_prob"))
    keyed = docs.select("*", *[keys[d].alias(k) for d, k in zip(DIMENSIONS, own, strict=True)])
    out = keyed.join(cut(cell, "cell_probabilities"), own, "left")
    return out.select(*[F.col(c) for c in docs.columns], "mix_factor", "mix_prob", (draw(F.col(id_col), seed) < F.col("mix_prob")).alias("sampled"))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, temper: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topics: dict[str, str] | None = None, rounds: int = ROUNDS, most: float | None = None, seed: int = 7) -> DataFrame:
    """``docs`` with mix_topic, mix_tokens, mix_factor, mix_prob and sampled; all rows and other columns stay.

    A null source or language is a value of its own. A text without tokens weighs nothing; its
    document follows its cell, and is kept where the whole cell has no tokens. Equal ids
    have equal draws. Columns already called like the five are replaced. Documents are sampled by
    their cell's factor over the largest one, so a cell that must grow much makes the whole sample smaller.
    With ``most``, larger factors count as that, and marginals fall short of their goals by what it takes off.

    Texts are measured twice, for the cells and for the rows; to read them once, stage what :func:`measure`
    returns and hand it to :func:`calibrate`.
    """
    return calibrate(measure(docs, text_col, topics), targets, temper, id_col, source_col, lang_col, rounds, most, seed)
