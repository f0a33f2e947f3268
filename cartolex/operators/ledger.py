"""A ledger of model calls: what was asked, answered and refused, so that nothing is asked twice.

An item is known by its content: the model's name and the text. Its answers and failures are rows of a table that is only appended
to, in folders by the first sign of the item's hash. A call of :func:`ask` looks up its items there, asks for the rest in waves,
each written before the next begins, and reads all answers from the table. A run that dies loses one wave; the next one goes on after it.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolex.staging import exists, release, stage

Call = Callable[[str], Any]
#: One attempt's row; ``dealt`` names the folder.
SCHEMA = "item string, model string, text string, answer string, error string, tries int, asked_at timestamp, dealt string"


@dataclass(frozen=True)
class Ledger:
    """A ledger's folder, the model whose calls it keeps, and how calls are made.

    A call is tried ``tries`` times in a row, the wait between tries doubling from ``pause`` seconds up to ``longest``. An item that has failed
    in ``runs`` runs is dead: it is asked no more until :func:`revive`. A wave has about ``wave`` items; a batch goes to the model at once
    (1: the model takes one text).
    """

    path: str
    model: str
    tries: int = 3
    pause: float = 0.5
    longest: float = 30.0
    runs: int = 3
    wave: int = 50_000
    batch: int = 1

    def item(self, text: Column) -> Column:
        """The item's name: a hash of the model's name and the text; a null text counts as empty."""
        return F.sha2(F.concat(F.lit(self.model), F.lit("\n"), F.coalesce(text, F.lit(""))).cast("binary"), 256)

    def read(self, spark: SparkSession) -> DataFrame:
        """All attempts, of all models."""
        return spark.read.schema(SCHEMA).parquet(f"{self.path}/calls") if exists(spark, f"{self.path}/calls") else spark.createDataFrame([], SCHEMA)

    def items(self, spark: SparkSession) -> DataFrame:
        """(item, answer, error, tries, failed_runs, state) of the model's items, one row each; the last answer counts, or else the last error.

        ``state`` is answered, failed or dead. Of failures before a :func:`revive`, only tries are counted.
        """
        mine = self.read(spark).where(F.col("model") == self.model).withColumn("revived_at", F.when(F.col("tries") == 0, F.col("asked_at")))
        last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("asked_at"))).alias(f"_{c}")
        failures = F.collect_list(F.when(F.col("error").isNotNull(), F.col("asked_at"))).alias("_failures")  # at most one a run
        found = mine.groupBy("item").agg(last("answer"), last("error"), F.sum("tries").cast("long").alias("_tries"), failures, F.max("revived_at").alias("_revived"))
        runs = F.size(F.filter("_failures", lambda t: F.coalesce(t > F.col("_revived"), F.lit(True))))
        state = F.when(F.col("_answer").isNotNull(), "answered").when(runs >= self.runs, "dead").otherwise("failed")
        return found.select("item", F.col("_answer").alias("answer"), F.when(F.col("_answer").isNull(), F.col("_error")).alias("error"), F.col("_tries").alias("tries"), runs.alias("failed_runs"), state.alias("state"))

    def dead(self, spark: SparkSession) -> DataFrame:
        """The dead items with their texts: (item, text, error, tries)."""
        texts = self.read(spark).where((F.col("model") == self.model) & F.col("text").isNotNull()).groupBy("item").agg(F.min("text").alias("text"))
        return self.items(spark).where("state = 'dead'").join(texts, "item").select("item", "text", "error", "tries")


def revive(spark: SparkSession, ledger: Ledger) -> None:
    """Lets all failed and dead items be asked again: their failures so far no longer count as runs."""
    none = F.lit(None).cast("string")
    rows = ledger.items(spark).where("state <> 'answered'").select("item", F.lit(ledger.model).alias("model"), none.alias("text"), none.alias("answer"), none.alias("error"), F.lit(0).alias("tries"), F.current_timestamp().alias("asked_at"), F.substring("item", 1, 1).alias("dealt"))
    _append(stage(rows, "revived"), ledger)


def _append(rows: DataFrame, ledger: Ledger) -> None:
    rows.write.mode("append").partitionBy("dealt").parquet(f"{ledger.path}/calls")


def _answers(call: Callable, texts: list[str], ledger: Ledger) -> tuple[list[str] | None, str | None, int]:
    """The answers to a batch as JSON, or the last error, and how many tries it took."""
    for n in range(1, ledger.tries + 1):
        try:
            made = [call(texts[0])] if ledger.batch == 1 else list(call(texts))
            if len(made) != len(texts):
                raise ValueError(f"{len(made)} answers to {len(texts)} texts")
            return [json.dumps(x) for x in made], None, n
        except Exception as e:  # reported as rows
            error = f"{type(e).__name__}: {e}"
        if n < ledger.tries:
            time.sleep(min(ledger.longest, ledger.pause * 2 ** (n - 1)))
    return None, error, ledger.tries


def ask(rows: DataFrame, key: str, text: str, call: Call, kind: str, ledger: Ledger, max_concurrent: int | None = None) -> DataFrame:
    """``(key, result, error)`` for every row: the answer on its text as a ``kind``, or why there is none.

    Equal texts are one item. Items that the ledger has an answer to, or that are dead, aren't asked. ``max_concurrent`` is the most
    tasks that ask at a time. An answer that doesn't fit ``kind`` has a null result and an error; it stays an answer. A null text counts as
    empty; null and repeated keys are rows as any.
    """
    spark = rows.sparkSession
    item = ledger.item(F.col(text))
    asked = stage(rows.select(F.col(key).alias("_key"), item.alias("item")), "asked")  # texts stay where they are
    settled = ledger.items(spark).where("state <> 'failed'").select("item")
    open_items = asked.select("item").distinct().join(settled, "item", "left_anti")
    texts = rows.select(item.alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    todo = stage(texts.join(open_items, "item", "left_semi").dropDuplicates(["item"]), "to_ask")
    count = todo.count()
    waves = -(-count // ledger.wave)
    wave = F.pmod(F.xxhash64("item"), F.lit(max(1, waves)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for low in range(0, part.num_rows, ledger.batch):
                some = part.slice(low, ledger.batch)
                made, error, tries = _answers(call, some.column(1).to_pylist(), ledger)
                n = some.num_rows
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(made or [None] * n, pa.string()), pa.array([error] * n, pa.string()), pa.array([tries] * n, pa.int32())], ["item", "text", "answer", "error", "tries"])

    for w in range(waves):
        some = todo.where(wave == w).select("item", "text")
        some = some.repartition(max_concurrent) if max_concurrent else some
        said = some.mapInArrow(run, "item string, text string, answer string, error string, tries int")
        kept = F.when(F.col("error").isNotNull(), F.col("text")).alias("text")  # texts are kept only for dead letters
        _append(said.select("item", F.lit(ledger.model).alias("model"), kept, "answer", "error", "tries", F.current_timestamp().alias("asked_at"), F.substring("item", 1, 1).alias("dealt")), ledger)
    release(todo)
    found = ledger.items(spark)
    opening = "{" if kind.startswith(("struct", "map")) else "[" if kind.startswith("array") else ""
    read = F.when(F.col("answer").startswith(opening), F.from_json("answer", kind)) if opening else F.expr(f"try_cast(answer AS {kind})")
    error = F.coalesce("error", F.when(read.isNull(), "answer of another form"))
    return asked.join(found, "item", "left").select(F.col("_key").alias(key), read.alias("result"), error.alias("error"))


def report(spark: SparkSession, ledger: Ledger) -> DataFrame:
    """(state, items, tries) of the model's items."""
    return ledger.items(spark).groupBy("state").agg(F.count("*").alias("items"), F.sum("tries").alias("tries"))
