"""Calls of models on single texts: one call an item, a cap on how many at a time, and a failed item that stops nothing."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartolex.operators import ledger

#: Takes a text and returns what a model says of it, as plain lists and dicts.
Call = Callable[[str], Any]


def each_item(rows: DataFrame, key: str, text: str, call: Call, kind: str, max_concurrent: int | None = None, kept: ledger.Ledger | None = None) -> DataFrame:
    """``(key, result, error)`` for every row: ``call`` on its text as a ``kind``, or the error that it raised.

    ``max_concurrent`` is the most tasks that call at a time; without it, every task of the input does. An
    answer that doesn't fit ``kind`` has a null result and an error. With a ledger, what was answered before isn't asked
    again, and calls are tried and kept as :func:`cartolex.operators.ledger.ask` says.
    """
    if kept is not None:
        return ledger.ask(rows, key, text, call, kind, kept, max_concurrent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                made = error = None
                try:
                    made = json.dumps(call(batch.column(1)[i].as_py() or ""))
                except Exception as e:  # reported as a row
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([made], pa.string()), pa.array([error], pa.string())], [key, "_made", "error"])

    asked = rows.select(key, text)
    asked = asked.repartition(max_concurrent) if max_concurrent else asked
    said = asked.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, _made string, error string")
    read = F.from_json("_made", kind)
    return said.select(key, read.alias("result"), F.coalesce("error", F.when(read.isNull(), "answer of another form")).alias("error"))
