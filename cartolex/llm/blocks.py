"""Pairs within groups, in blocks: no task ever holds a whole hot group.

Rows of a group are dealt by a hash into blocks of about ``block`` rows, and every pair of blocks
becomes one unit of work. A group of up to ``block`` rows is one unit; a group of n rows makes
(n / block)^2 / 2 units of at most 2 * block rows each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = ["key", "left_block", "right_block"]


def block_pairs(rows: DataFrame, blocks: Column, member: str) -> DataFrame:
    """``rows`` (with ``key``) once for each unit of its group; ``side`` is 0 (left), 1 (right) or 2 (both).

    ``blocks`` is the number of blocks of the row's group, ``member`` the column that deals them.
    """
    n = F.greatest(blocks, F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64(member), n).cast("int")
    rows = rows.withColumn("_n", n).withColumn("_own", own)
    units = F.transform(
        F.sequence(F.lit(0), F.col("_n") - 1),
        lambda other: F.struct(
            F.least(F.col("_own"), other).alias("left_block"),
            F.greatest(F.col("_own"), other).alias("right_block"),
            F.when(other == F.col("_own"), 2).when(other > F.col("_own"), 0).otherwise(1).alias("side"),
        ),
    )
    return rows.withColumn("_unit", F.explode(units)).select(*[c for c in rows.columns if c not in ("_n", "_own")], "_unit.*").drop("_n", "_own")


def units(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of equal ``keys`` of a sorted stream of batches, one after another."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, bool)
        for k in keys:
            values = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        first = tuple(batch.column(k)[0].as_py() for k in keys)
        change[0] = last is not None and first != last
        begins = np.flatnonzero(change)
        at = 0
        for b in begins:
            if b > at:
                held.append(batch.slice(at, b - at))
            if held:
                yield _joined(held)
            held, at = [], b
        held.append(batch.slice(at))
        last = tuple(batch.column(k)[n - 1].as_py() for k in keys)
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
