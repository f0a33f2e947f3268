"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation is three rounds of random signs and a fast Hadamard transform; a unit vector hashes
to the nearest signed axis of its rotation. A table's cell is the axis of one rotation, joined by those
of further ones as the number of vectors grows, so that a cell holds about ``BUCKET`` of them at every
size. Every vector is indexed once in each table. A query visits the cells nearest to it in each
table, by the sum of squared gaps to its own axes, and candidates are ranked by exact
cosine in double precision. Crowded buckets are dealt into parts, each of which answers for its own
best; a part returns no more than k rows a query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartolex.llm import vectors
from cartolex.llm.blocks import units
from cartolex.llm.scratch import cut

TABLES, PROBES, PART = 6, 14, 4096
#: Rows a cell should hold, cells of which ``PROBES`` are visited, and the power by which visits grow with cells.
BUCKET, PROBED, GROWTH = 1024, 128, 0.75
SLACK = 1e-9


def hadamard(y: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of rows whose length is a power of two."""
    n, h = y.shape[1], 1
    while h < n:
        y = y.reshape(len(y), -1, 2, h)
        y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(y), n)
        h *= 2
    return y


def rotations(x: np.ndarray, tables: int, each: int, seed: int) -> Iterator[list[np.ndarray]]:
    """Each table's ``each`` pseudo-rotations of rows ``x``, padded with zeros to a power of two."""
    width = 1 << max(0, int(x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x
    rng = np.random.RandomState(seed)
    for _ in range(tables):
        found = []
        for _ in range(each):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], width)) / np.sqrt(width)
            found.append(y)
        yield found


def axes(dim: int, rows: int, bucket: int) -> list[int]:
    """How many signed axes each rotation of a table tells apart: all by the first, then as many more as give a cell to every ``bucket`` rows."""
    whole = 2 << max(0, (dim - 1).bit_length())
    found, left = [whole], -(-rows // (bucket * whole))
    while left > 1:
        found.append(min(whole, 1 << (left - 1).bit_length()))
        left = -(-left // found[-1])
    return found


def probes_of(cells: int, probes: int) -> int:
    """Cells a query visits in each table: ``probes``, and more as the 0.75th power where a table has more than 128."""
    return math.ceil(probes * max(1.0, cells / PROBED) ** GROWTH)


def nearest_cells(rotated: list[np.ndarray], widths: list[int], count: int) -> np.ndarray:
    """The ``count`` cells nearest each row.

    Gaps add up over rotations, so the best cells begin with the best beginnings, of which only ``count`` are carried on.
    """
    cell, cost = np.zeros((len(rotated[0]), 1), np.int64), np.zeros((len(rotated[0]), 1))
    for y, w in zip(rotated, widths, strict=True):
        scores = np.concatenate([y[:, : w // 2], -y[:, : w // 2]], 1)
        gap = (scores.max(1, keepdims=True) - scores) ** 2
        total = (cost[:, :, None] + gap[:, None, :]).reshape(len(y), -1)
        named = (cell[:, :, None] * w + np.arange(w)).reshape(len(y), -1)
        at = np.argsort(total, axis=1, kind="stable")[:, :count]
        cell, cost = np.take_along_axis(named, at, 1), np.take_along_axis(total, at, 1)
    return cell


def _hash(dim: int, tables: int, widths: list[int], count: int, seed: int):
    """Adds ``buckets``: the ``count`` nearest cells of each table, as table * 2^32 + cell."""
    step = max(1, (1 << 21) // (count * max(widths)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, step):
                batch = whole.slice(low, step)
                x = vectors.unit(vectors.matrix(batch.column("vector"), dim))
                found = [(t << 32) + nearest_cells(r, widths, count) for t, r in enumerate(rotations(x, tables, len(widths), seed))]
                every = np.concatenate(found, 1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * every.shape[1]), pa.array(every.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "buckets"])

    return run


def _rank(dim: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u in units(batches, ["key", "part"]):
            asks = u.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            if asks.all() or not asks.any():
                continue
            ids, x = u.column("id").to_numpy(), vectors.unit(vectors.matrix(u.column("vector"), dim))
            own_ids, own = ids[~asks], x[~asks]
            queries, found, scores = [], [], []
            for low in range(0, int(asks.sum()), 256):
                q_ids, q = ids[asks][low : low + 256], x[asks][low : low + 256]
                close = q @ own.T
                close[q_ids[:, None] == own_ids[None, :]] = -2
                at = max(0, close.shape[1] - k)
                least = np.maximum(np.partition(close, at, axis=1)[:, at] - SLACK, -1.5)
                row, col = np.nonzero(close >= least[:, None])
                exact = np.concatenate([vectors.cosines(q[row[i : i + 65536]], own[col[i : i + 65536]]) for i in range(0, len(row), 65536)] or [np.zeros(0)])
                order = np.lexsort((own_ids[col], -exact, row))
                row, col, exact = row[order], col[order], exact[order]
                first = np.searchsorted(row, np.arange(len(q)))
                keep = np.arange(len(row)) - first[row] < k
                queries.append(q_ids[row[keep]])
                found.append(own_ids[col[keep]])
                scores.append(exact[keep])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(queries)), pa.array(np.concatenate(found)), pa.array(np.concatenate(scores))], ["query_id", "vec_id", "score"])

    return run


def search(df: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, probes: int = PROBES, bucket: int = BUCKET, seed: int = 9) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for each row where ``queries`` (over ``df``) holds.

    The nearest come first, ties go to the smaller id; a query doesn't find its own id. Unusable vectors
    (null, empty, zero, with null or non-finite components, of another length than most) and rows
    with a null id take no part. Rows that repeat an id are one candidate, with its best score. A
    query whose buckets hold fewer than ``k`` others is ranked against every row, so only a table of
    fewer candidates gives fewer rows.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.coalesce(queries, F.lit(False)).alias("q"))
    dim = max(1, vectors.dimension(rows, "vector"))
    good = rows.where(F.col("id").isNotNull() & vectors.usable(F.col("vector")) & (F.size("vector") == dim)).dropDuplicates(["id", "vector"])
    kind = rows.schema["vector"].dataType.simpleString()
    schema = f"id long, vector {kind}, q boolean, buckets array<long>"
    good = cut(good, "usable")
    widths = axes(dim, good.count(), bucket)
    visits = probes_of(math.prod(widths), probes)
    index = cut(good.mapInArrow(_hash(dim, tables, widths, 1, seed), schema), "index").withColumn("key", F.explode("buckets"))
    asked = cut(good.where("q").mapInArrow(_hash(dim, tables, widths, visits, seed), schema), "probes").withColumn("key", F.explode("buckets"))
    sizes = index.groupBy("key").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    sizes = cut(sizes, "bucket_sizes")  # at most one row a cell
    best = _best(_answers(index, asked, sizes, dim, k), k)
    best = cut(best, "nearest")
    short = good.where("q").select("id").distinct().join(best.groupBy("query_id").count().where(F.col("count") >= k), F.col("id") == F.col("query_id"), "left_anti")
    rest = cut(good.where("q").join(short, "id", "left_semi"), "short_queries")
    if rest.isEmpty():
        return best
    n = max(1, -(-good.count() // PART))
    every = good.withColumn("key", F.pmod(F.xxhash64("id"), F.lit(n)).cast("long"))
    to_all = rest.withColumn("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    whole = _best(_answers(every, to_all, every.select("key").distinct().withColumn("parts", F.lit(1)), dim, k), k)
    return best.join(rest.select(F.col("id").alias("query_id")), "query_id", "left_anti").select(*whole.columns).union(whole)


def _answers(index: DataFrame, asked: DataFrame, sizes: DataFrame, dim: int, k: int) -> DataFrame:
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    own = index.join(sizes, "key").select("key", part.alias("part"), F.lit(False).alias("asks"), "id", "vector")
    ask = asked.join(sizes, "key").select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("asks"), "id", "vector")
    return own.union(ask).repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(_rank(dim, k), "query_id long, vec_id long, score double")


def _best(answers: DataFrame, k: int) -> DataFrame:
    once = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
