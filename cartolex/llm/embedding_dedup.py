"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact cosines, components.

1. Equal vectors are one class, counted before any shuffle of theirs; its smallest id stands for it.
2. Each class gets one code of ``bits`` signs in each table, computed once and written. Codes grow with
   the logarithm of the number of classes; the number of tables then follows from the chance
   ``MISS`` that a pair at the threshold shares no code.
3. Classes of one code are compared by exact cosine, in blocks. A unit of work returns sums of links for
   each vector and one edge for each vector that isn't its component's first, never its pairs. A
   pair counts in the first table whose codes agree, so it counts once; for that a vector takes its
   codes of earlier tables with it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartolex.llm import vectors
from cartolex.llm.blocks import UNIT, block_pairs, units
from cartolex.llm.components import connected_components
from cartolex.llm.scratch import cut

MISS, BUCKET, BLOCK = 1e-5, 256, 1024
#: Cosines this close to the threshold are computed again, component by component.
BORDER = 1e-9


def plan(n: int, threshold: float) -> tuple[int, int]:
    """Bits of a code and number of tables for ``n`` vectors."""
    bits = min(24, max(4, math.ceil(math.log2(max(2, n) / BUCKET)) if n > BUCKET else 4))
    same = 1 - math.acos(threshold) / math.pi
    return bits, max(1, math.ceil(math.log(MISS) / math.log(1 - same**bits)))


def _code_type(bits: int) -> str:
    return "smallint" if bits < 16 else "int"


def _codes(bits: int, tables: int, dim: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.RandomState(seed).randn(dim, bits * tables)
        weights = 1 << np.arange(bits)
        for batch in batches:
            signs = (vectors.unit(vectors.matrix(batch.column(2), dim)) @ planes > 0).reshape(-1, tables, bits)
            codes = (signs * weights).sum(2).astype(np.int16 if _code_type(bits) == "smallint" else np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * tables), pa.array(codes.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "codes"])

    return run


def _labels(near: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each node of a symmetric matrix of links."""
    n = len(near)
    label = np.arange(n)
    while True:
        least = np.where(near, label[None, :], n).min(1)
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(threshold: float, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u in units(batches, UNIT):
            side = u.column("side").to_numpy()
            ids, copies = u.column("rep").to_numpy(), u.column("copies").to_numpy()
            if len(ids) < 2:
                continue
            table = u.column("table")[0].as_py()
            x = vectors.unit(vectors.matrix(u.column("vector"), dim))
            earlier = vectors.matrix(u.column("codes"), table).astype(np.int32)
            close = x @ x.T
            near = close >= threshold
            for i, j in zip(*np.nonzero(np.abs(close - threshold) < BORDER), strict=True):
                near[i, j] = vectors.cosines(x[i : i + 1], x[j : j + 1])[0] >= threshold
            np.fill_diagonal(near, False)
            counted = near if side[0] == 2 else near & (side[:, None] != side[None, :])
            a, b = np.nonzero(counted)
            links = np.zeros(len(ids), np.int64)
            for low in range(0, len(a), 1 << 18):
                p, q = a[low : low + (1 << 18)], b[low : low + (1 << 18)]
                mine = ~(earlier[p] == earlier[q]).any(1)
                links += np.bincount(p[mine], copies[q[mine]], len(ids)).astype(np.int64)
            linked = np.flatnonzero(near.any(1))
            if len(linked):
                first = ids[_labels(near)[linked]]
                yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(first), pa.array(links[linked])], ["rep", "other", "links"])

    return run


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, seed: int = 5) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row: how many other rows it links with, and its component.

    Rows are linked at a cosine of ``threshold`` or more. Null, empty and zero vectors, those with
    null or non-finite components, and those of another length than most link with nothing. Equal vectors are
    linked; repeated rows count as rows. A row with a null id is returned with no links, a null
    component and kept. Empty input gives an empty result.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    dim = vectors.dimension(rows, "vector")
    good = rows.where(F.col("id").isNotNull() & vectors.usable(F.col("vector")) & (F.size("vector") == dim))
    classes = cut(good.groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes")
    bits, tables = plan(classes.count(), threshold)
    coded = cut(classes.select("rep", "copies", "vector").mapInArrow(_codes(bits, tables, max(1, dim), seed), f"rep long, copies long, vector {rows.schema['vector'].dataType.simpleString()}, codes array<{_code_type(bits)}>"), "codes")
    key = lambda t, c: t.cast("long") * (1 << 32) + c
    slim = coded.select(F.posexplode("codes").alias("table", "code")).select(key(F.col("table"), F.col("code")).alias("key"))
    crowded = cut(slim.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK), "crowded")
    spread = coded.select("*", F.posexplode("codes").alias("table", "code")).withColumn("key", key(F.col("table"), F.col("code"))).drop("code").withColumn("codes", F.slice("codes", 1, F.col("table")))
    sized = spread.join(crowded, "key", "left")
    dealt = block_pairs(sized, F.ceil(F.coalesce("n", F.lit(1)) / BLOCK), "rep").drop("n").repartition(*UNIT).sortWithinPartitions(*UNIT)
    found = cut(dealt.mapInArrow(_compare(threshold, max(1, dim)), "rep long, other long, links long"), "found")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    component = connected_components(found.where("rep <> other"), "rep", "other")
    named = classes.join(links, "rep", "left").join(component.withColumnRenamed("node", "rep"), "rep", "left")
    named = cut(named.select("vector", "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "named")
    can = F.col("id").isNotNull() & vectors.usable(F.col("vector")) & (F.size("vector") == dim)
    keyed = rows.select("id", F.when(can, F.col("vector")).alias("vector"))
    out = keyed.join(named, "vector", "left")
    component_id = F.coalesce("component_id", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component_id.alias("component_id"), F.coalesce(F.col("id") == component_id, F.lit(True)).alias("kept"))
