"""Centroid clustering in whole numbers by sort-means.

Each round sorts, for every centroid, the other centroids by their distance from it. A vector starts at the
centroid it was assigned to and goes along that list; by the triangle inequality no centroid farther from its own than
twice its distance can be as near, so it stops strictly beyond that. All arithmetic is in 64-bit whole numbers,
so results don't depend on how rows are dealt, and ties are ties.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartolex.llm.scratch import cut, release
from cartolex.llm.vectors import matrix

#: Components beyond this size count as this size, so that squared distances of up to 64 numbers fit 64 bits four times over.
LARGEST = 1 << 26
#: Rows that are compared at once.
BLOCK = 4096


def ordered(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid the others by squared distance from it (ties: smaller number), and those distances."""
    gaps = np.stack([squares(centroids, c) for c in centroids])
    np.fill_diagonal(gaps, -1)
    order = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
    return order, np.take_along_axis(gaps, order, 1)


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows, exactly."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def nearest(x: np.ndarray, before: np.ndarray, centroids: np.ndarray, order: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each row (ties: smaller number), its squared distance, and how many distances it took.

    ``before`` holds the centroids at which the rows start.
    """
    start = squares(x, centroids[before])
    best, least, looked = before.copy(), start.copy(), len(x)
    for own in np.unique(before):
        rows = np.flatnonzero(before == own)
        reach = np.searchsorted(gaps[own], 4 * start[rows], side="right")  # squared: twice the distance
        far_first = np.argsort(-reach, kind="stable")
        rows, reach = rows[far_first], reach[far_first]
        vectors = x[rows]
        going = np.searchsorted(-reach, -np.arange(reach[0]), side="left")
        for other, n in zip(order[own], going, strict=False):
            found, r = squares(vectors[:n], centroids[other]), rows[:n]
            better = (found < least[r]) | ((found == least[r]) & (other < best[r]))
            best[r[better]], least[r[better]] = other, found[better]
            looked += n
    return best, least, looked


def _assign(table: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``table`` (id, v, cluster) with each row's nearest centroid and its squared distance; k x dims numbers go with the tasks."""
    dims = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, gaps = ordered(centroids)
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                part = batch.slice(i, BLOCK)
                x = matrix(part.column("v"), dims).astype(np.int64)
                best, least, _ = nearest(x, part.column("cluster").to_numpy().astype(np.int64), centroids, order, gaps)
                columns = [part.column("id"), part.column("v"), pa.array(best, pa.int32()), pa.array(least, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "v", "cluster", "distance"])

    kind = dict(table.dtypes)["id"]
    return table.select("id", "v", "cluster").mapInArrow(assign, f"id {kind}, v array<int>, cluster int, distance bigint")


def _moved(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid as the floor of its rows' mean; one without rows stays. Sums combine before the shuffle, k rows reach the driver."""
    dims = centroids.shape[1]
    sums = [F.sum(F.get("v", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(dims)]
    after = centroids.copy()
    for row in table.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():  # at most k rows
        after[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(dims)]
    return after


def cluster(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, k: int = 40, rounds: int = 5, scale: int = 256, seed: int = 2) -> DataFrame:
    """Clusters of vectors: the id, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Only vectors of exactly ``dims`` components, none of them null or not finite, are kept and returned; others have
    no row. A component x counts as floor(``scale`` * x), and as 2^26 at most in size. Centroids start as the ``k``
    vectors with the smallest sha256 of "seed:id" (a null id counts as empty; ties by components) and number 0, 1, ... in that
    order, fewer if there are fewer vectors. ``rounds`` times, vectors go to their nearest centroid and centroids to the floor of their
    mean; once centroids stay, further rounds would change nothing and are left out. Then vectors are assigned for the last time. Repeated
    ids are rows of their own; other columns are ignored; a table without kept vectors gives no rows. Sums beyond 64 bits are null.

    A round is one scan with a written result (vectors with their cluster, the next round's start) and one aggregate of k rows a task.
    The driver holds k x dims numbers.
    """
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(x.cast("double") * scale))).cast("int"))
    kept = rows.where(F.coalesce((F.size(v) == dims) & finite, F.lit(False))).select(F.col(id_col).alias("id"), whole.alias("v"), F.lit(0).alias("cluster"))
    table = cut(kept, "whole_vectors")
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = table.select(by.alias("h"), "v").orderBy("h", "v").limit(k).collect()  # k rows
    centroids = np.array([r["v"] for r in first], np.int64).reshape(len(first), dims)
    result = f"`{id_col}` {dict(rows.dtypes)[id_col]}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not len(first):
        return rows.sparkSession.createDataFrame([], result)
    for k_th in range(rounds + 1):
        assigned = cut(_assign(table, centroids), "assigned")
        release(table)
        table = assigned
        if k_th == rounds:
            break
        after = _moved(table, centroids)
        if (after == centroids).all():
            break
        centroids = after
    sums = {r["cluster"]: int(r["s"]) for r in table.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # at most k rows
    fits = lambda x: x if x < 1 << 63 else None
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    figures = [(c, fits(s), fits(sum(sums.values())), digest(c)) for c, s in sorted(sums.items())]
    known = rows.sparkSession.createDataFrame(figures, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    out = table.join(F.broadcast(known), "cluster")  # known: at most k rows
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
