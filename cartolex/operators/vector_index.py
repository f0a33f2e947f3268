"""A stored vector index: vectors in lists by their nearest centroid, with short codes, and an exact second look.

Lists are folders, so a query reads those of its nearest centroids only. There it scores every vector by its code, a few
small numbers that say which of 256 patterns each part of the vector is nearest to. A vector's code is stored with how far the vector lies from it, which bounds
its cosine: the best by code are compared exactly, by cosine in double precision, and so is every other vector that the k-th of them doesn't rule out.
Centroids and patterns are fitted on a bounded sample; all vectors are indexed.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolex.operators.search import cosine

#: Vectors that centroids and patterns are fitted on, those of the smallest key hashes; patterns of a part; most lists.
SAMPLE, PATTERNS, MOST_LISTS = 20_000, 256, 4096
#: Share of the lists that a query looks into, and vectors compared first for each of the k wanted. Vectors without clusters need
#: many lists (the README has recall by share); clustered ones far fewer.
PROBED, AGAIN = 0.5, 40
#: What rounding may add to a bound on a cosine.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _rows(column: pa.Array, dims: int) -> np.ndarray:
    return _unit(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dims))


def _near(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Each row's nearest centre."""
    half = (centres * centres).sum(1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ centres.T - half, 1) for i in range(0, len(x), 4096)] or [np.zeros(0, int)])


def _means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means from evenly spaced rows; an empty cluster keeps its centre."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        of = _near(x, centres)
        n = np.bincount(of, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, of, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def write_index(rows: DataFrame, key: str, vector: str, path: str, lists: int | None = None, parts: int = 16) -> None:
    """The index of all usable vectors of the most frequent length, as tables at ``path``.

    Without a number of lists, it is about the square root of the number of vectors, at most 4096. The driver holds the sample (20,000 vectors), the centroids and the
    patterns; those go with the tasks that assign.
    """
    spark = rows.sparkSession
    v = F.col(vector)
    found = rows.where(usable(v)).select(F.col(key).alias("key"), v.alias("vector"))
    sizes = found.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    kind = dict(found.dtypes)
    if sizes is None:
        spark.createDataFrame([], f"key {kind['key']}, vector {kind['vector']}, list int").write.parquet(f"{path}/lists")
        spark.createDataFrame([("{}",)], "model string").write.parquet(f"{path}/model")
        return
    dims, n = sizes["dims"], sizes["count"]
    found = found.where(F.size("vector") == dims)
    lists = lists or min(MOST_LISTS, max(1, 1 << round(math.log2(math.sqrt(n)))))
    sample = found.orderBy(F.xxhash64(F.col("key").cast("string")), "key").limit(SAMPLE).select("vector").toPandas()["vector"]
    x = _unit(np.array([np.asarray(s, np.float64) for s in sample]))
    centres = _means(x, lists)
    cuts = np.linspace(0, dims, min(parts, dims) + 1).astype(int)
    rest = x - centres[_near(x, centres)]
    patterns = [_means(rest[:, a:b], PATTERNS) for a, b in zip(cuts, cuts[1:], strict=False)]
    codes = [f"c{i}" for i in range(len(patterns))]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column(1), dims)
            own = _near(x, centres)
            rest = x - centres[own]
            made = [_near(rest[:, a:b], p) for a, b, p in zip(cuts, cuts[1:], patterns, strict=False)]
            off = np.sqrt(sum(((rest[:, a:b] - p[c]) ** 2).sum(1) for a, b, p, c in zip(cuts, cuts[1:], patterns, made, strict=False)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c.astype(np.int16)) for c in made), pa.array(off), pa.array(own.astype(np.int32))], ["key", "vector", *codes, "off", "list"])

    schema = f"key {kind['key']}, vector {kind['vector']}, {', '.join(f'{c} smallint' for c in codes)}, off double, list int"
    made = found.mapInArrow(assign, schema).repartition("list", F.pmod(F.xxhash64("key"), F.lit(max(1, n // (lists * 200_000)))))  # a large list has several files
    made.sortWithinPartitions("list", "key").write.partitionBy("list").parquet(f"{path}/lists")
    model = json.dumps({"centres": centres.tolist(), "patterns": [p.tolist() for p in patterns], "cuts": cuts.tolist()})
    spark.createDataFrame([(model,)], "model string").write.parquet(f"{path}/model")


def search(spark: SparkSession, path: str, key: str, query: Sequence[float], k: int = 5, probed: float = PROBED, again: int = AGAIN) -> DataFrame:
    """The ``k`` vectors nearest one query by cosine: (key, score), ties by key; scores are exact.

    ``probed`` is the share of lists that are read: 1 gives the same rows as brute force, less may miss those in lists left unread. ``again`` vectors for each of the ``k`` are
    compared first, those best by code; the k-th of their cosines rules out all vectors of which code and distance to it allow no more, and the rest are compared too. A
    query without a direction, or of another length, finds nothing; a vector without a key is not found.
    """
    model = json.loads(spark.read.parquet(f"{path}/model").first()["model"])
    stored = spark.read.parquet(f"{path}/lists")
    kind = dict(stored.dtypes)["key"]
    q = np.asarray([np.nan if x is None else x for x in query], np.float64)
    if not model or len(q) != len(model["centres"][0]) or not np.isfinite(q).all() or not q.any():
        return spark.createDataFrame([], f"`{key}` {kind}, score double")
    given, q = q.tolist(), _unit(q[None])[0]
    centres, cuts = np.array(model["centres"]), model["cuts"]
    near = np.argsort(-(centres @ q), kind="stable")[: max(1, math.ceil(probed * len(centres)))]
    mine = stored.where(F.col("list").isin(near.tolist()))
    by_list = F.element_at(F.lit((centres @ q).tolist()), F.col("list") + 1)
    tables = [(np.array(p) @ q[a:b]).tolist() for p, a, b in zip(model["patterns"], cuts, cuts[1:], strict=False)]
    about = by_list
    for i, t in enumerate(tables):
        about = about + F.element_at(F.lit(t), F.col(f"c{i}") + 1)
    scored = mine.where("key is not null").select("key", "vector", "off", about.alias("about"))
    best = [r["key"] for r in scored.select("key", "about").orderBy(F.desc("about"), "key").limit(k * again).collect()]  # k x again keys
    exact = cosine(F.col("vector"), F.lit(given)).alias("score")
    sure = mine.where(F.col("key").isin(best)).select(exact).orderBy(F.desc("score")).limit(k).collect()  # k rows
    bound = sure[-1]["score"] - SLACK if len(sure) == k else -2.0
    return scored.where(F.col("about") + F.col("off") >= bound).select(F.col("key").alias(key), exact).orderBy(F.desc("score"), key).limit(k)
