"""What held when: as-of joins, and the time for which a document is in force before another supersedes it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartolex.staging import release, stage

_PART = "_asof_part"


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: Sequence[str], strict: bool = False) -> DataFrame:
    """``left`` with the ``values`` of the last row of ``right`` of its key that is not later (``strict``: that is earlier).

    Both sides are sorted as one, by key and time, in one range partitioning, so a hot key is dealt to as many tasks as it fills; each range
    carries its last right row on within itself, and one row a key and range is carried from range to range. Of right rows of one key and time the one with
    the largest values counts. Left rows with a null key or time, or with no right row before them, have nulls; right rows with a null key or time
    count for none. Every left row is returned once.
    """
    given = left.columns
    none = lambda kind: F.lit(None).cast(kind)
    of_left, of_right = (df.select(F.struct(*columns)).schema[0].dataType for df, columns in ((left, given), (right, values)))
    lefts = left.select(F.col(key).alias("_k"), F.col(left_time).alias("_t"), F.lit(0 if strict else 1).alias("_side"), F.struct(*given).alias("_left"), none(of_right).alias("_right"))
    rights = right.select(F.col(key).alias("_k"), F.col(right_time).alias("_t"), F.lit(1 if strict else 0).alias("_side"), none(of_left).alias("_left"), F.struct(*values).alias("_right"))
    both = lefts.unionByName(rights).where("_k is not null and _t is not null")
    order = ["_k", "_t", "_side", "_right"]
    placed = stage(both.repartitionByRange("_k", "_t", "_side").sortWithinPartitions(*order).select("*", F.spark_partition_id().alias(_PART)), "asof_ranges")
    within = Window.partitionBy(_PART, "_k").orderBy("_t", "_side", "_right").rowsBetween(Window.unboundedPreceding, 0)
    own = placed.withColumn("_own", F.last("_right", ignorenulls=True).over(within))
    latest = F.max_by("_right", F.when(F.col("_right").isNotNull(), F.struct("_t", "_side", "_right"))).alias("_last")
    ends = placed.groupBy(_PART, "_k").agg(latest)
    before = Window.partitionBy("_k").orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)  # one row a key and range
    carried = ends.select(F.col(_PART).alias("_p"), F.col("_k").alias("_kk"), F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    rows = own.where("_left is not null").join(carried, (F.col(_PART) == F.col("_p")) & (F.col("_k") == F.col("_kk")), "left")
    found = rows.select("_left.*", F.coalesce("_own", "_carried").alias("_r")).select(*given, *[F.col(f"_r.{v}").alias(v) for v in values])
    rest = left.where(F.col(key).isNull() | F.col(left_time).isNull())
    return found.unionByName(rest.select("*", *[none(right.schema[v].dataType).alias(v) for v in values]))


def validity(documents: DataFrame, supersedes: DataFrame, key: str = "documentId", issued: str = "issued") -> DataFrame:
    """(key, validFrom, validUntil): a document holds from its own date to the first date of those that supersede it, directly or by way of others.

    ``supersedes`` has edges (src, dst): src takes dst's place. Superseders without a date, or that aren't known, end nothing by themselves, but what
    supersedes them does. A date before the document's own ends it at once: it then never held. validUntil is null while nothing ends it, validFrom
    where the document has no date. A cycle of documents that supersede one another is followed once round.

    Pointer doubling, as in :func:`cartolex.operators.graph.ancestors`, but of all documents ahead only the two of first date are kept (two, since on a cycle
    one may be the document itself). It ends when a round changes nothing, which holds for all later ones; the driver sees a count and a checksum a round.
    """
    jump = stage(supersedes.where("src is not null and dst is not null").select(F.col("dst").alias("node"), F.col("src").alias("ancestor")).distinct(), "supersedes")
    dated = documents.where(F.col(key).isNotNull() & F.col(issued).isNotNull()).groupBy(F.col(key).alias("ancestor")).agg(F.min(issued).alias("d"))
    best = stage(_two_first(jump.join(dated, "ancestor").select("node", F.struct("d", F.col("ancestor").alias("a")).alias("x"))), "ends")
    while True:
        ahead = best.select(F.col("node").alias("ancestor"), "x")
        after = stage(_two_first(best.unionByName(jump.join(ahead, "ancestor").select("node", "x"))), "ends")
        was, now = (df.agg(F.count("*"), F.sum(F.xxhash64("node", "x").cast("decimal(38,0)"))).first() for df in (best, after))
        release(best)
        best = after
        if now == was:
            break
        further = jump.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("_to"))
        twice = stage(jump.join(further, "ancestor").select("node", F.col("_to").alias("ancestor")).distinct(), "jumps")
        release(jump)
        jump = twice
    release(jump)
    ends = best.where(F.col("x.a") != F.col("node")).groupBy("node").agg(F.min("x.d").alias("validUntil"))
    own = documents.select(F.col(key).alias("node"), F.col(issued).alias("validFrom"))
    return own.join(ends, "node", "left").select(F.col("node").alias(key), "validFrom", "validUntil")


def _two_first(rows: DataFrame) -> DataFrame:
    """Of (node, x), each node's two least different values of x, once each; a task passes on few rows of a node."""
    place = F.dense_rank().over(Window.partitionBy("node").orderBy("x"))
    return rows.withColumn("_place", place).where("_place <= 2").select("node", "x").distinct()


def valid_on(rules: DataFrame, day) -> DataFrame:
    """The rows of :func:`validity` that hold on a day: from their first day on, up to but without the day that ends them."""
    d = F.lit(day)
    return rules.where((F.col("validFrom") <= d) & (F.col("validUntil").isNull() | (F.col("validUntil") > d)))
