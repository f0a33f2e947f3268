"""Row numbers in an order, over a whole table or within groups, where no task sees more than one range of rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartolex.staging import stage

_PART, _PLACE = "_number_part", "_number_place"


def numbered(rows: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "k") -> DataFrame:
    """``rows`` with ``name``: each row's place, from 0, in its group by ``order``, which must tell any two rows of a group apart.

    Rows are range-partitioned by group and order and staged with their place in their partition, so that
    sizes and rows come from one and the same partitioning. A number is that place plus the sizes of the
    ranges before: a group of any size is dealt to as many ranges as it fills. Null groups are groups of their own.
    """
    by = [*group, *order]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("*", F.spark_partition_id().alias(_PART), F.monotonically_increasing_id().alias(_PLACE))
    placed = stage(placed, "ranges")
    sizes = placed.groupBy(_PART, *group).agg(F.count("*").alias("_n"), F.min(_PLACE).alias("_first"))
    before = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = sizes.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate([_PART, *group])], (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate([_PART, *group])])
    return placed.join(offsets, same).select(*rows.columns, (F.col(_PLACE) + F.col("_offset")).alias(name))
