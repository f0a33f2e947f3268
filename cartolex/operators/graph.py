"""Node and edge tables, and the rules by which repeated writes of one key become one row.

Winners are picked by ``max_by`` and ``min_by`` aggregates, which combine before the shuffle, so one hot
key costs a task no more than one row from each other task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartolex.staging import release, stage


def _merge(rows: DataFrame, keys: Sequence[str], order: Sequence[str], pick, keep: Sequence[str] | None) -> DataFrame:
    values = [c for c in (keep or rows.columns) if c not in keys and c not in order]
    best = rows.groupBy(*keys).agg(pick(F.struct(*values), F.struct(*order)).alias("_v"))
    return best.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def merge_last(rows: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """One row a key: the last write wins all properties. ``order`` must tell any two writes of a key apart."""
    return _merge(rows, keys, order, F.max_by, keep)


def merge_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """One row a key: the first write sets the properties."""
    return _merge(rows, keys, order, F.min_by, keep)


def created_flags(rows: DataFrame, keys: Sequence[str], base: DataFrame | None = None) -> DataFrame:
    """(keys, created): whether a key was written just once and is not in ``base``."""
    out = rows.groupBy(*keys).agg((F.count("*") == 1).alias("created"))
    if base is None:
        return out
    known = base.select(*keys).distinct().withColumn("_known", F.lit(True))
    return out.join(known, list(keys), "left").select(*keys, (F.col("created") & F.col("_known").isNull()).alias("created"))


def edges(kind: str, rows: DataFrame, src: str | Column, dst: str | Column, order: str | Column | None = None, score: str | Column | None = None, distinct: bool = True) -> DataFrame:
    """Edge records; equal (src, dst, order) are one edge. With ``distinct=False`` the caller knows that none are equal, and nothing is shuffled."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    made = rows.select(F.lit(kind).alias("type"), as_col(src).alias("src"), as_col(dst).alias("dst"), (F.lit(None) if order is None else as_col(order)).cast("int").alias("order"), (F.lit(None) if score is None else as_col(score)).cast("double").alias("relevanceScore"))
    made = made.where("src is not null and dst is not null")
    return made.dropDuplicates(["src", "dst", "order"]) if distinct else made


def scored_edges(kind: str, rows: DataFrame, src: str, dst: str, score: str, order: Sequence[str]) -> DataFrame:
    """Edge records with a score: the last write of a (src, dst) wins."""
    last = rows.groupBy(src, dst).agg(F.max_by(score, F.struct(*order)).alias(score))
    return edges(kind, last, src, dst, score=score)


def with_both_ends(edge_rows: DataFrame, src_nodes: DataFrame, src_key: str, dst_nodes: DataFrame, dst_key: str) -> DataFrame:
    """Only the edges whose two ends exist."""
    a = src_nodes.select(F.col(src_key).alias("src")).distinct()
    b = dst_nodes.select(F.col(dst_key).alias("dst")).distinct()
    return edge_rows.join(a, "src", "left_semi").join(b, "dst", "left_semi").select(*edge_rows.columns)


def next_edges(kind: str, rows: DataFrame, key: str, group: str, order: str) -> DataFrame:
    """Edges from each row to the next of its group; ``order`` counts from 0."""
    w = Window.partitionBy(group).orderBy(order, key)
    numbered = rows.select(F.col(key).alias("src"), F.lead(key).over(w).alias("dst"), (F.row_number().over(w) - 1).alias("i"))
    return edges(kind, numbered.where("dst is not null"), "src", "dst", "i")


def roots(nodes: DataFrame, key: str, child_edges: DataFrame) -> DataFrame:
    """The nodes that no edge leads to."""
    return nodes.join(child_edges.select(F.col("dst").alias(key)), key, "left_anti")


def ancestors(nodes: DataFrame, key: str, parent: str) -> DataFrame:
    """(node, ancestor, steps): every ancestor of every node with its least number of steps, 0 for the node itself.

    Pointer doubling: a round knows all ancestors within 2^k steps and where 2^k steps lead, and goes on from there to twice as many, so a
    chain of n nodes takes log n rounds. It ends when no new pair is found; on a cycle that is after one turn, since a
    pair that is known already isn't new. Rounds are written tables; the driver sees one count a round. A parent
    that is no key has no ancestors; a node of several rows has those of all its parents.
    """
    up = stage(nodes.where(F.col(key).isNotNull() & F.col(parent).isNotNull()).select(F.col(key).alias("node"), F.col(parent).alias("ancestor")).distinct(), "parents")
    itself = nodes.where(F.col(key).isNotNull()).select(F.col(key).alias("node"), F.col(key).alias("ancestor"), F.lit(0).alias("steps")).distinct()
    known, jump, span = stage(itself.unionByName(up.where("node <> ancestor").withColumn("steps", F.lit(1))), "ancestors"), up, 1
    n = known.count()
    while True:
        ahead = known.where("steps > 0").select(F.col("node").alias("_at"), F.col("ancestor").alias("_to"), (F.col("steps") + span).alias("_steps"))
        more = jump.join(ahead, F.col("ancestor") == F.col("_at")).select("node", F.col("_to").alias("ancestor"), F.col("_steps").alias("steps"))
        after = stage(known.unionByName(more).groupBy("node", "ancestor").agg(F.min("steps").alias("steps")), "ancestors")
        found = after.count()
        release(known)
        known = after
        if found == n:
            release(jump)
            return known
        n = found
        further = jump.select(F.col("node").alias("_at"), F.col("ancestor").alias("_to"))
        twice = stage(jump.join(further, F.col("ancestor") == F.col("_at")).select("node", F.col("_to").alias("ancestor")).distinct(), "jumps")
        release(jump)
        jump, span = twice, 2 * span


def label_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(label, count) of node tables."""
    out = None
    for label, df in tables.items():
        one = df.agg(F.count("*").alias("count")).select(F.lit(label).alias("label"), "count")
        out = one if out is None else out.union(one)
    return out


def unique_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(key).count().where("count > 1")
