"""Names that are one: a similarity join by edit distance, and its components.

Two names are alike if their edit distance is at most a share of the longer one's length. Every edit changes at most two
of a name's pairs of signs, so of its pairs in one order, rarest first, the first ``2 d + 1`` hold one that an alike name has among its own first: an
equality join on those few rare pairs finds all candidates, and the distance itself decides. Names are compared once, however many rows have them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolex.functions.text import normalized_name
from cartolex.operators.components import connected_components
from cartolex.staging import stage

#: Least similarity: 1 less the edit distance over the longer name's length.
LEAST = 0.8


def allowed(longer: Column, least: float) -> Column:
    """The largest edit distance of alike names of which the longer has so many signs."""
    return F.floor((1 - least) * longer + 1e-9).cast("int")


def _pairs(name: Column) -> Column:
    """A name's pairs of signs between two marks that no name has, each with how many of its kind come before: all differ."""
    marked = F.concat(F.lit("\u0001"), name, F.lit("\u0001"))
    two = F.transform(F.sequence(F.lit(1), F.length(name) + 1), lambda i: F.substr(marked, i, F.lit(2)))
    return F.transform(two, lambda p, i: F.concat(p, F.size(F.filter(F.slice(two, F.lit(1), i), lambda x: x == p)).cast("string")))


def similar_names(names: DataFrame, name: str, least: float = LEAST) -> DataFrame:
    """(a, b, distance) of all pairs of distinct alike names, a < b; null and empty names are like nothing.

    ``least`` is more than 0.5 and at most 1. A pair that half of all names have is rare in no name's order, so it brings candidates only for names that have
    nothing rarer; candidates meet by (pair, length of the shorter), and lengths too far apart never do.
    """
    if not 0.5 < least <= 1:
        raise ValueError("the least similarity is more than 0.5 and at most 1")
    distinct = names.select(F.col(name).alias("name")).where("name <> ''").distinct().withColumn("len", F.length("name"))
    pairs = stage(distinct.select("name", "len", F.posexplode(_pairs(F.col("name"))).alias("at", "pair")), "name_pairs")
    common = pairs.groupBy("pair").agg(F.count("*").alias("n"))
    longest = F.floor(F.col("len") / least + 1e-9)  # of an alike name
    reach = 2 * allowed(longest, least) + 1
    ranked = pairs.join(common, "pair").groupBy("name", "len").agg(F.sort_array(F.collect_list(F.struct("n", "pair"))).alias("p"))  # as many as the name has signs, and one
    first = stage(ranked.select("name", "len", F.explode(F.slice("p", F.lit(1), reach)).alias("p")).select("name", "len", "p.pair"), "rare_pairs")
    a, b = first.select(F.col("name").alias("a"), F.col("len").alias("la"), "pair"), first.select(F.col("name").alias("b"), F.col("len").alias("lb"), "pair")
    near = F.abs(F.col("la") - F.col("lb")) <= allowed(F.greatest("la", "lb"), least)
    candidates = a.join(b, "pair").where((F.col("a") < F.col("b")) & near).select("a", "b", allowed(F.greatest("la", "lb"), least).alias("most")).distinct()
    return candidates.withColumn("distance", F.levenshtein("a", "b")).where(F.col("distance") <= F.col("most")).select("a", "b", "distance")


def resolve(nodes: DataFrame, key: str, name: str = "name", least: float = LEAST) -> DataFrame:
    """``(key, entity)``: the smallest key among those whose names are alike, directly or by way of others.

    Names are compared in lower case and without signs that are neither letters nor digits, so "Ecobonus" and "Eco-bonus" are one even at a ``least`` of 1.
    """
    bare = F.regexp_replace(normalized_name(F.col(name)), r"[^\p{L}\p{N}]+", "")
    named = stage(nodes.select(F.col(key).alias("_key"), bare.alias("_name")), "bare_names")
    links = connected_components(similar_names(named, "_name", least), "a", "b")
    grouped = named.join(links, F.col("_name") == F.col("node"), "left").withColumn("_group", F.when(F.col("_name") != "", F.coalesce("component", "_name")))
    first = grouped.where("_group is not null").groupBy("_group").agg(F.min("_key").alias("entity"))
    return grouped.join(first, "_group", "left").select(F.col("_key").alias(key), F.coalesce("entity", "_key").alias("entity"))


def merged_topics(edges: DataFrame, entities: DataFrame, key: str = "topicId") -> DataFrame:
    """Scored edges with their targets' entities in place of the targets; of edges that become one, the best score stays."""
    to = edges.join(entities.select(F.col(key).alias("dst"), F.col("entity")), "dst", "left").withColumn("dst", F.coalesce("entity", "dst"))
    return to.groupBy("type", "src", "dst").agg(F.min("order").alias("order"), F.max("relevanceScore").alias("relevanceScore"))
