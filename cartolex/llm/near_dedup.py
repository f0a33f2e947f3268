"""MinHash near-dedup with HyperMinHash registers.

1. One pass over the whole texts makes each document's set of 5-word shingles (64-bit hashes), its
   size, a 128-bit digest, and 128 HyperMinHash registers: the hash's top 7 bits name the register,
   which keeps the smallest of the other bits as 6 bits of leading-zero count and 10 bits of
   mantissa.
2. Documents of one digest are one class; only the smallest doc_id of each goes on.
3. Four registers make a band; equal bands make a group. Star round: each document is paired with the
   one group's smallest member with which it shares most bands, its leader. A pair whose collision-corrected
   estimate is within five standard errors of the threshold is confirmed on the full sets, and
   confirmed links make components.
4. Cross round: groups that still hold several components are compared in blocks, only across
   components, by their registers; what the estimate lets pass is confirmed likewise. A document
   that may be similar to many members of one component is not paired with each: it probes the
   component. Probes meet the members' full sets in blocks and end at the first link, so a group
   of n near copies makes rows in proportion to n, and no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartolex.llm import words
from cartolex.llm.blocks import UNIT, block_pairs, units
from cartolex.llm.components import connected_components
from cartolex.llm.scratch import cut, fresh

WIDTH = 5
REGISTERS, MANTISSA, BANDS = 128, 10, 32
BLOCK = 1024
SIGMAS = 5.0
#: A document with this many possible partners of one component in a unit probes the component instead.
MANY = 8
#: Text of one block of a leader's followers.
TEXT_BYTES = 4 << 20
#: Shingles a side that a unit of probes holds on average (8 bytes each).
PROBE_SHINGLES = 1 << 20
#: Expected collisions of two disjoint sets: this constant times registers / 2^mantissa, at equal sizes.
COLLISION = 0.169919487159739


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers of sorted distinct hash sets: uint16, 0 where empty, larger for smaller hashes."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return out
    every = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), sizes)
    bucket = (every >> np.uint64(57)).astype(np.int64)
    cell = row * REGISTERS + bucket
    first = np.concatenate(([True], cell[1:] != cell[:-1]))
    rest = ((every[first] & np.uint64((1 << 57) - 1)) >> np.uint64(4)).astype(np.float64)
    part, exponent = np.frexp(rest)
    zeros = np.clip(53 - exponent, 0, 62)
    mantissa = np.where(rest > 0, np.floor((part * 2 - 1) * (1 << MANTISSA)), 0).astype(np.int64)
    out.reshape(-1)[cell[first]] = (zeros.astype(np.int64) << MANTISSA) + ((1 << MANTISSA) - 1 - mantissa) + 1
    return out


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of register rows, and the registers in use for each."""
    used = ((a > 0) | (b > 0)).sum(-1)
    same = ((a == b) & (a > 0)).sum(-1)
    ratio = np.maximum(size_a, size_b) / np.maximum(1, np.minimum(size_a, size_b))
    chance = COLLISION * used / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return (same - chance) / np.maximum(1, used), used


def plausible(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets with these registers and sizes may be similar: sizes allow it and the estimate is within five standard errors.

    The registers in use hold a random choice, without replacement, from the union; a pair at the
    threshold has a union of (size_a + size_b) / (1 + t), so small sets are known almost exactly.
    """
    about, used = estimate(a, b, size_a, size_b)
    t = percent / 100
    fits = 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)
    union = np.maximum((size_a + size_b) / (1 + t), used)
    unseen = (union - used) / np.maximum(1, union - 1)
    error = np.sqrt(t * (1 - t) / np.maximum(1, used) * unseen) + 0.5 / np.maximum(1, used)
    return fits & (about >= t - SIGMAS * error)


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """``(id, n_shingles, digest, bands)`` of every row; a digest is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets in words.distinct_shingles(batch.column(1), width):
                bands = registers(sets).view(np.int64)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(bands.reshape(-1))),
                    ],
                    ["id", "n_shingles", "digest", "bands"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, n_shingles long, digest binary, bands array<long>")


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), BANDS).view(np.uint16)


def _filter_pairs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = plausible(_matrix(batch.column("a_bands")), _matrix(batch.column("b_bands")), batch.column("a_n").to_numpy(), batch.column("b_n").to_numpy(), percent)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _confirm(percent: int, width: int):
    """In each unit, the pairs of a leader (side 0) and a follower (side 1) whose full sets are similar; each text is cut into shingles once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in units(batches, UNIT):
            side, ids = unit.column("side").to_numpy(), unit.column("id").to_numpy()
            first = np.flatnonzero(side == 0)
            leaders = [s for k in first for _, sets in words.distinct_shingles(unit.column("text").slice(k, 1), width) for s in sets]
            rest = pa.array(side == 1)
            found = []
            for row, sets in words.distinct_shingles(unit.column("text").filter(rest), width):
                own = ids[side == 1][row : row + len(sets)]
                found += [i for i, x in zip(own, sets, strict=True) if any(_similar(lead, x, percent) for lead in leaders)]
            if found:
                b = np.unique(np.array(found, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), unit.column("key")[0].as_py())), pa.array(b)], ["a", "b"])

    return run


def _cross(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in units(batches, UNIT):
            side = unit.column("side").to_numpy()
            ids, label, size = (unit.column(c).to_numpy() for c in ("id", "label", "n_shingles"))
            own = _matrix(unit.column("bands"))
            left = np.flatnonzero(side != 1)
            right = np.flatnonzero(side != 0)
            right = right[np.argsort(size[right], kind="stable")]
            found_a, found_b = [], []
            for i in left:
                low = np.searchsorted(size[right], -(-percent * size[i] // 100))
                high = np.searchsorted(size[right], 100 * size[i] // percent, "right")
                j = right[low:high]
                j = j[(label[j] != label[i]) & ((side[i] != 2) | (ids[j] > ids[i]))]
                if len(j):
                    j = j[plausible(own[i][None], own[j], size[i], size[j], percent)]
                    found_a.append(np.full(len(j), i))
                    found_b.append(j)
            if found_a:
                yield _pairs_and_probes(ids, label, np.concatenate(found_a), np.concatenate(found_b))

    return run


def _pairs_and_probes(ids: np.ndarray, label: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Rows ``(a, b, target)`` for the possible links ``a[k]``-``b[k]``: pairs of ids, or a document ``a`` that probes component ``target``."""
    _, code = np.unique(label, return_inverse=True)

    def partners(node: np.ndarray, other: np.ndarray) -> np.ndarray:
        _, where, count = np.unique(node * len(ids) + code[other], return_inverse=True, return_counts=True)
        return count[where]

    of_a, of_b = partners(a, b), partners(b, a)
    turn = of_b > of_a
    a, b = np.where(turn, b, a), np.where(turn, a, b)
    probe = np.maximum(of_a, of_b) >= MANY
    pairs = np.stack([ids[a[~probe]], ids[b[~probe]]], 1)
    pairs.sort(axis=1)
    probes = np.unique(np.stack([ids[a[probe]], label[b[probe]]], 1), axis=0)
    none = np.zeros(len(pairs), bool), np.ones(len(probes), bool)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([pairs[:, 0], probes[:, 0]])),
            pa.array(np.concatenate([pairs[:, 1], probes[:, 0]]), mask=np.concatenate(none)),
            pa.array(np.concatenate([pairs[:, 0], probes[:, 1]]), mask=~np.concatenate(none)),
        ],
        ["a", "b", "target"],
    )


def _probe(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in units(batches, UNIT):
            side = unit.column("side").to_numpy()
            ids, label, size = (unit.column(c).to_numpy() for c in ("id", "label", "n_shingles"))
            bands, sets = _matrix(unit.column("bands")), unit.column("hashes")
            members = np.flatnonzero(side == 1)
            linked: dict[int, tuple[int, int]] = {}
            for i in np.flatnonzero(side == 0):
                if label[i] in linked or not len(members):
                    continue
                j = members[plausible(bands[i][None], bands[members], size[i], size[members], percent)]
                about, _ = estimate(bands[i][None], bands[j], size[i], size[j])
                own = np.frombuffer(sets[i].as_buffer(), np.uint64)
                for k in j[np.argsort(-about, kind="stable")]:
                    if _similar(own, np.frombuffer(sets[k].as_buffer(), np.uint64), percent):
                        linked[label[i]] = ids[i], ids[k]
                        break
            if linked:
                found = np.array(list(linked.values()), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found.min(1)), pa.array(found.max(1))], ["a", "b"])

    return run


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough; empty sets never are."""
    if not len(x) or not len(y):
        return False
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """``(id, text)`` once for each of ``ids`` and each different text that it has; ``docs`` has (id, text)."""
    few = docs.where("text is not null").join(cut(ids.distinct(), "involved"), "id", "left_semi")
    return few.groupBy("id", F.xxhash64("text").alias("version")).agg(F.first("text").alias("text")).drop("version")


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar; ``docs`` has (id, text).

    Pairs are grouped by ``a``, the leader. Its followers are dealt into blocks of about ``TEXT_BYTES``, and the leader's
    text goes once to each block, not to each pair.
    """
    texts = cut(_texts_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")), docs).withColumn("bytes", F.octet_length("text")), "texts")
    sizes = texts.groupBy("id").agg(F.sum("bytes").alias("bytes"))
    blocks = pairs.join(sizes, pairs["b"] == sizes["id"]).groupBy("a").agg(F.ceil(F.sum("bytes") / TEXT_BYTES).cast("int").alias("blocks"))
    blocks = cut(blocks.select("a", F.greatest("blocks", F.lit(1)).alias("blocks")), "leaders")
    followers = pairs.join(blocks, "a").select(F.col("a").alias("key"), F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("left_block"), F.lit(1).alias("side"), F.col("b").alias("id"))
    leaders = blocks.select(F.col("a").alias("key"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("left_block"), F.lit(0).alias("side"), F.col("a").alias("id"))
    dealt = leaders.union(followers).withColumn("right_block", F.lit(0)).join(texts.drop("bytes"), "id")
    return dealt.repartition(*UNIT).sortWithinPartitions(*UNIT).mapInArrow(_confirm(percent, width), "a long, b long")


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets in words.distinct_shingles(batch.column("text"), width):
                found = [s.tobytes() for s in sets]
                digests = [hashlib.blake2b(x, digest_size=16).digest() if x else None for x in found]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(row, len(sets)), pa.array(digests, pa.binary()), pa.array(found, pa.binary())], ["id", "digest", "hashes"])

    return run


def _probed(probes: DataFrame, labels: DataFrame, reps: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """A link (a, b) of each probing document's component with its ``target`` component, wherever there is one.

    ``probes`` has (id, target), ``labels`` (node, component). Both sides of a target are dealt into
    blocks by their shingles, and each pair of blocks is one unit of work.
    """
    members = labels.select(F.col("node").alias("id"), F.col("component").alias("target"))
    members = members.join(probes.select("target").distinct(), "target", "left_semi")
    rows = probes.select("id", "target", F.lit(0).alias("side")).union(members.select("id", "target", F.lit(1)))
    own = labels.select(F.col("node").alias("id"), F.col("component").alias("label"))
    rows = rows.join(reps, "id").join(own, "id", "left").withColumn("label", F.coalesce("label", "id"))
    rows = cut(rows.select("id", "digest", F.col("target").alias("key"), "side", "label", "n_shingles", "bands"), "probe_rows")
    held = lambda side: F.greatest(F.ceil(F.sum(F.when(F.col("side") == side, F.col("n_shingles"))) / PROBE_SHINGLES), F.lit(1)).cast("int")
    blocks = cut(rows.groupBy("key").agg(held(0).alias("left_blocks"), held(1).alias("right_blocks")), "probe_blocks")
    sets = cut(_texts_of(rows.select("id"), docs).mapInArrow(_full_sets(width), "id long, digest binary, hashes binary").dropDuplicates(["id", "digest"]), "probe_sets")
    mine = lambda count: F.pmod(F.xxhash64("id"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    placed = rows.join(blocks, "key")
    left = placed.where("side = 0").withColumn("left_block", mine("left_blocks")).withColumn("right_block", every("right_blocks"))
    right = placed.where("side = 1").withColumn("right_block", mine("right_blocks")).withColumn("left_block", every("left_blocks"))
    dealt = left.unionByName(right).drop("left_blocks", "right_blocks").join(sets, ["id", "digest"])
    return dealt.repartition(*UNIT).sortWithinPartitions(*UNIT).mapInArrow(_probe(percent), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, width: int = WIDTH) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Two documents are linked if 100 * |A & B| >= ``percent`` * |A | B| for their shingle sets;
    component_id is the smallest id reachable by links, kept whether that is the row's own.

    Null, empty and blank texts have no shingles and link with nothing. Rows that repeat an id are
    one document: each row is returned, with its own text's n_shingles and one component, that of all its texts. Rows with a null id are returned
    with a null component and kept: they can't be named, so nothing is dropped for them.
    Ids must fit a long. Empty input gives an empty result.
    """
    made = cut(signatures(docs, id_col, text_col, width), "signatures")
    sets = made.where("digest is not null and id is not null")
    reps = sets.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    reps = cut(reps, "representatives")
    classes = reps.select("digest", F.col("id").alias("rep"), "copies")
    homes, same_id = _repeated(made, classes)
    banded = reps.select("id", "n_shingles", F.posexplode("bands").alias("band", "value")).where("value <> 0").select("id", "n_shingles", F.xxhash64("band", "value").alias("key"))
    groups = banded.groupBy("key").agg(F.min(F.struct("id", "n_shingles")).alias("a"), F.count("*").alias("n")).where("n > 1")
    groups = cut(groups.select("key", "n", F.col("a.id").alias("a"), F.col("a.n_shingles").alias("a_size")), "groups")
    members = cut(banded.join(groups, "key").select("key", "n", "a", "a_size", "id", "n_shingles"), "members")
    fits = f"100 * least(a_size, n_shingles) >= {percent} * greatest(a_size, n_shingles)"
    shared = members.where("id <> a").where(fits).groupBy("a", F.col("id").alias("b")).agg(F.count("*").alias("bands"))
    pairs = shared.groupBy("b").agg(F.max_by("a", F.struct("bands", -F.col("a"))).alias("a")).select("a", "b")
    sketch = lambda x: reps.select(F.col("id").alias(x), F.col("n_shingles").alias(f"{x}_n"), F.col("bands").alias(f"{x}_bands"))
    pairs = pairs.join(sketch("b"), "b").join(sketch("a"), "a")
    pairs = cut(pairs.mapInArrow(_filter_pairs(percent), "a long, b long").distinct(), "star_pairs")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    links = cut(_confirmed(pairs, texts, percent, width).union(same_id), "star_links")
    labels = cut(connected_components(links, "a", "b"), "star_components")

    named = cut(members.join(labels.withColumnRenamed("node", "id"), "id", "left").select("key", "n", "id", F.coalesce("component", "id").alias("label")), "named")
    mixed = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    mixed = cut(mixed, "mixed")
    apart = named.join(mixed, "key").join(reps.select("id", "n_shingles", "bands"), "id")
    dealt = block_pairs(apart, F.ceil(F.col("n") / BLOCK), "id").repartition(*UNIT).sortWithinPartitions(*UNIT)
    cross = cut(dealt.mapInArrow(_cross(percent), "a long, b long, target long").distinct(), "cross")
    cross_pairs = cut(cross.where("target is null").select("a", "b").join(pairs, ["a", "b"], "left_anti"), "cross_pairs")
    probes = cross.where("target is not null").select(F.col("a").alias("id"), "target")
    more = _confirmed(cross_pairs, texts, percent, width).union(_probed(probes, labels, reps.select("id", "digest", "n_shingles", "bands"), texts, percent, width))
    whole = cut(connected_components(links.union(more), "a", "b"), "components")

    named = whole.withColumnRenamed("node", "rep")
    by_class = cut(classes.join(named, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id")), "class_components")
    by_id = homes.join(named, "rep", "left").select("id", F.coalesce("component", "rep").alias("home"))
    out = made.drop("bands").join(by_class, "digest", "left").join(by_id, "id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "home", "id"))
    repeated = out.select("id", "n_shingles", component.alias("component_id"))
    return repeated.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def _repeated(made: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ids whose rows have different sets: ``(id, rep)``, the least class of their texts, and the links ``(a, b)`` between their classes."""
    own = F.xxhash64("digest")
    differ = made.where("id is not null").groupBy("id").agg(F.min(own).alias("low"), F.max(own).alias("high")).where("low <> high").select("id")
    several = made.where("digest is not null").select("id", "digest").join(differ, "id", "left_semi").distinct()
    several = cut(several.join(classes.select("digest", "rep"), "digest").select("id", "rep").distinct(), "repeated_ids")
    homes = cut(several.groupBy("id").agg(F.min("rep").alias("rep")), "homes")
    links = several.join(homes.withColumnRenamed("rep", "a"), "id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    return homes, links


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, width: int = WIDTH) -> DataFrame:
    """One row of each component of :func:`near_duplicates`, the smallest id's, with all columns.

    Rows that repeat an id are one document, of which one row stays. Rows with a null id all stay.
    """
    name = fresh(docs.columns, "kept_id")[0]
    kept = near_duplicates(docs, id_col, text_col, percent, width).where("kept and id is not null").select(F.col("id").alias(name)).distinct()
    named = docs.where(F.col(id_col).isNotNull()).join(cut(kept, "kept"), F.col(id_col).cast("long") == F.col(name), "left_semi")
    return named.dropDuplicates([id_col]).union(docs.where(F.col(id_col).isNull()))
