"""A stored text index with positions: words, phrases, and a top-k that leaves most of a frequent word's texts unread.

A file's texts of a word lie in blocks of 128, those to which it contributes most first; a block's row also has the best contribution in
it. Files hold ranges of (word, text), as many as the data fill, and a small table knows each file's first and last word. A query opens
only the files of its words, and there only blocks that may still hold one of the ``k`` best texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolex.operators.search import B, K1, Clause, clauses
from cartolex.staging import release, shuffles_freed, stage

BLOCK = 128
#: Blocks in a file, of full ones; a word's rare texts make many that are not.
FILE_BLOCKS = 20_000
#: What is no word, see :data:`cartolex.operators.search.WORD`.
NO_WORD = r"[^\p{L}\p{N}_]++"
#: Bytes of text that are cut at a time, texts in a row of what is shuffled, and bytes of one word's rows that are sorted at a time.
SLICE, RUN, HELD = 16_000_000, 16, 64_000_000


def impact(tf: Column, length: Column, mean: Column | float) -> Column:
    """What a word adds to a text's score, but for the word's weight."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def weight(df: Column | int, n: Column | int) -> Column:
    """A word's weight by how many of ``n`` texts it is in."""
    return F.log(1 + (F.lit(n) - df + 0.5) / (F.lit(df) + 0.5))


def write_index(rows: DataFrame, key: str, text: str, path: str, file_blocks: int = FILE_BLOCKS) -> None:
    """The index of all texts that aren't null, as tables at ``path``: stats, blocks, the words in them, and the files of blocks.

    Texts are cut once. What is staged and shuffled is a row for a word and up to ``RUN`` of a slice's texts, not one for each word of each text.
    One range partitioning by word and first text is all that is shuffled, so a word of a third of all texts is dealt to as many tasks as it
    fills, and each range is cut into blocks as it is written. The number of files follows the number of words.
    """
    spark = rows.sparkSession
    kind = rows.select(key).schema[0].dataType.simpleString()
    blanks = F.trim(F.regexp_replace(F.lower(F.col(text)), NO_WORD, " "))
    runs = rows.where(F.col(text).isNotNull()).select(F.col(key).alias("_key"), blanks.alias("_words")).mapInArrow(_cut, f"term string, n int, words long, texts array<{kind}>, counts binary, steps binary")
    runs = stage(runs, "cut_texts", compression="zstd")
    of_slice = F.col("term").isNull()
    whole = runs.agg(F.coalesce(F.sum(F.when(of_slice, F.col("n"))), F.lit(0)).alias("n"), F.sum("words").alias("words"), F.coalesce(F.sum(F.when(~of_slice, F.col("n"))), F.lit(0)).alias("entries"))
    whole.select("n", F.try_divide(F.col("words").cast("double"), "n").alias("mean"), "entries").write.parquet(f"{path}/stats")
    stats = spark.read.parquet(f"{path}/stats").first()
    order = ["term", F.get("texts", F.lit(0))]
    dealt = runs.where(~of_slice).select("term", "texts", "counts", "steps").repartitionByRange(max(1, -(-stats["entries"] // (BLOCK * file_blocks))), *order).sortWithinPartitions(*order)
    made = dealt.mapInArrow(partial(_blocks, mean=stats["mean"] or 1.0), f"term string, lead boolean, n int, best double, texts array<{kind}>, lengths array<int>, ends array<int>, positions array<int>")
    with shuffles_freed(spark):
        made.write.parquet(f"{path}/blocks", compression="zstd")
    release(runs)
    blocks = spark.read.parquet(f"{path}/blocks")
    terms = blocks.select("term", "n", "best").repartitionByRange("term").groupBy("term").agg(F.sum("n").alias("df"), F.max("best").alias("best"))
    terms.sortWithinPartitions("term").write.parquet(f"{path}/terms")
    own = blocks.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("term").alias("low"), F.max("term").alias("high"))
    own.coalesce(1).write.parquet(f"{path}/files")  # one row a file


def _lists(starts: np.ndarray, values: pa.Array) -> pa.Array:
    """``values`` as lists that begin at ``starts``."""
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)


def _packed(starts: np.ndarray, values: np.ndarray) -> pa.Array:
    """Numbers from 0 to 2^31 - 1, seven bits to a byte and the eighth for "more follows", in rows that begin at ``starts``."""
    v = values.astype(np.int64)
    size = 1 + sum((v >> 7 * k > 0).astype(np.int64) for k in range(1, 5))
    ends = np.append(0, np.cumsum(size))
    data, which = np.empty(ends[-1], np.uint8), np.arange(len(v))
    for k in range(5):
        which = which[size[which] > k]
        data[ends[which] + k] = (v[which] >> 7 * k & 127) | (size[which] > k + 1) << 7
    offsets = ends[np.append(starts, len(v))].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _unpacked(packed: pa.Array) -> np.ndarray:
    """All numbers of :func:`_packed`, in a row."""
    rows = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
    data = np.frombuffer(packed.buffers()[2], np.uint8)[rows[0] : rows[-1]]
    last = np.flatnonzero(data < 128)
    begins = np.append(0, last[:-1] + 1)
    values, which = (data[begins] & 127).astype(np.int64), np.arange(len(begins))
    for k in range(1, 5):
        which = which[last[which] - begins[which] >= k]
        values[which] |= (data[begins[which] + k] & 127).astype(np.int64) << 7 * k
    return values


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where any column differs from the row before; the first row does."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _every(begins: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups that begin at ``begins`` in pieces of ``size``: where the pieces begin, and which are the first of their group."""
    place = np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))
    starts = np.flatnonzero(place % size == 0)
    return starts, place[starts] == 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, words between blanks) as rows of one word and up to ``RUN`` texts of a slice; a row without a word has a slice's texts and words.

    ``counts`` are each text's length and how often it has the word, ``steps`` each text's places of it, as distances from one to the next. Both are
    packed, as only :func:`_blocks` reads them: what is between sorts rows and need not see each number.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        begins = _changes(np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64) // SLICE)
        for start, end in zip(begins, [*begins[1:], batch.num_rows], strict=True):
            yield from _cut_slice(batch.slice(start, end - start))


def _cut_slice(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    key, text = batch.columns
    cut = pc.split_pattern(text, " ")
    length = np.where(pc.equal(text, "").to_numpy(zero_copy_only=False), 0, pc.list_value_length(cut).to_numpy()).astype(np.int32)
    flat = cut.flatten()
    flat = flat.filter(pc.not_equal(flat, "")).dictionary_encode()
    ends, n, total = np.cumsum(length), batch.num_rows, int(length.sum())
    names, none = ["term", "n", "words", "texts", "counts", "steps"], pa.array([None], pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([n], pa.int32()), pa.array([total], pa.int64()), pa.array([None], pa.list_(key.type)), none, none], names)
    if not total:
        return
    code = flat.indices.to_numpy()
    order = np.argsort(code, kind="stable")  # words stand by text and place already
    code, of = code[order], np.repeat(np.arange(n), length)[order]
    at = order - np.repeat(ends - length, length)[order]
    first = _changes(code, of)
    step = np.diff(at, prepend=0)
    step[first] = at[first]
    of, tf = of[first], np.diff(np.append(first, total))
    starts, _ = _every(_changes(code[first]), len(first), RUN)
    lists = [_lists(starts, key.take(pa.array(of))), _packed(2 * starts, np.stack([length[of], tf], 1).ravel()), _packed(first[starts], step)]
    term, sizes = flat.dictionary.take(pa.array(code[first[starts]])), np.diff(np.append(starts, len(first)))
    yield pa.RecordBatch.from_arrays([term, pa.array(sizes, pa.int32()), pa.array(np.zeros(len(starts), np.int64)), *lists], names)


def _blocks(batches: Iterator[pa.RecordBatch], mean: float) -> Iterator[pa.RecordBatch]:
    """Rows of :func:`_cut` in order of their words as blocks of one word each; a word that fills more than ``HELD`` bytes is cut in several goes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = pc.index(batch.column(0), batch.column(0)[-1]).as_py()
        if last:
            yield _cut_blocks([*held, batch.slice(0, last)], mean)
            held = []
        held.append(batch.slice(last))
        if sum(b.nbytes for b in held) > HELD:
            yield _cut_blocks(held, mean)
            held = []
    if held:
        yield _cut_blocks(held, mean)


def _cut_blocks(parts: list[pa.RecordBatch], mean: float) -> pa.RecordBatch:
    """Blocks of the words of some rows, texts with most contribution first; ``lead`` marks a word's first block here."""
    term, texts, counts, steps = (pa.concat_arrays([b.column(i) for b in parts]) for i in range(4))
    key, (length, tf), step = texts.flatten(), _unpacked(counts).reshape(-1, 2).T, _unpacked(steps)
    new = np.ones(len(term), bool)
    new[1:] = pc.not_equal(term.slice(1), term.slice(0, len(term) - 1)).to_numpy(zero_copy_only=False)
    word = np.repeat(np.cumsum(new) - 1, pc.list_value_length(texts).to_numpy())
    adds = tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
    order = pc.sort_indices(pa.table({"word": word, "least": -adds, "key": key}), [("word", "ascending"), ("least", "ascending"), ("key", "ascending")])
    by = order.to_numpy()
    begins = np.cumsum(tf) - tf  # of each text's places
    place = np.cumsum(step, dtype=np.int64)
    place -= np.repeat(place[begins] - step[begins], tf)
    tf, begins = tf[by], begins[by]
    ends = np.cumsum(tf, dtype=np.int64)
    place = place[np.arange(len(place)) + np.repeat(begins - (ends - tf), tf)]
    starts, lead = _every(_changes(word), len(word), BLOCK)
    sizes, before = np.diff(np.append(starts, len(word))), (ends - tf)[starts]
    lists = [_lists(starts, key.take(order)), _lists(starts, pa.array(length[by], pa.int32())), _lists(starts, pa.array(ends - np.repeat(before, sizes), pa.int32())), _lists(before, pa.array(place, pa.int32()))]
    columns = [term.take(pa.array(np.flatnonzero(new)[word[starts]])), pa.array(lead), pa.array(sizes, pa.int32()), pa.array(adds[by][starts]), *lists]
    return pa.RecordBatch.from_arrays(columns, ["term", "lead", "n", "best", "texts", "lengths", "ends", "positions"])


@dataclass
class Plan:
    """What a query will read: its clauses, the words' weights, the files, and the least contribution of a block of each word."""

    terms: list[str]
    phrases: list[Clause]
    n: int
    mean: float
    weights: dict[str, float]
    files: list[str]
    least: dict[str, float]


def plan(spark: SparkSession, path: str, query: str, k: int = 10) -> Plan:
    """The plan of a query; see :func:`search`.

    The first block of each word in each range gives texts with at least certain scores, of which the k-th best is a bound. A block may hold one of the k best
    only if its best contribution and the best of all other words reach that bound together. So a frequent word's blocks are left
    unread where it stands alone or beside words of like weight; beside a much rarer word they are read, as they are with phrases, whose weights
    aren't known beforehand.
    """
    wanted = clauses(spark, query)
    terms, phrases = [c[0] for c in wanted if len(c) == 1], [c for c in wanted if len(c) > 1]
    words = sorted({w for c in wanted for w in c})
    stats = spark.read.parquet(f"{path}/stats").first()
    found = {r["term"]: r for r in spark.read.parquet(f"{path}/terms").where(F.col("term").isin(words)).select("term", "best", weight(F.col("df"), stats["n"]).alias("weight")).collect()}  # one row a word of the query
    inside = reduce(lambda a, b: a | b, [(F.col("low") <= w) & (F.col("high") >= w) for w in found], F.lit(False))
    files = sorted(r["file"] for r in spark.read.parquet(f"{path}/files").where(inside).collect())  # the files that are opened below
    weights = {w: r["weight"] for w, r in found.items()}
    p = Plan(terms, phrases, stats["n"], stats["mean"] or 1.0, weights, files, dict.fromkeys(weights, 0.0))
    if files and terms and not phrases:
        texts = _texts(spark, p, F.col("term").isin(*weights) & F.col("lead"))
        sure = _summed(texts, weights).orderBy(F.desc("score")).limit(k).collect()  # k rows
        bound = sure[-1]["score"] if len(sure) == k else 0.0
        best = {w: weights[w] * found[w]["best"] for w in weights}
        p.least = {w: (bound - (sum(best.values()) - best[w])) / weights[w] * (1 - 1e-9) - 1e-9 for w in weights}
    return p


def _texts(spark: SparkSession, p: Plan, which: Column, places: bool = False) -> DataFrame:
    """(term, key, length, impact) of the texts of a plan's blocks, and their positions if asked for, which are read only then."""
    blocks = spark.read.parquet(*p.files).where(which)

    def text(key: Column, i: Column) -> Column:
        start, end = F.coalesce(F.get("ends", i - 1), F.lit(0)), F.get("ends", i)
        found = [key.alias("key"), F.get("lengths", i).alias("length"), (end - start).alias("tf")]
        return F.struct(*found, *([F.slice("positions", start + 1, end - start).alias("positions")] if places else []))

    texts = blocks.select("term", F.explode(F.transform("texts", text)).alias("t")).select("term", "t.*")
    return texts.withColumn("impact", impact(F.col("tf"), F.col("length"), p.mean))


def _summed(texts: DataFrame, weights: dict[str, float]) -> DataFrame:
    each = F.element_at(F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]), F.col("term"))
    return texts.select("key", (each * F.col("impact")).alias("score")).groupBy("key").agg(F.sum("score").alias("score"))


def _less(n: int) -> Callable[[Column], Column]:
    return lambda x: x - n


def _phrase(spark: SparkSession, p: Plan, phrase: Clause) -> DataFrame | None:
    """(key, length, tf) of the texts that hold a phrase."""
    if not set(phrase) <= p.weights.keys():
        return None
    texts = _texts(spark, p, F.col("term").isin(*set(phrase)), places=True)
    starts = F.lit(None)
    for w in sorted(set(phrase)):
        at = [i for i, v in enumerate(phrase) if v == w]
        shifted = [F.transform("positions", _less(i)) for i in at]
        starts = F.when(F.col("term") == w, reduce(F.array_intersect, shifted)).otherwise(starts)
    by_text = texts.select("key", "length", starts.alias("starts")).groupBy("key").agg(F.first("length").alias("length"), F.collect_list("starts").alias("s"))  # one row a word of the phrase
    all_of = by_text.where(F.size("s") == len(set(phrase)))
    common = F.aggregate("s", F.get("s", F.lit(0)), lambda a, b: F.array_intersect(a, b))
    return all_of.select("key", "length", F.size(common).alias("tf")).where("tf > 0")


def search(spark: SparkSession, path: str, key: str, query: str, k: int = 10) -> DataFrame:
    """The ``k`` texts that fit a query best: (key, score), ties by key; the same rows as :func:`cartolex.operators.search.bm25` on the texts."""
    p = plan(spark, path, query, k)
    kind = spark.read.parquet(f"{path}/blocks").selectExpr("texts[0] AS key").schema["key"].dataType.simpleString()
    parts = []
    words = [w for w in p.terms if w in p.weights]
    if words:
        which = reduce(lambda a, b: a | b, [(F.col("term") == w) & (F.col("best") >= p.least[w]) for w in words])
        parts.append(_summed(_texts(spark, p, which), {w: p.weights[w] for w in words}))
    for phrase in p.phrases:
        found = _phrase(spark, p, phrase)
        if found is not None:
            found = stage(found, "phrase")
            df = found.count()
            parts.append(found.select("key", (weight(df, p.n) * impact(F.col("tf"), F.col("length"), p.mean)).alias("score")))
    if not parts:
        return spark.createDataFrame([], f"`{key}` {kind}, score double")
    total = reduce(DataFrame.unionByName, parts).groupBy("key").agg(F.sum("score").alias("score"))
    return total.orderBy(F.desc("score"), "key").limit(k).select(F.col("key").alias(key), "score")
