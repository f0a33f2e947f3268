"""LM scoring by cross-entropy difference.

A target and a background bigram model share one vocabulary: every word of the whole corpus, and one
unknown word for texts that training did not see. Both models are counted over whole texts: the
background over every document, the target over those marked. A word's probability is interpolated
from its bigram, its unigram and a uniform share, with the same weights in both models. A document's
score is the mean over its words of target loss minus background loss; lower is closer to the target.

Words and bigrams are counted exactly, by 64-bit hashes, in tables that grow with the corpus; no task holds
them all. Documents are dealt by id and text into blocks of about ``BLOCK_BYTES``; rows equal in both share one.
Blocks are the leaves of a tree in which ``FAN`` nodes have one parent. A node's distinct keys go to
parts of the key range; the task of one parent and part adds up at most ``FAN`` nodes, and hands its
sums on in parts as much smaller as its own texts are more. From the root the counts come back down the same
tree, each parent answering its nodes' keys. So a task's rows and bytes stay level however many blocks there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartolex.llm import words
from cartolex.llm.scratch import cut, release, shuffles_freed

#: Text of one block of documents, and of one part of the key range.
BLOCK_BYTES, PART_BYTES = 4 << 20, 8 << 20
#: Nodes of one parent.
FAN = 256
#: Weights of bigram, unigram and uniform shares; a history that was never seen gives its weight to the unigram.
BIGRAM, UNIGRAM, UNIFORM = 0.6, 0.39, 0.01
_U = np.uint64
#: The word before a text's first one.
START = _U(0x5BF03635D1E2A9C7)
_ZSTD = pa.Codec("zstd", compression_level=1)
_ROWS = {"part": pa.int64(), "node": pa.int64(), "asks": pa.bool_(), "n_keys": pa.int64(), "keys": pa.binary(), "n0": pa.binary(), "n1": pa.binary()}
_ANSWERS = {"part": pa.int64(), "node": pa.int64(), "n_keys": pa.int64(), "n0": pa.binary(), "n1": pa.binary(), "words": pa.int64(), "total0": pa.int64(), "total1": pa.int64()}
_MADE = ("n_words", "ce_target", "ce_background", "ce_difference")


def _bigrams(column: pa.Array, vocabulary: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """First row, word hashes, the keys of (word before, word), and each text's first word.

    With a ``vocabulary`` of sorted hashes, words outside it are 0.
    """
    for row, _, data, offsets in words.slices(column):
        starts, ends, first = words.spans(data, offsets)
        ids = words.hashes(data, starts, ends)
        if vocabulary is not None:
            ids = np.where(np.isin(ids, vocabulary), ids, _U(0))
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[first[:-1][first[:-1] < len(ids)]] = START
        yield row, ids, words.mix(words.mix(before + _U(0x9E3779B97F4A7C15)) + ids), first


def _read(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, bigram keys and words a text of a whole block."""
    ids, keys, sizes = [np.zeros(0, _U)], [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    for _, i, k, first in _bigrams(column):
        ids.append(i)
        keys.append(k)
        sizes.append(np.diff(first))
    return np.concatenate(ids), np.concatenate(keys), np.concatenate(sizes)


def _pack(values: np.ndarray) -> bytes:
    """64-bit numbers, compressed: first all their lowest bytes, then the next, as most of the high ones are 0."""
    return _ZSTD.compress(values.view(np.uint8).reshape(-1, 8).T.tobytes(), asbytes=True)


def _unpack(packed: list[bytes], sizes: list[int], kind: type) -> list[np.ndarray]:
    return [np.frombuffer(_ZSTD.decompress(p, 8 * n, asbytes=True), np.uint8).reshape(8, n).T.copy().reshape(-1).view(kind) for p, n in zip(packed, sizes, strict=True)]


def _table(rows: list[tuple], form: dict[str, pa.DataType]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [()] * len(form)
    return pa.table([pa.array(c, kind) for c, kind in zip(columns, form.values(), strict=True)], list(form))


def _schema(form: dict[str, pa.DataType]) -> str:
    names = {pa.int64(): "long", pa.bool_(): "boolean", pa.binary(): "binary"}
    return ", ".join(f"{c} {names[kind]}" for c, kind in form.items())


def _block_of(docs: DataFrame, id_col: str, text_col: str, blocks: int) -> Column:
    """The block of a document, by its id and text, so that a repeated id with many texts is in many blocks."""
    by = [F.col(text_col).cast("string"), *([F.col(id_col).cast("string")] if id_col in docs.columns else [])]
    return F.pmod(F.xxhash64(*by), F.lit(blocks)).cast("long")


def levels(blocks: int, size: int) -> list[int]:
    """Parts of the key range at each level of the tree, from the leaves' parents to the root; each divides the next."""
    found = [max(1, -(-min(FAN * BLOCK_BYTES, size) // PART_BYTES))]
    nodes, reach = -(-blocks // FAN), FAN * BLOCK_BYTES
    while nodes > 1:
        nodes, reach = -(-nodes // FAN), reach * FAN
        found.append(found[-1] * max(1, -(-min(reach, size) // (found[-1] * PART_BYTES))))
    return found


def _rows_of(kind: int, node: int, asks: bool, keys: np.ndarray, n: list[np.ndarray] | None, parts: int) -> list[tuple]:
    """A node's sorted keys (kind 0: words, 1: bigrams) with both counts, one row for each part of the key range that has one."""
    part = ((keys >> _U(32)) * _U(parts)) >> _U(32)
    ends = np.append(np.flatnonzero(part[1:] != part[:-1]) + 1, len(part)) if len(part) else np.zeros(0, np.int64)
    out, low = [], 0
    for high in ends.tolist():
        here = slice(low, high)
        out.append((2 * int(part[low]) + kind, node, asks, high - low, _pack(np.diff(keys[here], prepend=_U(0))), *([_pack(c[here]) for c in n] if n else [None, None])))
        low = high
    return out


def _n_blocks(docs: DataFrame, text_col: str, size: int) -> tuple[int, int]:
    """Bytes of text, and how many blocks of ``size`` they fill."""
    whole = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")).cast("long"))).first()[0] or 0
    return whole, max(1, -(-whole // size))


def _keys_of_blocks(docs: DataFrame, target: DataFrame | None, id_col: str, text_col: str, blocks: int, parts: int, first: int = 0, asks: bool = True) -> DataFrame:
    """Each block's distinct keys by part (even numbers: words; odd: bigrams), counted in all texts and in the target's.

    Without a ``target`` the counts are null: the block only asks for its keys. Blocks are numbered from ``first``.
    """
    key = F.col(id_col).cast("string") if id_col in docs.columns else F.lit(None).cast("string")
    texts = docs.select(_block_of(docs, id_col, text_col, blocks).alias("_block"), key.alias("_id"), F.col(text_col).cast("string").alias("_text"))
    count = target is not None
    if count:
        good = target.select(F.col(target.columns[0]).cast(docs.schema[id_col].dataType).cast("string").alias("_id")).where("_id is not null").distinct()
        marks = texts.select("_block", "_id").distinct().join(good, "_id").select(F.col("_block").alias("_home"), F.col("_id").alias("_mark"))
    else:
        marks = docs.sparkSession.createDataFrame([], "_home long, _mark string")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table([], _ROWS)
        ids, keys, sizes = _read(left["_text"])
        known = set(right["_mark"].to_pylist())
        marked = np.fromiter((i in known for i in left["_id"].to_pylist()), bool, len(sizes))
        begins = sizes > 0
        of_words = np.repeat(marked, sizes)
        out = []
        for kind, (seen, weight) in enumerate(((ids, of_words), (np.append(keys, np.full(begins.sum(), START)), np.append(of_words, marked[begins])))):
            unique, at = np.unique(seen, return_inverse=True)
            n = [np.bincount(at, minlength=len(unique)).astype(np.int64), np.bincount(at[weight], minlength=len(unique)).astype(np.int64)]
            out += _rows_of(kind, first + left["_block"][0].as_py(), asks, unique, n if count else None, parts)
        return _table(out, _ROWS)

    return texts.groupBy("_block").cogroup(marks.groupBy("_home")).applyInArrow(run, _schema(_ROWS))


def _summed(rows: pa.Table) -> tuple[np.ndarray, list[slice], np.ndarray, list[np.ndarray]]:
    """Distinct keys of one parent's nodes, each row's place among all keys, each key's place among the distinct, and both sums."""
    sizes = rows["n_keys"].to_numpy()
    unique, at = np.unique(np.concatenate([np.cumsum(k, dtype=_U) for k in _unpack(rows["keys"].to_pylist(), sizes, _U)]), return_inverse=True)
    ends = np.cumsum(sizes)
    places = [slice(e - s, e) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
    sums = [np.zeros(len(unique), np.int64) for _ in range(2)]
    for total, name in zip(sums, ("n0", "n1"), strict=True):
        for packed, here in zip(rows[name].to_pylist(), places, strict=True):
            if packed is not None:
                total[at[here]] += _unpack([packed], [here.stop - here.start], np.int64)[0]  # keys of one row are distinct
    return unique, places, at, sums


def _sum(parts: int) -> Callable[[pa.Table], pa.Table]:
    """One parent's sums over its nodes in one part of the key range, cut into the next level's ``parts``."""

    def run(rows: pa.Table) -> pa.Table:
        unique, _, _, sums = _summed(rows)
        asks = any(rows["asks"].to_pylist())
        return _table(_rows_of(rows["part"][0].as_py() % 2, rows["node"][0].as_py() // FAN, asks, unique, sums, parts), _ROWS)

    return run


def _answers(rows: pa.Table, places: list[slice], at: np.ndarray, totals: list[np.ndarray]) -> list[tuple]:
    """The counts of each node that asks, in the order of its keys."""
    told = zip(rows["part"].to_pylist(), rows["node"].to_pylist(), rows["asks"].to_pylist(), places, strict=True)
    return [(part, node, here.stop - here.start, *(_pack(t[at[here]]) for t in totals), None, None, None) for part, node, asks, here in told if asks]


def _root(rows: pa.Table) -> pa.Table:
    """Answers of the root in one part of the key range, and one row of sums."""
    _, places, at, totals = _summed(rows)
    sums = (rows["part"][0].as_py(), None, None, None, None, int((totals[0] > 0).sum()), int(totals[0].sum()), int(totals[1].sum()))
    return _table([*_answers(rows, places, at, totals), sums], _ANSWERS)


def _pass_down(rows: pa.Table, told: pa.Table) -> pa.Table:
    """Answers of one parent to its nodes, from what it was told itself."""
    if not told.num_rows or not rows.num_rows:
        return _table([], _ANSWERS)
    unique, places, at, _ = _summed(rows)
    told = told.sort_by("part")
    totals = [np.concatenate(_unpack(told[n].to_pylist(), told["n_keys"].to_pylist(), np.int64)) for n in ("n0", "n1")]
    if len(totals[0]) != len(unique):
        raise ValueError("the documents differ between two reads")
    return _table(_answers(rows, places, at, totals), _ANSWERS)


def _counted(rows: DataFrame, parts: list[int]) -> tuple[DataFrame, DataFrame]:
    """Answers to the blocks that ask, and rows of sums: up the tree level by level, and down again.

    With one level ``rows`` are read once, else they are staged, and each level's rows and answers go when the next are made.
    """
    group = (F.col("node") / FAN).cast("long")
    with shuffles_freed(rows.sparkSession):
        if len(parts) == 1:
            answers = cut(rows.groupBy("part").applyInArrow(_root, _schema(_ANSWERS)), "answers")
            return answers.where("node is not null"), answers.where("node is null")
        at_level = [cut(rows, "keys")]
        for finer in parts[1:]:
            at_level.append(cut(at_level[-1].groupBy("part", group.alias("_group")).applyInArrow(_sum(finer), _schema(_ROWS)), "sums"))
        answers = cut(at_level.pop().groupBy("part").applyInArrow(_root, _schema(_ANSWERS)), "answers")
        sums = answers.where("node is null")
        for coarse, finer in zip(parts[-2::-1], parts[:0:-1], strict=True):
            up = ((F.col("part") / 2).cast("long") / (finer // coarse)).cast("long") * 2 + F.col("part") % 2
            told = answers.where("node is not null").select("*", up.alias("_told_part"), F.col("node").alias("_told")).groupBy("_told_part", "_told")
            below = at_level.pop()
            passed = cut(below.groupBy(F.col("part").alias("_part"), group.alias("_group")).cogroup(told).applyInArrow(_pass_down, _schema(_ANSWERS)), "answers")
            release(below)
            answers = passed
    return answers, sums


@dataclass
class PairedModels:
    """What is counted for background (0: all of ``docs``) and target (1: those whose id is in ``target``), in how many blocks and first parts.

    The counts are made when documents are scored, so that they are on disk once only.
    """

    docs: DataFrame
    target: DataFrame
    id_col: str
    text_col: str
    size: int
    blocks: int
    parts: int

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` with n_words, ce_target, ce_background and ce_difference; all rows and other columns stay.

        A null, empty or blank text has 0 words and null losses. Columns already called so are replaced.
        """
        if text_col == self.text_col and docs.sameSemantics(self.docs):
            first, blocks, parts = 0, self.blocks, levels(self.blocks, self.size)
            rows = _keys_of_blocks(self.docs, self.target, self.id_col, self.text_col, blocks, parts[0])
        else:
            size, blocks = _n_blocks(docs, text_col, BLOCK_BYTES)
            first, parts = self.blocks, levels(self.blocks + blocks, self.size + size)
            asked = _keys_of_blocks(docs, None, self.id_col, text_col, blocks, parts[0], first)
            rows = _keys_of_blocks(self.docs, self.target, self.id_col, self.text_col, self.blocks, parts[0], asks=False).unionByName(asked)
        answers, sums = _counted(rows, parts)
        sums = sums.where("part % 2 = 0").agg(F.sum("words"), F.sum("total0"), F.sum("total1")).first()
        n_words, totals = (sums[0] or 0) + 1, [max(1.0, float(s or 0)) for s in sums[1:]]
        docs = docs.drop(*_MADE)
        kept = docs.withColumn("_block", _block_of(docs, self.id_col, text_col, blocks))

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return pa.table([*left.drop_columns("_block").columns, *([pa.nulls(0)] * 4)], [*left.drop_columns("_block").column_names, *_MADE])
            right = right.sort_by("part")
            odd = right["part"].to_numpy() % 2 == 1
            ids, keys, sizes = _read(left[text_col].cast(pa.string()))
            unique, at = np.unique(ids, return_inverse=True)
            full, ends = sizes > 0, np.cumsum(sizes)
            starts = (ends - sizes)[full]
            pairs, pair_at = np.unique(np.append(keys, START) if full.any() else keys, return_inverse=True)
            means = []
            for k in range(2):
                counts = _unpack(right[f"n{k}"].to_pylist(), right["n_keys"].to_pylist(), np.int64)
                uni, bi = (np.concatenate([np.zeros(0), *(c for c, o in zip(counts, odd, strict=True) if o == kind)]) for kind in (False, True))
                if len(uni) != len(unique) or len(bi) != len(pairs):
                    raise ValueError("the documents differ between two reads")
                n = uni[at]
                history = np.empty_like(n)
                history[1:] = n[:-1]
                if len(starts):
                    history[starts] = bi[pair_at[-1]]
                unigram, bigram = n / totals[k], bi[pair_at[: len(ids)]] / np.maximum(history, 1)
                p = np.where(history > 0, BIGRAM * bigram + UNIGRAM * unigram, (BIGRAM + UNIGRAM) * unigram) + UNIFORM / n_words
                mean = np.zeros(len(sizes))
                if len(starts):
                    mean[full] = np.add.reduceat(-np.log(p), starts) / sizes[full]
                means.append(mean)
            made = [pa.array(sizes), *(pa.array(x, mask=~full) for x in (means[1], means[0], means[1] - means[0]))]
            plain = left.drop_columns("_block")
            return pa.table([*plain.columns, *made], [*plain.column_names, *_MADE])

        made = [T.StructField(_MADE[0], T.LongType()), *(T.StructField(c, T.DoubleType()) for c in _MADE[1:])]
        asking = answers.select((F.col("node") - first).alias("_block"), "part", "n_keys", "n0", "n1")
        return kept.groupBy("_block").cogroup(asking.groupBy("_block")).applyInArrow(run, T.StructType([*docs.schema.fields, *made]))


def train(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> PairedModels:
    """Both models over all of ``docs``; the target's documents are those whose id is in ``target`` (one id column)."""
    size, blocks = _n_blocks(docs, text_col, BLOCK_BYTES)
    return PairedModels(docs, target, id_col, text_col, size, blocks, levels(blocks, size)[0])
