"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search keeps, for each position of a window no longer than the longest piece needs, the best
way to get there: a piece and a backpointer. Whenever the paths of all positions that a future piece
may still start from meet at one boundary, the ids before it are committed and the window moves up.

Two kinds of model are read from a ``.model`` file:

* unigram: a path's weight is the sum of its pieces' scores;
* BPE: a path is allowed only if merging would leave each of its adjacent pairs of pieces as they are.
  Exactly one path of that kind leads to each position, and it is the model's own segmentation, so
  ids equal those of pairwise merging without ever merging whole texts.

A space is written as U+2581. No piece goes on from a later sign into such a mark or into a line
break, nor from a letter into most punctuation, so texts fall into independent units there, which a
bounded cache remembers.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
#: Kinds of pieces and models in the file format (fixed values).
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0
CACHE = 250_000
BATCH_CHARS = 4 << 20
#: Lengths of unit beginnings whose search is remembered, longest first.
HEADS = (9, 7, 5, 4)


class PieceModel:
    """A vocabulary with its search; made from the bytes of a ``.model`` file."""

    def __init__(self, data: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        self.kind = proto.trainer_spec.model_type
        rules = proto.normalizer_spec
        if self.kind not in (UNIGRAM, BPE) or rules.name != "identity" or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only unigram and BPE models with identity normalisation are read")
        self.prefix = rules.add_dummy_prefix
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.bytes: list[bytes] = []
        self.byte_ids = [-1] * 256
        self.unknown = 0
        for i, piece in enumerate(proto.pieces):
            self.scores.append(piece.score)
            out = piece.piece.replace(SPACE, " ").encode()
            if piece.type in (NORMAL, USER_DEFINED):
                self.ids[piece.piece] = i
            elif piece.type == BYTE:
                value = int(piece.piece[3:5], 16)
                self.byte_ids[value] = i
                out = bytes([value])
            else:
                if piece.type == UNKNOWN:
                    self.unknown = i
                out = b"" if piece.type != UNKNOWN else " ⁇ ".encode()
            self.bytes.append(out)
        self.falls_back = min(self.byte_ids) >= 0
        self.longest = max(map(len, self.ids), default=1)
        #: Every ending of every piece: its id if it is a piece itself, else -1.
        self.endings = {p[k:]: -1 for p in self.ids for k in range(len(p))} | self.ids
        self.names = [p.piece for p in proto.pieces]
        self.unknown_score = min((self.scores[i] for i in self.ids.values()), default=0.0) - UNKNOWN_PENALTY
        self.pairs: dict[int, bool] = {}
        self.heads: dict[str, tuple] = {}
        self.units = self._unit_pattern()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _unit_pattern(self) -> re.Pattern[str]:
        """Runs of signs that pieces may span: they end before a space mark or line break, and between a letter and a sign that no piece has after a letter."""
        neighbours = {(p[i], p[i + 1]) for p in self.ids for i in range(len(p) - 1)}
        if any(b == "\n" or b == SPACE != a for a, b in neighbours):
            return re.compile("(?s).+")
        follow = {b for a, b in neighbours if a.isalpha()}
        apart = "".join(re.escape(c) for c in "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~" if c not in follow)
        if not apart:
            return re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        return re.compile(f"\n|{SPACE}*[^{SPACE}\n](?:[^{SPACE}\n{apart}]|(?<![A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff])[{apart}])*|{SPACE}+")

    # -- what merging does to a short string ------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """``text`` after merging neighbours, best score first, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.scores[found] > best):
                    best, at = self.scores[found], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _allowed(self, left: int, piece: int) -> bool:
        """Whether merging leaves ``piece`` whole, and apart from ``left`` before it (below 0: nothing that could merge)."""
        name = self.names[piece]
        if left < 0:
            ok = self.merged(name) == [name]
        else:
            before = self.names[left]
            ok = self.merged(before + name) == [before, name]
        if len(self.pairs) > 4 * CACHE:
            self.pairs.clear()
        self.pairs[(left + 2) << 32 | piece] = ok
        return ok

    # -- the search -------------------------------------------------------------------------------

    def search(self, unit: str) -> Iterator[tuple[int, str]]:
        """The ids of one unit with their strings; -2 for a sign outside the vocabulary."""
        base = 0  # committed up to here
        back, last, score = [0], [-1], [0.0]  # by position - base; -1: nothing before, -3: no path
        bpe, n, longest = self.kind == BPE, len(unit), self.longest
        endings, scores, pairs = self.endings.get, self.scores, self.pairs.get
        first = 1
        for head in HEADS:  # what the search finds up to a position depends on nothing behind it
            if n > head and (known := self.heads.get(unit[:head])):
                back, last, score = map(list, known)
                first = head + 1
                break
        for end in range(first, n + 1):
            best_back, best, best_score = -1, -3, 0.0
            for start in range(end - 1, max(base, end - longest) - 1, -1):
                found = endings(unit[start:end])
                if found is None:
                    break
                if found < 0:
                    continue
                before = last[start - base]
                if bpe:
                    if before == -2:
                        before = -1
                    if before != -3:
                        ok = pairs((before + 2) << 32 | found)
                        if ok or ok is None and self._allowed(before, found):
                            best_back, best = start, found
                            break
                elif before != -3:
                    total = score[start - base] + scores[found]
                    if best == -3 or total >= best_score:
                        best_back, best, best_score = start, found, total
            if best == -3 and (not bpe or endings(unit[end - 1], -1) < 0):  # an unknown sign
                best_back, best, best_score = end - 1, -2, score[end - 1 - base] + self.unknown_score
            back.append(best_back)
            last.append(best)
            score.append(best_score)
            if end in HEADS and end < n and not base:
                if len(self.heads) > CACHE:
                    self.heads.clear()
                self.heads[unit[:end]] = (tuple(back), tuple(last), tuple(score))
            if end - base >= 4 * longest and end < n:
                meet = self._meeting(back, last, base, end)
                if meet > base:
                    yield from self._path(unit, back, last, base, meet)
                    cut = meet - base
                    del back[:cut], last[:cut], score[:cut]
                    base = meet
        yield from self._path(unit, back, last, base, n)

    def _meeting(self, back: list[int], last: list[int], base: int, end: int) -> int:
        """The boundary where the paths of all positions that the next piece may start from meet."""
        alive = {p for p in range(max(base, end - self.longest + 1), end + 1) if last[p - base] != -3}
        while len(alive) > 1:
            top = max(alive)
            alive.remove(top)
            alive.add(back[top - base])
        return alive.pop() if alive else base

    @staticmethod
    def _path(unit: str, back: list[int], last: list[int], base: int, end: int) -> list[tuple[int, str]]:
        out = []
        while end > base:
            start = back[end - base]
            out.append((last[end - base], unit[start:end]))
            end = start
        return out[::-1]

    def _unit(self, unit: str) -> bytes:
        known = self.old.get(unit)
        if known is None:
            made: list[int] = []
            for found, sign in self.search(unit):
                if found >= 0:
                    made.append(found)
                elif self.falls_back:
                    made += [self.byte_ids[b] for b in sign.encode()]
                elif not made or made[-1] != self.unknown:
                    made.append(self.unknown)
            known = np.array(made, np.int32).tobytes()
        if len(unit) <= 64:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[unit] = known
        return known

    def encode(self, text: str) -> np.ndarray:
        """The ids of ``text`` (int32)."""
        if not text:
            return np.zeros(0, np.int32)
        text = text.replace(" ", SPACE)
        if self.prefix:
            text = SPACE + text
        if len(text) <= BATCH_CHARS:
            get = self.young.get
            return np.frombuffer(b"".join([get(u) or self._unit(u) for u in self.units.findall(text)]), np.int32)
        found, parts = self.units.finditer(text), []  # the same for a text whose units aren't listed all at once
        while block := [m.group() for m in islice(found, 1 << 16)]:
            parts.append(b"".join([self.young.get(u) or self._unit(u) for u in block]))
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``."""
        pieces = self.bytes
        out = b"".join([pieces[i] for i in ids.tolist()])
        if self.prefix and out[:1] == b" ":
            out = out[1:]
        return out.decode("utf-8", "replace")


def _loader(docs: DataFrame, model_file: str) -> Callable[[], PieceModel]:
    """A function that gives each Python worker its one model; the file is read on the driver."""
    with open(model_file, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def load() -> PieceModel:
        held = globals().setdefault("_models", {})
        key = hash(shared.value)
        if key not in held:
            held.clear()
            held[key] = PieceModel(shared.value)
        return held[key]

    return load


def _parts(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of rows of a few million characters."""
    row, texts, size = 0, [], 0
    for i in range(len(column)):
        text = column[i].as_py()
        texts.append(text)
        size += len(text or "")
        if size >= BATCH_CHARS:
            yield row, texts
            row, texts, size = i + 1, [], 0
    if texts:
        yield row, texts


def encode(docs: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ids array<int>, n_tokens and round_trip (whether the ids decode to the text again).

    All rows and other columns stay; columns already called like the three are replaced. An empty
    text has no ids; a null text has none either, and a null round_trip. A text holding U+2581
    itself does not come back as it was: that sign stands for a space.
    """
    docs = docs.drop("ids", "n_tokens", "round_trip")
    load, at = _loader(docs, model_file), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for batch in batches:
            for row, texts in _parts(batch.column(at)):
                ids = [model.encode(t or "") for t in texts]
                same = [None if t is None else model.decode(x) == t for t, x in zip(texts, ids, strict=True)]
                sizes = np.array([len(x) for x in ids], np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(np.concatenate(ids)))
                part = batch.slice(row, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(sizes), pa.array(same, pa.bool_())], [*part.schema.names, "ids", "n_tokens", "round_trip"])

    made = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.IntegerType()), T.StructField("round_trip", T.BooleanType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *made]))


def decode(rows: DataFrame, model_file: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``rows`` with the text of ``ids_col``; a null list has a null text. Ids outside the vocabulary raise."""
    rows = rows.drop(out_col)
    load, at = _loader(rows, model_file), rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for batch in batches:
            texts = [None if x is None else model.decode(np.array(x, np.int64)) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out_col])

    return rows.select("*").mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out_col, T.StringType())]))
