"""Fill-in-middle rewriting by a table-driven machine over UTF-8 bytes.

A text falls into units: runs of ASCII letters, and every other code point by itself. One scan of the bytes
through a table of (state, byte) answers three questions at once: where a unit begins, where a code point
begins, and where a sentinel closes. The machine's transitions carry those marks; their running counts are
the sizes of a text, and a second pass looks up the cuts in the places of the counted marks.

The scan isn't a loop over bytes: a slice of texts is laid out as lanes that step together. A lane doesn't know
the state it starts in, so it starts in all of them until they agree (a few bytes), and the first steps are
then filled in from the state in which the lane before it ended. That holds for any table.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartolex.llm.scratch import fresh
from cartolex.llm.words import slices

#: The sentinels of prefix, suffix and middle; a text that holds one is left plain.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of texts left plain by lot, and percent of the others that put the suffix first.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
#: Marks on a transition.
UNIT, POINT, SENTINEL = 1, 2, 4
#: States: between units, in a run of letters, after "<", after "<" and a sentinel's letter, and 1 to 3 bytes before a code point ends.
BETWEEN, LETTERS, OPEN, NAMED, REST_1, REST_2, REST_3 = range(7)
LANES, LANE_BYTES = 4096, 64
#: The columns that :func:`transform` adds.
ADDED = (("fim_n", "long"), ("fim_form", "string"), ("fim_prefix_chars", "long"), ("fim_middle_chars", "long"), ("fim_output", "string"))


def _step(state: int, byte: int) -> tuple[int, int]:
    """The next state and the marks of one transition. A continuation byte that ends nothing is a unit by itself."""
    c = chr(byte)
    if state >= REST_1 and 0x80 <= byte < 0xC0:
        return (BETWEEN if state == REST_1 else state - 1), 0
    if c.isascii() and c.isalpha():
        named = state == OPEN and c in "PSM"
        return (NAMED if named else LETTERS), POINT | (0 if state in (LETTERS, NAMED) else UNIT)
    marks = UNIT | POINT | (SENTINEL if c == ">" and state == NAMED else 0)
    if c == "<":
        return OPEN, marks
    more = 1 if 0xC2 <= byte < 0xE0 else 2 if 0xE0 <= byte < 0xF0 else 3 if 0xF0 <= byte < 0xF5 else 0
    return (REST_1 + more - 1 if more else BETWEEN), marks


class ByteMachine:
    """A table of transitions over bytes, and over bytes that begin a text (256 more symbols), which start afresh."""

    def __init__(self, step=_step, states: int = 7, start: int = BETWEEN) -> None:
        made = [[step(s, b) for b in range(256)] + [step(start, b) for b in range(256)] for s in range(states)]
        self.states = states
        self.next = np.array([[to for to, _ in row] for row in made], np.intp).ravel() * 512
        self.marks = np.array([[marks for _, marks in row] for row in made], np.uint8).ravel()

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The marks of every byte's transition, for texts that begin at ``offsets``."""
        n = len(data)
        if not n:
            return np.zeros(0, np.uint8)
        symbols = data.astype(np.intp)
        begins = offsets[:-1]
        symbols[begins[begins < offsets[1:]]] += 256
        width = max(LANE_BYTES, -(-n // LANES))
        lanes = -(-n // width)
        grid = np.zeros(lanes * width, np.intp)
        grid[:n] = symbols
        grid = np.ascontiguousarray(grid.reshape(lanes, width).T)
        at = np.empty((width, lanes), np.intp)  # state * 512 + symbol, a step a row
        every = np.repeat(np.arange(self.states)[:, None] * 512, lanes, 1)
        agreed = 0
        while agreed < width and (every != every[0]).any():
            every = self.next[every + grid[agreed]]
            agreed += 1
        state = every[0]
        for t in range(agreed, width):
            at[t] = state + grid[t]
            state = self.next[at[t]]
        if agreed < width:  # a lane's end doesn't depend on its beginning
            first = np.concatenate([[0], state[:-1]])
        else:
            first = np.zeros(lanes, np.intp)
            for k in range(1, lanes):
                first[k] = every[first[k - 1] // 512, k - 1]
        for t in range(agreed):
            at[t] = first + grid[t]
            first = self.next[at[t]]
        return self.marks[at.T.reshape(-1)[:n]]


MACHINE = ByteMachine()


def _before(marks: np.ndarray, kind: int) -> np.ndarray:
    """How many transitions with a mark come before each byte, and in all."""
    out = np.zeros(len(marks) + 1, np.int64)
    np.cumsum((marks & kind) != 0, out=out[1:])
    return out


def lots(seed: int, key: object) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the seed and an id; a null id counts as an empty one."""
    return struct.unpack(">4I", hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()[:16])


def _rewritten(keys: list, data: np.ndarray, offsets: np.ndarray, seed: int) -> Iterator[tuple]:
    """(n, form, prefix_chars, middle_chars, output) of each text of a slice."""
    marks = MACHINE.scan(data, offsets)
    units, points, sentinels = (_before(marks, kind) for kind in (UNIT, POINT, SENTINEL))
    places = np.append(np.flatnonzero(marks & UNIT), 0)
    raw = data.tobytes()
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    for key, a, b in zip(keys, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        first = int(units[a])
        n = int(units[b]) - first
        h1, h2, h3, h4 = lots(seed, key)
        if not n or sentinels[b] > sentinels[a] or h3 % 100 >= 100 - PLAIN_PERCENT:
            yield n, "plain", None, None, raw[a:b]
            continue
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        x, y = (int(places[first + k]) if k < n else b for k in (low, high))
        prefix, middle, suffix = raw[a:x], raw[x:y], raw[y:b]
        spm = h4 % 100 < SPM_PERCENT
        parts = (s, suffix, p, prefix, m, middle) if spm else (p, prefix, s, suffix, m, middle)
        yield n, "spm" if spm else "psm", int(points[x] - points[a]), int(points[y] - points[x]), b"".join(parts)


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """``docs`` with each whole text rewritten for fill-in-middle training.

    New columns: ``fim_n`` (units), ``fim_form`` (plain, psm or spm), ``fim_prefix_chars`` and ``fim_middle_chars`` (code points;
    null if plain) and ``fim_output``. A new column whose name is taken in any case gets leading underscores.
    Cuts and form follow from the seed and the id alone, so repeated rows get equal results. A null text counts as empty
    and stays plain with an empty output; a null id counts as an empty one. A text of any length is scanned in
    memory of a small multiple of its bytes; shorter ones in slices of about 1 MB. Nothing is shuffled.
    """
    names = fresh(docs.columns, *[name for name, _ in ADDED])
    kinds = [kind for _, kind in ADDED]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(name, T.LongType() if kind == "long" else T.StringType()) for name, kind in zip(names, kinds, strict=True)]])
    every, key_at, text_at = [*docs.columns, *names], docs.columns.index(id_col), docs.columns.index(text_col)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(text_at)):
                rows = list(zip(*_rewritten(batch.column(key_at).slice(i, j - i).to_pylist(), data, offsets, seed), strict=True))
                made = [pa.array(rows[k], pa.int64()) for k in (0, 2, 3)]
                output = pa.array(rows[4], pa.binary()).view(pa.string())
                columns = [*batch.slice(i, j - i).columns, made[0], pa.array(rows[1], pa.string()), made[1], made[2], output]
                yield pa.RecordBatch.from_arrays(columns, names=every)

    return docs.mapInArrow(rewrite, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that a rewritten one came from; only markers at their places are read, so it is exact."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(len(first) + 1))
        one = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(one) + len(second) + 1)
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substr(rest, F.length(two) + len(MIDDLE) + 1)

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    tail, head, center = parts(SUFFIX, PREFIX)
    return F.when(form == "plain", output).when(form == "spm", F.concat(head, center, tail)).otherwise(F.concat(prefix, middle, suffix))
