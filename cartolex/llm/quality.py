"""Quality classifier: random-indexing word vectors, pooled, and a two-layer numpy network.

* A token is a run of letters, of digits or of other signs. Tokens are hashed into
  ``VOCABULARY`` cells, whatever the corpus's size: random indexing needs no vocabulary, and words that share a cell share a
  vector. With a larger corpus more rare words do; the README has the held-out AUC with this number of cells. Each cell's index vector has two entries of +1 or -1 among ``DIM``; a cell's
  context vector is the sum of the index vectors of all neighbours within two tokens, over **all**
  rows. Map tasks add up whole-number vectors, so sums don't depend on their order.
* A document is the frequency-weighted mean of its tokens' unit context vectors, and the mean of
  their squares.
* The network (tanh layer, logistic output) is fitted on the driver on at most ``SAMPLE`` labelled
  documents, those of the smallest id hashes; a fifth of them sets the temperature of the output.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartolex.llm import words
from cartolex.llm.scratch import give_back

VOCABULARY_BITS, DIM, WINDOW = 14, 32, 2
VOCABULARY = 1 << VOCABULARY_BITS
#: Most labelled documents used for the fit.
SAMPLE = 12_000
HIDDEN, EPOCHS, RATE, DECAY = 32, 400, 0.02, 1e-3

_cells = np.arange(VOCABULARY, dtype=np.uint64)
_POSITION = np.stack([(words.mix(_cells * np.uint64(2) + np.uint64(k + 7)) % np.uint64(DIM)).astype(np.int64) for k in range(2)], 1)
_SIGN = np.stack([np.where(words.mix(_cells * np.uint64(3) + np.uint64(k + 91)) & np.uint64(1), 1.0, -1.0) for k in range(2)], 1)


def _tokens(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, cells of all tokens, and the first token of each text."""
    for row, _, data, offsets in words.slices(column):
        starts, ends, first = words.runs(data, offsets)
        yield row, (words.hashes(data, starts, ends) >> np.uint64(64 - VOCABULARY_BITS)).astype(np.int64), first


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(VOCABULARY * DIM, np.int64)
    counts = np.zeros(VOCABULARY, np.int64)
    for batch in batches:
        for _, cells, first in _tokens(batch.column(0)):
            counts += np.bincount(cells, minlength=VOCABULARY)
            of = np.repeat(np.arange(len(first) - 1), np.diff(first))
            where, signs = [], []
            for gap in range(1, WINDOW + 1):
                near = of[gap:] == of[:-gap] if len(of) > gap else np.zeros(0, bool)
                a, b = cells[:-gap][near] if len(near) else cells[:0], cells[gap:][near] if len(near) else cells[:0]
                for x, y in ((a, b), (b, a)):
                    for k in range(2):
                        where.append(x * DIM + _POSITION[y, k])
                        signs.append(_SIGN[y, k])
            total += np.bincount(np.concatenate(where), np.concatenate(signs), minlength=VOCABULARY * DIM).astype(np.int64)
    used = np.flatnonzero(counts)
    values = np.concatenate([total.reshape(VOCABULARY, DIM)[used], counts[used, None]], 1)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * (DIM + 1)), pa.array(values.reshape(-1)))],
        ["cell", "sums"],
    )


def word_vectors(texts: DataFrame) -> np.ndarray:
    """Unit context vectors of all cells, scaled by a smooth inverse frequency; from every row of ``texts`` (one string column)."""
    parts = texts.mapInArrow(_contexts, "cell int, sums array<long>")
    found = parts.groupBy("cell").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(DIM + 1)]).toPandas()  # one row a cell
    out = np.zeros((VOCABULARY, DIM), np.float32)
    if len(found):
        values = found.drop(columns="cell").to_numpy(np.float64)
        vectors = values[:, :DIM]
        vectors /= np.maximum(1e-9, np.linalg.norm(vectors, axis=1, keepdims=True))
        share = values[:, DIM] / values[:, DIM].sum()
        out[found["cell"].to_numpy()] = vectors * (1e-2 / (1e-2 + share))[:, None]
    return out


def pooled(column: pa.Array, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """First row, and each text's features: means of its token vectors and of their squares (zeros without tokens)."""
    for row, cells, first in _tokens(column):
        n = np.diff(first)
        out = np.zeros((len(n), 2 * DIM))
        full = np.flatnonzero(n)
        if len(full):
            drawn = vectors[cells]
            out[full, :DIM] = np.add.reduceat(drawn, first[full], dtype=np.float64)
            out[full, DIM:] = np.add.reduceat(drawn * drawn, first[full], dtype=np.float64)
            out[full] /= n[full, None]
        yield row, out


@dataclass
class Network:
    """Two layers and a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 0) -> Network:
    """The network for features ``x`` and labels ``y`` (0 or 1). One class, or no rows: the smoothed share of label 1."""
    width = x.shape[1]
    if len(y) < 10 or len(np.unique(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Network(np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), float(np.log(share / (1 - share))), 1.0)
    rng = np.random.RandomState(seed)
    held = rng.permutation(len(y)) < len(y) // 5
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / scale
    params = [rng.randn(width, HIDDEN) / np.sqrt(width), np.zeros(HIDDEN), rng.randn(HIDDEN) / np.sqrt(HIDDEN), np.array(0.0)]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    zt, yt = z[~held], y[~held]
    for step in range(1, EPOCHS + 1):
        w1, b1, w2, b2 = params
        h = np.tanh(zt @ w1 + b1)
        g = (1 / (1 + np.exp(-np.clip(h @ w2 + b2, -50, 50))) - yt) / len(yt)
        back = np.outer(g, w2) * (1 - h * h)
        grads = [zt.T @ back + DECAY * w1, back.sum(0), h.T @ g + DECAY * w2, g.sum()]
        for i, (p, d) in enumerate(zip(params, grads, strict=True)):
            m, v = moments[i]
            m *= 0.9
            m += 0.1 * d
            v *= 0.999
            v += 0.001 * d * d
            params[i] = p - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, params[0], params[1], params[2], float(params[3]), 1.0)
    logits = net.logits(x[held])

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, -np.where(y[held] > 0, 1, -1) * logits / t)))

    net.temperature = min(np.geomspace(0.25, 8, 60), key=loss)
    return net


@dataclass
class QualityModel:
    """Word vectors and the network over them."""

    vectors: np.ndarray
    network: Network

    def transform(self, docs: DataFrame, text_col: str = "text", score_col: str = "score") -> DataFrame:
        """``docs`` with a score column (0 to 1); every other column and row stays.

        Null and empty texts get the score of no tokens. A column already called like the score is replaced.
        """
        docs = docs.drop(score_col)
        shared = docs.sparkSession.sparkContext.broadcast(self)
        at = docs.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for batch in batches:
                for row, x in pooled(batch.column(at), model.vectors):
                    part = batch.slice(row, len(x))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.network.scores(x))], [*part.schema.names, score_col])

        return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> QualityModel:
    """Word vectors from all ``docs``; the network from at most ``sample`` rows of ``labels`` for which ``usable`` holds.

    An id labelled more than once counts once, with its mean label rounded; null labels don't count. Rows that repeat
    an id are one document for the fit, with the least of their texts.
    """
    vectors = word_vectors(docs.select(F.col(text_col).cast("string")))
    chosen = labels.where(usable & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.round(F.avg(label_col)).cast("int").alias("_label"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(chosen), "_id")  # at most ``sample`` small rows
    rows = rows.groupBy("_id", "_label").agg(F.min("_text").alias("_text"))  # rows that repeat an id meet before the driver
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, x in pooled(batch.column(2), shared.value):
                part = batch.slice(row, len(x))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), flat], ["_id", "_label", "x"])

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        found = rows.mapInArrow(run, "_id long, _label int, x array<double>").toPandas().sort_values("_id")
    x = np.stack(found.pop("x").to_list()) if len(found) else np.zeros((0, 2 * DIM))
    model = QualityModel(vectors, fit(x, found["_label"].to_numpy(np.float64)))
    del found, x
    give_back()
    return model
