"""Language ID: the nearest of several clustered centroids per language, by cosine.

* Features are byte bigrams and trigrams of the whole text over lower-case letters, any other run
  of bytes counting as one space, hashed into ``DIM`` cells, weighted 1 + ln(tf) and by idf, and
  scaled to unit length.
* Each language's training vectors are clustered by spherical k-means; up to ``CENTROIDS`` centroids
  each. The fit uses at most ``PER_LANGUAGE`` rows of each language, those of the smallest id hashes.
* A text belongs to its nearest centroid's language. It is rejected if it has no letter, or if it
  lies farther from that centroid than any training text of the language that has as many n-grams
  (by powers of two) or more, plus a margin. Texts of under 32 n-grams are too short to reject.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cartolex.llm import words
from cartolex.llm.scratch import fresh, give_back

DIM_BITS = 14
DIM = 1 << DIM_BITS
CENTROIDS = 4
#: At most so many training rows of each language, and in all.
PER_LANGUAGE, MOST = 800, 20_000
MARGIN = 0.15
SIZE_CLASSES, SHORT = 16, 5
UNKNOWN = "und"

_LETTER = words.CLASSES == 1
_FOLD = np.where(_LETTER, words._LOWER, 32).astype(np.uint8)
_A, _B, _C = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))


def _features(column: pa.Array) -> Iterator[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
    """First row, and each text's cells in use with their counts.

    A text stands between two spaces of its own, so its n-grams depend on nothing before or after it.
    """
    for row, _, data, offsets in words.slices(column):
        n = len(offsets) - 1
        folded = np.full(len(data) + n + 1, 32, np.uint8)
        edges = offsets + np.arange(n + 1)
        inner = np.ones(len(folded), bool)
        inner[edges] = False
        folded[inner] = _FOLD[data]
        keep = np.ones(len(folded), bool)
        keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32)
        keep[edges] = True
        at = np.flatnonzero(keep)  # runs of spaces have become one
        edge = ~inner[at]
        beside = np.zeros(len(at), bool)
        beside[1:] = edge[:-1]
        beside[:-1] |= edge[1:]
        at = at[edge | (folded[at] != 32) | ~beside]  # and the text's own spaces at its ends go
        where = np.flatnonzero(~inner[at])
        wide = folded[at].astype(np.uint32)
        two = wide[:-1] * _A + wide[1:] * _B
        three = (two[:-1] ^ (two[:-1] >> np.uint32(15))) * _C + wide[2:] * _A
        two, three = (((x ^ (x >> np.uint32(13))) * _B >> np.uint32(32 - DIM_BITS)).astype(np.int64) for x in (two, three))
        out = []
        for a, b in zip(where[:-1], where[1:], strict=True):
            if b - a < 2:  # nothing but spaces
                out.append((np.zeros(0, np.int16), np.zeros(0, np.int32)))
                continue
            counts = np.bincount(two[a:b], minlength=DIM) + np.bincount(three[a : b - 1], minlength=DIM)
            used = np.flatnonzero(counts)
            out.append((used.astype(np.int16), counts[used].astype(np.int32)))
        yield row, out


@dataclass
class LanguageModel:
    """Centroids (one row each), their languages, idf weights, and rejection distances by language and size class."""

    centroids: np.ndarray
    owners: np.ndarray
    idf: np.ndarray
    languages: list[str]
    limits: np.ndarray

    def weighted(self, used: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = ((1 + np.log(counts)) * self.idf[used]).astype(np.float32)
        return v / max(1e-9, float(np.sqrt((v * v).sum())))

    def nearest(self, used: np.ndarray, counts: np.ndarray) -> tuple[int, float]:
        """The language (index) of the nearest centroid, and its cosine."""
        if not len(used):
            return 0, 0.0
        cosines = self.weighted(used, counts) @ self.centroids[used]
        best = int(np.argmax(cosines))
        return int(self.owners[best]), float(np.clip(cosines[best], 0, 1))

    def rejects(self, owner: int, score: float, used: np.ndarray) -> bool:
        return 1 - score > self.limits[owner, size_class(used)]

    def predict(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` with lang_pred, score (cosine to the nearest centroid) and rejected; every row and other column stays.

        A null text or one without a letter, and any text where nothing could be learned, is
        ``und`` with score 0, and rejected. A text of one letter has the n-grams of that letter between two spaces.
        Columns already called like the three are replaced.
        """
        docs = docs.drop("lang_pred", "score", "rejected")
        if not self.languages:
            return docs.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
        shared = docs.sparkSession.sparkContext.broadcast(self)
        asked = docs.select("*", F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias(fresh(docs.columns, "lettered")[0]))
        at = docs.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for batch in batches:
                for row, texts in _features(batch.column(at)):
                    part = batch.slice(row, len(texts))
                    lettered = part.column(part.num_columns - 1).to_pylist()
                    found = [model.nearest(*x) if ok else (-1, 0.0) for x, ok in zip(texts, lettered, strict=True)]
                    names = pa.array([model.languages[k] if k >= 0 else UNKNOWN for k, _ in found], pa.string())
                    rejected = pa.array([k < 0 or model.rejects(k, s, used) for (k, s), (used, _) in zip(found, texts, strict=True)], pa.bool_())
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], names, pa.array([s for _, s in found], pa.float64()), rejected], [*part.schema.names[:-1], "lang_pred", "score", "rejected"])

        made = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
        return asked.mapInArrow(run, T.StructType([*docs.schema.fields, *made]))


def size_class(used: np.ndarray) -> int:
    """Texts by their number of distinct n-grams, in powers of two."""
    return min(SIZE_CLASSES - 1, len(used).bit_length())


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread-out seeds; unit centroids."""
    centres = [x.mean(0)]
    far = x @ centres[0]
    while len(centres) < min(k, len(x)):
        centres.append(x[int(np.argmin(far))])
        far = np.maximum(far, x @ centres[-1])
    c = np.stack(centres)
    for _ in range(rounds):
        c /= np.maximum(1e-9, np.linalg.norm(c, axis=1, keepdims=True))
        of = np.argmax(x @ c.T, 1)
        c = np.stack([x[of == i].mean(0) if (of == i).any() else c[i] for i in range(len(c))])
    return c / np.maximum(1e-9, np.linalg.norm(c, axis=1, keepdims=True))


def train(docs: DataFrame, usable: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_language: int = PER_LANGUAGE) -> LanguageModel:
    """A model from the rows for which ``usable`` holds and the language is not null.

    The sample is, of each language, the ``per_language`` rows of the smallest id hashes, or fewer where there are so many
    languages that this would pass ``MOST`` in all, but one at least. It doesn't depend on how rows are dealt to tasks; rows
    that repeat an id are one, with the least of their texts, and rows without an id are drawn by their text. Texts stay on the executors:
    the driver gets their cells in use, at most 2^14 a row however long the text.
    """
    usable_rows = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in usable_rows.groupBy(lang_col).count().collect()}  # one row a language
    if not counts:
        return LanguageModel(np.zeros((DIM, 0), np.float32), np.zeros(0, int), np.ones(DIM), [], np.ones((0, SIZE_CLASSES)))
    most = max(1, min(per_language, MOST // len(counts)))
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col(lang_col) == lang, F.lit(min(1.0, 1.25 * (most + 16) / n))).otherwise(share)
    hashed = F.pmod(F.xxhash64(F.lit(11), F.coalesce(F.col(id_col).cast("string"), F.col(text_col))), F.lit(1 << 30))
    drawn = usable_rows.select(hashed.alias("draw"), share.alias("share"), F.col(id_col).cast("string").alias("i"), F.col(lang_col).alias("l"), F.col(text_col).alias("t"))
    drawn = drawn.where(F.col("draw") < F.col("share") * float(1 << 30)).groupBy("l", "draw").agg(F.min(F.struct("i", "t")).alias("x"))  # repeated ids meet before the driver
    place = F.row_number().over(Window.partitionBy("l").orderBy("draw"))  # over about 1.25 times the sample
    sample = drawn.withColumn("place", place).where(F.col("place") <= most).select(F.col("l").cast("string").alias("l"), "draw", "x.t")

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in _features(batch.column(2)):
                part = batch.slice(row, len(texts))
                made = [pa.array([x[k].tobytes() for x in texts], pa.binary()) for k in range(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made], ["l", "draw", "used", "counts"])

    sample = sample.mapInArrow(cells, "l string, draw long, used binary, counts binary").toPandas().sort_values(["l", "draw"])
    languages = sorted(set(sample["l"]))
    features = [(np.frombuffer(u, np.int16), np.frombuffer(n, np.int32)) for u, n in zip(sample.pop("used"), sample.pop("counts"), strict=True)]
    present = np.zeros(DIM)
    for used, _ in features:
        present[used] += 1
    idf = np.log((1 + len(features)) / (1 + present)) + 1
    model = LanguageModel(np.zeros((DIM, 0), np.float32), np.zeros(0, int), idf, languages, np.ones((len(languages), SIZE_CLASSES)))
    centroids, owners = [], []
    for k, lang in enumerate(languages):
        of = [features[i] for i in np.flatnonzero((sample["l"] == lang).to_numpy())]
        x = np.zeros((len(of), DIM), np.float32)
        for row, (used, n) in enumerate(of):
            x[row, used] = model.weighted(used, n)
        c = _clusters(x, CENTROIDS)
        away = 1 - (x @ c.T).max(1)
        classes = np.array([size_class(used) for used, _ in of])
        for size in range(SHORT + 1, SIZE_CLASSES):
            if (classes >= size).any():
                model.limits[k, size] = min(1.0, float(away[classes >= size].max()) + MARGIN)
        centroids.append(c)
        owners += [k] * len(c)
    model.centroids = np.ascontiguousarray(np.concatenate(centroids).T.astype(np.float32))
    model.owners = np.array(owners)
    del features, x
    give_back()
    return model
