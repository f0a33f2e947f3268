"""Enriched chunk texts and their vectors, from an embedder behind a small interface."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolex.operators.graph import roots
from cartolex.operators.ledger import Ledger, ask

#: Takes a batch of texts and returns a vector for each.
Embedder = Callable[[list[str]], list[list[float]]]


def chunk_context(chunks: DataFrame, sections: DataFrame, documents: DataFrame, child_edges: DataFrame | None = None, scope: str = "all") -> DataFrame:
    """Chunks with their section's and document's properties; ``root`` keeps those of sections without a parent."""
    own = sections if scope == "all" or child_edges is None else roots(sections, "sectionId", child_edges)
    s = own.select("sectionId", F.col("sectionNumber").alias("section_number"), F.col("title").alias("section_title"), F.col("order").alias("section_order"))
    d = documents.select("documentId", F.col("type").alias("doc_type"), F.col("number").alias("doc_number"), F.col("year").alias("doc_year"))
    return chunks.select("chunkId", "documentId", "sectionId", "content", "chunkIndex").join(s, "sectionId").join(d, "documentId")


def enriched_text() -> Column:
    """The text that is embedded, from the columns of :func:`chunk_context`."""
    title = F.when(F.coalesce(F.col("section_title"), F.lit("")) != "", F.concat(F.lit(" - "), F.col("section_title"))).otherwise("")
    return F.concat(F.format_string("Documento: %s %s/%s\nSezione: %s", "doc_type", "doc_number", F.col("doc_year").cast("string"), "section_number"), title, F.lit("\n\n"), F.col("content"))


def hash_embedder(dim: int) -> Embedder:
    """The offline default: unit vectors of hashed word counts. A word's md5 gives its place (first 8 digits) and sign (ninth, even: +)."""
    known: dict[str, tuple[int, float]] = {}

    def place(word: str) -> tuple[int, float]:
        if word not in known:
            if len(known) > 200_000:
                known.clear()
            digits = hashlib.md5(word.encode(), usedforsecurity=False).hexdigest()
            known[word] = int(digits[:8], 16) % dim, 1.0 - 2.0 * (int(digits[8], 16) % 2)
        return known[word]

    def embed(texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), dim))
        for row, text in enumerate(texts):
            found = [place(w) for w in text.lower().split()]
            if found:
                at, sign = zip(*found, strict=True)
                out[row] = np.bincount(at, sign, dim)
        return list(out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-300))

    return embed


def embed(rows: DataFrame, key: str, text: str, embedder: Embedder, batch: int = 500, max_concurrent: int | None = None, kept: Ledger | None = None) -> DataFrame:
    """``(key, embedding)``; a batch for which the embedder raises or returns another number of vectors gives no rows, and the others go on.

    ``max_concurrent`` is the most tasks that call the embedder at a time. With a ledger, only texts that it lacks are embedded, in its batches.
    """
    if kept is not None:
        vectors = lambda texts: [[float(x) for x in v] for v in embedder(texts)]
        said = ask(rows, key, text, vectors, "array<float>", replace(kept, batch=max(2, batch)), max_concurrent)
        return said.where("result is not null").select(key, F.col("result").alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for low in range(0, part.num_rows, batch):
                some = part.slice(low, batch)
                try:
                    made = embedder([t or "" for t in some.column(1).to_pylist()])
                except Exception as e:  # the batch stays without vectors, as the completeness report shows
                    print(f"a batch of {some.num_rows} texts has no vectors: {type(e).__name__}: {e}", file=sys.stderr)
                    continue
                if len(made) == some.num_rows:
                    yield pa.RecordBatch.from_arrays([some.column(0), pa.array(made, pa.list_(pa.float32()))], [key, "embedding"])

    asked = rows.select(key, text)
    asked = asked.repartition(max_concurrent) if max_concurrent else asked
    return asked.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, embedding array<float>")


def set_embeddings(chunks: DataFrame, vectors: DataFrame, key: str = "chunkId") -> DataFrame:
    """Chunk records with their vectors; chunks without one keep what they had."""
    new = vectors.select(key, F.col("embedding").alias("_new"))
    return chunks.join(new, key, "left").withColumn("embedding", F.coalesce("_new", "embedding")).select(*chunks.columns)
