"""Files as pages: a directory scan and a decoder behind an interface."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolex.schemas import PAGES
from cartolex.staging import stage

_NAMES = ("filename", "file_size", "page_no", "text")
_TYPES = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string())

#: Characters of pages, and pages, that are handed on at a time.
SLICE_CHARS, SLICE_PAGES = 1 << 20, 4096

#: Takes a file's bytes and returns its pages' texts.
Decoder = Callable[[bytes], list[str]]


def form_feed_decoder(content: bytes) -> list[str]:
    """The offline default: plain text with form feeds between pages."""
    return content.decode("utf-8", "replace").split("\f")


def scan(spark: SparkSession, directory: str, pattern: str = "*.pdf", limit: int = 0, recursive: bool = False) -> DataFrame:
    """The directory's files in the order of their paths; a limit of 0 means all."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).load(directory)
    return files.orderBy("path").limit(limit) if limit else files


def pages(files: DataFrame, decoder: Decoder = form_feed_decoder, modified: bool = False) -> tuple[DataFrame, DataFrame]:
    """Page records, and (path, filename, error) of files that couldn't be decoded or have no page: one bad file stops nothing.

    Files are decoded once, into a staged table that both results read. Records carry the file's path, so
    files of one name in two folders stay apart; with ``modified`` also its time, so that of two versions the newer one counts. One file is held in Python at a time, page by page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, size = (batch.column(c)[i].as_py() for c in range(2))
                times = [batch.column(c).take(pa.array([i])) for c in range(3, batch.num_columns)]
                try:
                    texts = decoder(batch.column(2)[i].as_py())
                    error = None if texts else "no pages"
                except Exception as e:  # reported as a row
                    texts, error = [], f"{type(e).__name__}: {e}"
                for first, some in _slices(texts):
                    rows = [(path, path.rsplit("/", 1)[-1], size, k if texts else None, t, error) for k, t in enumerate(some, first + 1)]
                    more = [t.take(pa.array([0] * len(rows))) for t in times]
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)), *more], ["path", *_NAMES, "error", *(["modified"] if more else [])])

    time = [F.col("modificationTime").alias("modified")] if modified else []
    out = files.select("path", F.col("length").alias("file_size"), "content", *time).mapInArrow(run, f"path string, {PAGES}, error string{', modified timestamp' if modified else ''}")
    made = stage(out, "pages")
    return made.where("error is null").drop("error"), made.where("error is not null").select("path", "filename", "error")


def _slices(texts: list[str]) -> Iterator[tuple[int, list[str | None]]]:
    """A file's pages in slices, each with its first page's place; one empty page for a file without any."""
    first = chars = 0
    for k, t in enumerate(texts):
        if k > first and (chars + len(t or "") > SLICE_CHARS or k - first == SLICE_PAGES):
            yield first, texts[first:k]
            first, chars = k, 0
        chars += len(t or "")
    yield first, texts[first:] or [None]


def pdf_decoder(content: bytes) -> list[str]:
    """A PDF's pages as texts, by ``pypdf`` or ``fitz``, whichever is installed on the executors; raises if neither is."""
    for name, read in (("fitz", _by_fitz), ("pypdf", _by_pypdf)):
        if importlib.util.find_spec(name):
            return read(content)
    raise RuntimeError("no PDF library is installed")


def _by_fitz(content: bytes) -> list[str]:
    import fitz

    with fitz.open(stream=content, filetype="pdf") as book:
        return [page.get_text() for page in book]


def _by_pypdf(content: bytes) -> list[str]:
    import io

    from pypdf import PdfReader

    return [page.extract_text() or "" for page in PdfReader(io.BytesIO(content)).pages]
