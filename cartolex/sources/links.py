"""Link lists: CSV cells of urls, file names for them, and fetching behind an interface."""

from __future__ import annotations

import http.client
import time
import urllib.request
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartolex.operators.numbering import numbered

LINKS = "LINK DOCUMENTI ESTRATTI"
#: What a fetch returns: content or null, content type, error or null.
Fetcher = Callable[[str], tuple[bytes | None, str, str | None]]
#: A name's stem and extension; a stem that ends with a number.
_NAME, _NUMBERED = r"^(.*?)(\.[^.]*)?$", r"^(.*)_([1-9]\d{0,8})(\.[^.]*)?$"
FETCHED = {"url": pa.string(), "ok": pa.bool_(), "content": pa.binary(), "content_type": pa.string(), "warning": pa.string(), "error": pa.string()}


def read_questions(spark: SparkSession, path: str, links: str = LINKS) -> DataFrame:
    """A CSV with quoted cells of several lines; its link column must be there."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    if links not in df.columns:
        raise ValueError(f"{path} has no column {links}")
    return df


def urls(df: DataFrame, links: str = LINKS) -> DataFrame:
    """(row columns, url): each cell's parts that start with http; empty cells and N/A have none."""
    cell = F.col(links)
    used = df.where(cell.isNotNull() & ~F.upper(F.trim(cell)).isin("N/A", ""))
    return used.withColumn("url", F.explode(F.split(F.trim(cell), r"\s+"))).where(F.col("url").startswith("http"))


def file_name(url: Column) -> Column:
    """A file name from a url's path: its last part, or the first part that ends in .pdf, or a hash."""
    path = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    parts = F.split(path, "/", -1)
    pdf = F.filter(parts, lambda p: p.endswith(".pdf"))
    last = F.element_at(parts, -1)
    named = F.when(last.endswith(".pdf"), last).when(F.size(pdf) > 0, F.get(pdf, F.lit(0))).otherwise(F.concat(F.lit("document_"), F.lower(F.hex(F.xxhash64(url))), F.lit(".pdf")))
    return F.regexp_replace(named, r"(?U)[^\w\s\-\.]", "_")


def distinct_names(df: DataFrame, name: str, order: str) -> DataFrame:
    """``df`` with ``name`` made distinct: a name's first row in ``order`` keeps it, later ones get the free suffixes _1, _2, ... in turn.

    A suffix is free if no row has the name that it makes by itself. The j-th further row of a name takes the j-th
    free number: further rows and taken numbers are put in one order, where a taken number comes before
    the rows that must pass over it, and a row's number is its place there. Null names stay null.
    """
    stem, end = F.regexp_extract(name, _NAME, 1), F.regexp_extract(name, _NAME, 2)
    placed = numbered(df, [order], [name], "_k")
    again = placed.where(F.col(name).isNotNull() & (F.col("_k") > 0)).select(F.col(name).alias("_name"), stem.alias("_stem"), end.alias("_end"), F.col("_k").alias("_key"))
    numbers = df.where(F.col(name).rlike(_NUMBERED)).select(F.regexp_extract(name, _NUMBERED, 1).alias("_stem"), F.regexp_extract(name, _NUMBERED, 3).alias("_end"), F.regexp_extract(name, _NUMBERED, 2).cast("long").alias("_taken")).distinct()
    numbers = numbers.join(again.select("_stem", "_end").distinct(), ["_stem", "_end"], "left_semi")
    free_before = numbered(numbers, ["_taken"], ["_stem", "_end"], "_i").select(F.lit(None).cast("string").alias("_name"), "_stem", "_end", (F.col("_taken") - F.col("_i") - 1).alias("_key"), F.lit(1).alias("_kind"))
    merged = again.select("*", F.lit(0).alias("_kind")).union(free_before)
    suffix = numbered(merged, ["_key", "_kind"], ["_stem", "_end"], "_p").where("_kind = 0")
    made = suffix.select("_name", F.col("_key").alias("_no"), F.concat("_stem", F.lit("_"), (F.col("_p") + 1).cast("string"), "_end").alias("_new"))
    out = placed.join(made, (F.col(name) == F.col("_name")) & (F.col("_k") == F.col("_no")), "left")
    return out.withColumn(name, F.coalesce("_new", name)).select(*df.columns)


def no_network(url: str) -> tuple[bytes | None, str, str | None]:
    """The offline default."""
    return None, "", "no fetcher is set"


def http_fetcher(timeout: float = 30.0, pause: float = 0.5, agent: str = "Mozilla/5.0 (compatible; document fetcher)") -> Fetcher:
    """Fetches by HTTP with a user agent, following redirects; a status of 400 or more is an error. Waits ``pause`` seconds after each url."""

    def fetch_one(url: str) -> tuple[bytes | None, str, str | None]:
        try:
            with urllib.request.urlopen(urllib.request.Request(url.strip(), headers={"User-Agent": agent}), timeout=timeout) as answer:
                return answer.read(), answer.headers.get_content_type(), None
        except (OSError, ValueError, http.client.HTTPException) as e:
            return None, "", f"{type(e).__name__}: {e}"
        finally:
            time.sleep(pause)

    return fetch_one


def fetched(urls: Iterable[str], fetcher: Fetcher) -> Iterator[pa.RecordBatch]:
    """One row a url, each handed on as soon as it is there; a fetcher that raises makes a row with its error."""
    for url in urls:
        try:
            content, kind, error = fetcher(url)
        except Exception as e:  # reported as a row
            content, kind, error = None, "", f"{type(e).__name__}: {e}"
        odd = error is None and "pdf" not in (kind or "").lower() and not url.endswith(".pdf")
        values = (url, error is None, content, kind, f"content type is {kind}" if odd else None, error)
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, FETCHED.values(), strict=True)], list(FETCHED))


def fetch(df: DataFrame, fetcher: Fetcher = no_network, max_concurrent: int | None = None, per_host: int = 2) -> DataFrame:
    """(url, ok, content, content_type, warning, error) of each distinct url; one that fails, or whose fetcher raises, is a row with its error.

    Urls are dealt by host, each host's to ``per_host`` tasks, so that no host is asked by more tasks at a time however
    large the cluster is; a task fetches one url after another and hands each on at once. ``max_concurrent`` bounds
    the tasks of all hosts together. Content that is neither called PDF nor has a url ending in .pdf gets a warning.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fetched(batch.column("url").to_pylist(), fetcher)

    host = F.regexp_extract("url", r"^[^:/?#]+://([^/?#]*)", 1)
    dealt = df.where("url is not null").select("url").distinct().select("url", host.alias("host"), F.pmod(F.xxhash64("url"), F.lit(per_host)).alias("slot"))
    dealt = dealt.repartition(max_concurrent, "host", "slot") if max_concurrent else dealt.repartition("host", "slot")
    return dealt.mapInArrow(run, "url string, ok boolean, content binary, content_type string, warning string, error string")
