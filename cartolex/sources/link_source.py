"""Link lists as a data source: ``spark.read.format("links")`` fetches, and ``readStream`` fetches what is new.

Links are dealt by Spark into a table of their own (:func:`deal`): each deal is a batch of the urls that no earlier
one had, in slots by host. The source reads it with one partition a slot, so that a host is asked by one
task at a time (``per_host`` tasks, if it may be more), and a task asks one url after another. The driver names slots and batches only, never urls.
A filter on ``host`` leaves the slots of other hosts unread. A stream's offset is the number of batches dealt, so it fetches every url once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import dataset
from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

from cartolex.sources.links import FETCHED, Fetcher, fetched, http_fetcher
from cartolex.staging import exists

HOST = r"^[^:/?#]+://([^/?#]*)"
#: Slots of a new list: no more hosts than this are asked at a time, times ``per_host``.
SLOTS = 256
SCHEMA = "url string, host string, ok boolean, content binary, content_type string, warning string, error string"


def deal(df: DataFrame, folder: str, slots: int = SLOTS, per_host: int = 1) -> int:
    """Adds the urls of ``df`` that the list at ``folder`` lacks as a batch of its own, and returns how many; 0 writes none.

    ``slots`` and ``per_host`` are those of the first deal ever after. Null urls are left out, repeated ones are one; other columns
    are not kept. One deal at a time: of two at once the second fails. A hot host's urls are written by many tasks.
    """
    spark = df.sparkSession
    if not exists(spark, f"{folder}/form/_SUCCESS"):
        spark.range(1).select(F.lit(slots).alias("slots"), F.lit(per_host).alias("per_host")).coalesce(1).write.mode("overwrite").parquet(f"{folder}/form")
    slots, per_host = spark.read.parquet(f"{folder}/form").select("slots", "per_host").first()
    new = df.where("url is not null").select(F.col("url").cast("string")).distinct()
    number = 0
    while exists(spark, f"{folder}/batches/batch={number}/_SUCCESS"):
        number += 1
    if number:
        new = new.join(spark.read.parquet(*[f"{folder}/batches/batch={i}" for i in range(number)]).select("url"), "url", "left_anti")
    host = F.lower(F.regexp_extract("url", HOST, 1))
    slot = F.pmod(F.crc32(host.cast("binary")), F.lit(slots)) * per_host + F.pmod(F.xxhash64("url"), F.lit(per_host))
    placed = new.select("url", host.alias("host"), slot.cast("int").alias("slot")).hint("rebalance", "slot")
    placed.write.partitionBy("slot").mode("overwrite" if exists(spark, f"{folder}/batches/batch={number}/_temporary") else "errorifexists").parquet(f"{folder}/batches/batch={number}")
    made = spark.read.schema("url string, host string").parquet(f"{folder}/batches/batch={number}").count()
    return made


class Slot(InputPartition):
    """One slot of some batches, and the hosts wanted (all, if None)."""

    def __init__(self, slot: int, batches: tuple[int, int], hosts: frozenset[str] | None) -> None:
        self.slot, self.batches, self.hosts = slot, batches, hosts


class _List:
    """A dealt list as tasks and the planner see it."""

    def __init__(self, folder: str, fetcher: Fetcher) -> None:
        self.uri, self.fetcher = re.sub(r"^(?:file:)?/+", "file:///", folder), fetcher

    def _open(self) -> tuple[files.FileSystem, str]:
        return files.FileSystem.from_uri(self.uri)

    def batches(self) -> int:
        """How many batches are whole."""
        system, root = self._open()
        n = 0
        while system.get_file_info(f"{root}/batches/batch={n}/_SUCCESS").type == files.FileType.File:
            n += 1
        return n

    def slots(self, hosts: frozenset[str] | None, batches: tuple[int, int]) -> list[Slot]:
        system, root = self._open()
        form = dataset.dataset(f"{root}/form", format="parquet", filesystem=system, exclude_invalid_files=True).to_table()
        slots, per_host = form["slots"][0].as_py(), form["per_host"][0].as_py()
        own = range(slots) if hosts is None else sorted({zlib.crc32(h.encode()) % slots for h in hosts})
        return [Slot(s * per_host + j, batches, hosts) for s in own for j in range(per_host)]

    def fetch(self, part: Slot) -> Iterator[pa.RecordBatch]:
        system, root = self._open()
        for batch in range(*part.batches):
            folder = f"{root}/batches/batch={batch}/slot={part.slot}"
            if system.get_file_info(folder).type != files.FileType.Directory:
                continue
            for rows in dataset.dataset(folder, format="parquet", filesystem=system).to_batches(columns=["url", "host"], batch_size=4096):
                for url, host in zip(rows.column("url").to_pylist(), rows.column("host").to_pylist(), strict=True):
                    if part.hosts is None or host in part.hosts:
                        got = next(fetched([url], self.fetcher))
                        yield pa.RecordBatch.from_arrays([got.column("url"), pa.array([host]), *got.columns[1:]], ["url", "host", *list(FETCHED)[1:]])


class _Reader(DataSourceReader):
    def __init__(self, links: _List) -> None:
        self.links, self.hosts = links, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Equality of ``host`` picks slots; every filter is left to Spark as well."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("host",):
                wanted = frozenset(f.value if isinstance(f, In) else [f.value])
                self.hosts = wanted if self.hosts is None else self.hosts & wanted
            yield f

    def partitions(self) -> list[Slot]:
        return self.links.slots(self.hosts, (0, self.links.batches()))

    def read(self, partition: Slot) -> Iterator[pa.RecordBatch]:
        return self.links.fetch(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, links: _List) -> None:
        self.links = links

    def initialOffset(self) -> dict:  # noqa: N802
        return {"batch": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"batch": self.links.batches()}

    def partitions(self, start: dict, end: dict) -> list[Slot]:
        return self.links.slots(None, (start["batch"], end["batch"])) if start["batch"] < end["batch"] else []

    def read(self, partition: Slot) -> Iterator[pa.RecordBatch]:
        return self.links.fetch(partition)

    def commit(self, end: dict) -> None:
        """The list is kept: it says what was seen."""


def register(spark: SparkSession, fetcher: Fetcher | None = None, name: str = "links") -> None:
    """Makes ``spark.read.format(name).load(folder)`` and its stream fetch a dealt list by ``fetcher`` (HTTP by default), and lets host filters reach it."""
    asks, called = fetcher or http_fetcher(), name

    class Links(DataSource):
        @classmethod
        def name(cls) -> str:
            return called

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return _Reader(_List(self.options["path"], asks))

        def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
            return _StreamReader(_List(self.options["path"], asks))

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Links)
