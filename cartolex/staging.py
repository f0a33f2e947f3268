"""Tables written once to the folder that the whole cluster shares, and read from there by all that follows.

A staged table is plain Parquet, so it outlives any executor, and the plan above it starts from a
scan: whatever made it (a decoder, a model, a shuffle) runs once. The folder is the session's
``spark.checkpoint.dir``. Only in local mode, where driver and executors are one machine, may it be
unset; :func:`shared_folder` then makes one of its own.
"""

from __future__ import annotations

import atexit
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Spark's own setting; off by default.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_made: dict[str, SparkSession] = {}
_own: ContextVar[set[str] | None] = ContextVar("staged", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables; raises on a cluster that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="cartolex-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted with all staged tables when the process ends."""
    root = f"{shared_folder(spark)}/cartolex-{uuid.uuid4().hex}"
    _made[root] = spark
    return f"{root}/{name}"


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back from there; by default compressed as the session says."""
    path = new_path(df.sparkSession, name)
    if (own := _own.get()) is not None:
        own.add(path.rsplit("/", 1)[0])
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, each finished query deletes its own shuffle files: for writes of staged tables, whose shuffles nothing reads again."""
    was = spark.conf.get(_FREE)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE, was)


@contextmanager
def released_after() -> Iterator[None]:
    """Deletes, at its end, what :func:`stage` wrote within it in this thread, also if it raises: for a plan whose result is written by then."""
    mine = _own.set(set())
    try:
        yield
    finally:
        for root in _own.get():
            if root in _made:
                delete(_made.pop(root), root)
        _own.reset(mine)


def release(*tables: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            root = file.rsplit("/", 2)[0]
            if any(root.rsplit("/", 1)[-1] == r.rsplit("/", 1)[-1] for r in _made):
                delete(df.sparkSession, root)
                for r in [r for r in _made if r.rsplit("/", 1)[-1] == root.rsplit("/", 1)[-1]]:
                    del _made[r]


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether there is something at a path of any file system that Spark reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def delete(spark: SparkSession, folder: str) -> bool:
    """Delete a folder of any file system that Spark reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def purge() -> None:
    """Delete every table staged by this process; what can't be deleted is named on stderr."""
    while _made:
        root, spark = _made.popitem()
        try:
            delete(spark, root)
        except Exception as e:  # the session may be gone already
            print(f"left behind: {root} ({type(e).__name__})", file=sys.stderr)
