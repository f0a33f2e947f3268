"""A stream of files into a stored graph: each document is what its newest version says, in whatever order files come.

The state is the graph itself: a document's record names the time, name and path of the file that it was made from, and a micro-batch
reads only the buckets to which its documents belong. What is late (older than what the graph holds) is left out, so is
what was there already; a batch that runs again after a crash therefore changes nothing. Nothing is kept beside the graph but the stream's own offsets,
and there is no time after which a late file is forgotten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartolex.plans import graph_store
from cartolex.sources import files
from cartolex.staging import released_after

FILES = "path string, modificationTime timestamp, length long, content binary"


def file_stream(spark: SparkSession, directory: str, pattern: str = "*.pdf", at_once: int = 1000) -> DataFrame:
    """The files of a directory and those below it, as they come; a version of a file that is written in place isn't seen, so it needs a path of its own."""
    return spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", pattern).option("recursiveFileLookup", True).option("maxFilesPerTrigger", at_once).load(directory)


def upsert_files(found: DataFrame, target: str, failed: str | None = None, decoder: files.Decoder = files.form_feed_decoder, buckets: int | None = None, canonical: str = "reference", **models) -> None:
    """One batch of files (path, modificationTime, length, content) into the graph at ``target``.

    Of files that map to one document the newest counts, names and paths decide between equal times. Files without a readable page
    become rows of a table at ``failed``, if that is given; a batch that runs again repeats them. An empty batch, or one without a
    readable file, changes nothing. References, topics and keywords of versions that were replaced later stay, cited by nothing.
    """
    with released_after():
        pages, bad = files.pages(found, decoder, modified=True)
        if failed is not None:
            bad.withColumn("seenAt", F.current_timestamp()).write.mode("append").parquet(failed)
        if not pages.isEmpty():
            graph_store.ingest(pages, target, buckets=buckets, canonical=canonical, newest=True, **models)


def upsert(stream: DataFrame, target: str, checkpoint: str, available_now: bool = True, **options) -> StreamingQuery:
    """Puts a stream of files into the graph at ``target``, batch by batch; ``options`` go to :func:`upsert_files`."""
    writer = stream.writeStream.foreachBatch(lambda batch, _: upsert_files(batch, target, **options)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
