"""Incremental ingest: new files are chunked as they come and added to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartolex.operators.chunks import chunk_texts


def chunk_stream(documents: DataFrame, key: str, text: str, size: int = 512, overlap: int = 50) -> DataFrame:
    """(key, chunkIndex, content) of a stream of documents; a narrow plan without state."""
    return documents.select(key, F.posexplode(chunk_texts(F.col(text), size, overlap)).alias("chunkIndex", "content"))


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, key: str = "doc_id", text: str = "text", size: int = 512, overlap: int = 50) -> StreamingQuery:
    """Chunks all Parquet files of ``source`` that aren't in the checkpoint yet into ``target``, then stops.

    Each micro-batch goes to a folder of its own number, so one that is run again replaces itself.
    """
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return chunk_stream(stream, key, text, size, overlap).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
