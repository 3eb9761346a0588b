"""Incremental ingest: new text files become chunks, each file once.

An extension: batch ingest resumes by an anti-join, a stream by its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeloom.sources.files import decode_text, line_chunks

_FILES = "path string, modificationTime timestamp, length long, content binary"


def stream_chunks(spark: SparkSession, folder: str, glob: str = "*.txt", size: int = 500, overlap: int = 50, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of chunks of the files that appear in the folder."""
    files = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger).load(folder)
    return line_chunks(files.select(F.col("path").alias("source_path"), decode_text(F.col("content")).alias("text")), size=size, overlap=overlap)


def ingest(spark: SparkSession, folder: str, target: str, checkpoint: str, **options) -> StreamingQuery:
    """Append the chunks of all files that are new since the checkpoint, then stop."""
    return stream_chunks(spark, folder, **options).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
