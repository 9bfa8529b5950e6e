"""Files as a stream: each micro-batch is one batch of the store, committed once.

Duplicates across batches are found against the store, as in the daily batch, so no state grows with the stream.  Spark's
file source leaves empty files out of a stream; ``sources.files.list_files`` finds them in batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.basic import base_name
from ..operators.store import Store
from ..plans import batch


def file_stream(spark: SparkSession, folder: str, most_files: int = 1000) -> DataFrame:
    schema = "path string, modificationTime timestamp, length long, content binary"
    rows = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", most_files).load(folder)
    return rows.select("path", base_name(F.col("path")).alias("file_name"), "length", "content")


def ingest(files: DataFrame, store: Store, checkpoint: str, name: str = "ingest", **options):
    """Starts the stream over what is there now. A batch that runs again after a failure changes nothing twice."""

    def take(rows: DataFrame, number: int) -> None:
        batch.run(rows, store, f"{name}-{number}", **options)

    return files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def log_rates(logs: DataFrame, time: str = "ts", kind: str = "event_type", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """How many log rows of each kind fall into each time window; works on a stream, with late rows up to ``late``."""
    return logs.withWatermark(time, late).groupBy(F.window(time, width), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), kind, "n")
