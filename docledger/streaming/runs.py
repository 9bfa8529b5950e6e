"""Run logs from a stream of start and end events, and files told apart within a stream.

A run is what lies between a start and the next event of its key.  If that is an end within the time allowed, the run has ended,
well or with the end's error; if it is another start, the run did not end; else it is closed when its time is over.  An end
without a start counts for nothing.  Events may come late by up to the watermark's delay and in any order: they wait in the
state until the watermark has passed them, so the rows do not depend on how the stream is cut.  State holds at most the events of
the delay and one open run for each key, and a timer closes that.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

NOT_ENDED, TIMED_OUT = "Run did not end", "Run timed out"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_EVENT = "at long, id long, start boolean, error string"
_LOG = "run string, start_us long, end_us long, status string, error_message string"


class Runs(StatefulProcessor):
    """Pairs the events of one key. Times are microseconds."""

    def __init__(self, allowed: int):
        self.allowed = allowed

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _EVENT)
        self.open = handle.getValueState("open", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        events = [(r["us"], r["id"], r["start"], r["error"]) for r in rows]
        self.waiting.appendList(events)
        self._wake(min(e[0] for e in events))
        return iter([])

    def _wake(self, at: int) -> None:
        """When the watermark has passed this time."""
        self.handle.registerTimer(at // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        events = sorted(tuple(e) for e in self.waiting.get())
        due, later = [e for e in events if e[0] <= passed], [e for e in events if e[0] > passed]
        opened, out = self.open.get(), []
        start = was = opened[0] if opened else None

        def close(end: int, status: str, error: str | None) -> None:
            out.append(Row(run=key[0], start_us=start, end_us=end, status=status, error_message=error))

        for at, _, is_start, error in due:
            if start is not None:
                if at > start + self.allowed:
                    close(start + self.allowed, "failed", TIMED_OUT)
                elif is_start:
                    close(at, "failed", NOT_ENDED)
                else:
                    close(at, "failed" if error else "success", error)
            start = at if is_start else None
        if start is not None and start + self.allowed < passed:
            close(start + self.allowed, "failed", TIMED_OUT)
            start = None
        if later:
            self.waiting.put(later)
            self._wake(later[0][0])
        elif events:
            self.waiting.clear()
        # Each call of the state is a message to the engine: none for what has not changed.
        if start is None and was is not None:
            self.open.clear()
        elif start is not None and start != was:
            self.open.update((start,))
            self._wake(start + self.allowed)
        return iter(out)

    def close(self) -> None:
        pass


def run_logs(events: DataFrame, allowed_seconds: int, late: str = "10 minutes") -> DataFrame:
    """run, start_time, end_time, status and error_message of each run, from a stream of run, id, start (boolean), error and at.

    The session's state store must be RocksDB (``PROVIDER``).  Events without a run or a time are left out.
    """
    rows = events.where("run is not null and at is not null").withWatermark("at", late)
    # The processor reads microseconds; the watermark's column stays beside them.
    rows = rows.select(F.col("run").cast("string").alias("run"), F.unix_micros(F.col("at")).alias("us"), "id", "start", "error", "at")
    logs = rows.groupBy("run").transformWithState(Runs(allowed_seconds * 1_000_000), _LOG, "Append", "EventTime")
    return logs.select("run", F.timestamp_micros("start_us").alias("start_time"), F.timestamp_micros("end_us").alias("end_time"), "status", "error_message")


def distinct_files(files: DataFrame, within: str, time: str = "modified") -> DataFrame:
    """The first file of each hash in a stream; copies that come within the given time are dropped, and state is kept no longer.

    Copies that are dropped here are not recorded as duplicates; those of files the store has are found by the store.
    """
    return files.withWatermark(time, within).dropDuplicatesWithinWatermark(["file_hash"])


def replay(rows: DataFrame, batches: list[DataFrame], folder: str, stream) -> DataFrame:
    """Runs a streaming query over batches as if they came one after the other, and returns what it wrote.

    ``stream`` turns the streaming table into its result.
    """
    spark = rows.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    try:
        for batch in batches:
            # As many files as the batch has parts; the query takes what is new as one micro-batch and goes on from its state.
            batch.write.mode("append").parquet(f"{folder}/in")
            result = stream(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"))
            query = result.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start(f"{folder}/out")
            query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return spark.read.schema(result.schema).parquet(f"{folder}/out")
