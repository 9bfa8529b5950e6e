"""Pages of an ordered table, however far down, without sorting it for each.

The table is written once in ranges of its order, each in a folder, with the number of rows in it.  In a range rows lie in
order, numbered by their place.  Running sums of the ranges' numbers tell which ranges, and which places in them, hold a page; of one
or two ranges only the pages of the file that have these places are read and sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that a file's statistics tell apart, about: what is read for a page.
RANGE_ROWS = 1 << 14
#: Rows of a range, about. Each is a task, whose counters go to the driver, and a folder.
TASK_ROWS = 1 << 18


def write_pages(rows: DataFrame, folder: str, *order: Column | str, range_rows: int = RANGE_ROWS, task_rows: int = TASK_ROWS) -> None:
    """Writes ``rows`` in ranges. ``order`` must tell all rows apart, or equal rows come in any order."""
    n = max(1, math.ceil(rows.count() / max(range_rows, task_rows)))
    ranged = rows.repartitionByRange(n, *order).withColumn("range", F.spark_partition_id()).sortWithinPartitions("range", *order)
    # The low 33 bits of the id are the row's place in its task.
    placed = ranged.withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    placed.write.partitionBy("range").option("parquet.page.row.count.limit", range_rows).parquet(f"{folder}/rows")
    counted = rows.sparkSession.read.schema(placed.schema).parquet(f"{folder}/rows").groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    counted.write.parquet(f"{folder}/counts")
    rows.limit(0).write.parquet(f"{folder}/columns")


def read_page(spark: SparkSession, folder: str, number: int, *order: Column | str, size: int = 10) -> DataFrame:
    """Page ``number`` (from 1) of ``size`` rows of what ``write_pages`` wrote; ``number`` 0 is the last page. Pages beyond it are empty."""
    counts = spark.read.parquet(f"{folder}/counts")
    if number < 1:
        total = counts.agg(F.sum("n")).head()[0] or 0
        number = max(1, math.ceil(total / size))
    low, high = (number - 1) * size, number * size
    # One narrow row for each range.
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    near = counts.withColumn("before", before).where((F.col("before") < high) & (F.col("before") + F.col("n") > low)).orderBy("range").collect()
    shape = spark.read.parquet(f"{folder}/columns")
    if not near:
        return shape
    rows = spark.read.schema(shape.withColumns({"place": F.lit(0).cast("long"), "range": F.lit(0)}).schema).parquet(f"{folder}/rows")
    held = F.lit(False)
    for r in near:
        held = held | ((F.col("range") == r["range"]) & F.col("place").between(max(low - r["before"], 0), high - r["before"] - 1))
    # Bounds over all ranges, for the statistics of files.
    first, last = min(max(low - r["before"], 0) for r in near), max(min(high - r["before"], r["n"]) for r in near) - 1
    held = held & F.col("range").isin([r["range"] for r in near]) & F.col("place").between(first, last)
    return rows.where(held).orderBy(*order).limit(size).select(shape.columns)
