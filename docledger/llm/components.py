"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_open: list[list[str]] = []


@contextmanager
def recording() -> Iterator[list[str]]:
    """Collects the folders that ``saved`` writes meanwhile, for ``delete`` once nothing reads them any more."""
    _open.append([])
    try:
        yield _open[-1]
    finally:
        _open.pop()


def delete(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def saved(frame: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back, which cuts its lineage."""
    from .token_files import shared_folder

    path = shared_folder(frame.sparkSession, name)
    for made in _open:
        made.append(path)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Columns id and component (the smallest id reachable) for every id that an edge (a, b) names.

    Alternates large-star and small-star steps: every node's neighbours are tied to the smallest of them, until no edge
    changes. Each step keeps the components and shrinks the graph towards stars, in a number of rounds that grows with
    the logarithm of the longest path. A step groups by node; of a hub only the smallest neighbour is gathered, so no task
    holds a hub's neighbours together.
    """

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        tied = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()

    with recording() as rounds:
        now = saved(edges.select("a", "b").where("a <> b").distinct(), "edges")
    last = None
    for _ in range(most_rounds):
        before = now
        with recording() as made:
            now = saved(small_star(large_star(before)), "edges")
        n, s = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if (n, s) == last:
            break
        last = (n, s)
        delete(now.sparkSession, rounds)
        rounds = made
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    leaves = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)
