"""Tables and their metadata, and a generator of invoice texts."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir. Only a session on one machine may go without: it gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        base = f"file://{tempfile.mkdtemp(prefix='docledger-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_table(spark: SparkSession, path: str, kind: str = "parquet", **options) -> DataFrame:
    """A table from a folder, or from a database with kind jdbc and its options."""
    reader = spark.read.options(**options)
    return reader.format("jdbc").load() if kind == "jdbc" else reader.format(kind).load(path)


def query(spark: SparkSession, sql: str, args: dict | None = None, **tables: DataFrame) -> DataFrame:
    """SQL with named parameters over the given tables."""
    return spark.sql(sql, args=args or {}, **tables)


def read_dashboard(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True)


def columns_of(frame: DataFrame) -> set[str]:
    return set(frame.columns)


def missing_columns(tables: dict[str, DataFrame]) -> dict[str, set[str]]:
    """Expected columns that a table lacks; a table that is absent lacks all."""
    expected = {n: {c.strip().split()[0] for c in s.replace("(10,2)", "").replace("(18,4)", "").split(",")} for n, s in schemas.TABLES.items()}
    return {n: gap for n, want in expected.items() if (gap := want - (columns_of(tables[n]) if n in tables else set()))}


def key_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """name and n for each key and reference of the tables that are there: how many key values come more than once, how many
    references lead nowhere. One plan for all of them; a null key is a value, a null reference is none."""
    checks = []
    for name, key in schemas.KEYS.items():
        if name in tables:
            twice = tables[name].groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
            checks.append(twice.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")))
    for (name, column), (target, key) in schemas.REFERENCES.items():
        if name in tables and target in tables:
            there = tables[target].select(F.col(key).alias(column))
            lost = tables[name].where(F.col(column).isNotNull()).join(there, column, "left_anti")
            checks.append(lost.agg(F.lit(f"{name}.{column}").alias("name"), F.count(F.lit(1)).alias("n")))
    return reduce(DataFrame.unionByName, checks)


def broken_keys(tables: dict[str, DataFrame]) -> dict[str, int]:
    """The checks that found something."""
    return {r["name"]: r["n"] for r in key_checks(tables).where("n > 0").collect()}


def column_gaps(rows: DataFrame, name: str) -> DataFrame:
    """For each column that the table ``name`` should have: whether rows lack it, and in how many rows it has a value."""
    wanted = [c.strip().split()[0] for c in schemas.TABLES[name].replace("(10,2)", "").replace("(18,4)", "").split(",")]
    counts = rows.agg(*(F.count(f"`{c}`").alias(c) if c in rows.columns else F.lit(0).cast("long").alias(c) for c in wanted))
    listed = F.array(*(F.struct(F.lit(c).alias("column"), F.lit(c not in rows.columns).alias("missing"), F.col(c).alias("n_values")) for c in wanted))
    return counts.select(F.explode(listed).alias("x")).select("x.*")


def sample_invoices(spark: SparkSession, n: int = 500) -> DataFrame:
    """file_name and text of n made-up invoices."""
    k = F.col("id").cast("string")
    text = F.concat_ws("\n", F.concat(F.lit("INVOICE #"), F.lpad(k, 5, "0")), F.lit("Date: 2026-09-30"), F.concat(F.lit("From: Supplier "), F.pmod("id", F.lit(50)).cast("string")), F.lit("Items: Office Supplies"), F.concat(F.lit("Total: $"), F.format_string("%.2f", (F.pmod("id", F.lit(1000)) + 10).cast("double"))))
    return spark.range(n).select(F.concat(F.lit("invoice_"), k, F.lit(".png")).alias("file_name"), text.alias("text"))
