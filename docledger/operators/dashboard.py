"""What the dashboard shows: nested documents, search, pages, key figures, chart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE_SIZE = 10


def nested(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Each document with its items as an array in item order, empty without items."""
    columns = [c for c in items.columns if c != "document_id"]
    lists = items.groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("line_items"))
    empty = F.array().cast(lists.schema["line_items"].dataType)
    return documents.join(lists, "document_id", "left").withColumn("line_items", F.coalesce("line_items", empty))


def as_json(rows: DataFrame) -> DataFrame:
    """One JSON string for each document; numbers with fixed places, dates and times are strings, nulls stay."""
    plain = [F.col(c).cast("string").alias(c) if t.startswith(("decimal", "date", "timestamp")) else F.col(c) for c, t in rows.dtypes if c != "line_items"]
    fields = rows.schema["line_items"].dataType.elementType.fields
    item = F.transform("line_items", lambda x: F.struct(*(x[f.name].cast("string").alias(f.name) if f.dataType.typeName() in ("decimal", "date", "timestamp") else x[f.name].alias(f.name) for f in fields)))
    return rows.select("document_id", F.to_json(F.struct(*plain, item.alias("line_items")), {"ignoreNullFields": "false"}).alias("json"))


def search(rows: DataFrame, term: str, columns: tuple[str, ...] = ("invoice_number", "vendor_name")) -> DataFrame:
    """Rows that hold the term in one of the columns, in any case."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(term.lower())), F.lit(False))
    return rows.where(hit)


def page(rows: DataFrame, number: int, *order, size: int = PAGE_SIZE) -> DataFrame:
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def page_count(rows: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    return rows.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / size)).cast("long").alias("pages"))


def key_figures(rows: DataFrame, done: str = "success") -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.coalesce(F.sum("total_amount"), F.lit(0).cast("decimal(20,2)")).alias("total_amount"),
        F.count_if(F.col("status") == done).alias("n_done"),
    )


def chart(rows: DataFrame) -> DataFrame:
    return rows.select("invoice_number", "total_amount")
