"""The report over a time window, and the audits."""

from __future__ import annotations

import html
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOP = 20


def in_window(column: str, since: Column, until: Column) -> Column:
    """Both ends belong to the window."""
    return F.col(column).between(since, until)


def invoices(documents: DataFrame, items: DataFrame, since: Column, until: Column) -> DataFrame:
    """Documents of the window with the sum of their items (null without items), newest first."""
    sums = items.groupBy("document_id").agg(F.sum("line_total").alias("items_total"))
    return documents.where(in_window("processed_at", since, until)).join(sums, "document_id", "left").orderBy(F.desc_nulls_last("processed_at"), "document_id")


def window_items(documents: DataFrame, items: DataFrame, since: Column, until: Column) -> DataFrame:
    """Items of the window's documents."""
    return items.join(documents.where(in_window("processed_at", since, until)).select("document_id"), "document_id", "left_semi")


def status_counts(documents: DataFrame) -> DataFrame:
    return documents.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def counters(documents: DataFrame, duplicates: DataFrame) -> DataFrame:
    """The five counters and whether they add up, in one row."""
    states = {s: F.count_if(F.col("status") == s).alias(s) for s in ("success", "needs_review", "failed")}
    left = documents.agg(F.count(F.lit(1)).alias("n"), *states.values())
    dups = duplicates.agg(F.count(F.lit(1)).alias("duplicates"))
    rows = left.withColumn("duplicates", dups.scalar())
    total = F.col("n") + F.col("duplicates")
    return rows.select(total.alias("total"), "success", "needs_review", "failed", "duplicates", (F.col("success") + F.col("needs_review") + F.col("failed") + F.col("duplicates") == total).alias("adds_up"))


def invoiced_amount(documents: DataFrame) -> DataFrame:
    """The sum over all statuses and currencies; zero without any."""
    return documents.agg(F.coalesce(F.sum("total_amount"), F.lit(0).cast("decimal(20,2)")).alias("total_amount"))


def amount_by_currency(documents: DataFrame) -> DataFrame:
    return documents.groupBy("currency").agg(F.sum("total_amount").alias("total_amount"), F.count(F.lit(1)).alias("n"))


def first_rows(documents: DataFrame, status: str, n: int = TOP) -> DataFrame:
    return documents.where(F.col("status") == status).orderBy(F.desc_nulls_last("processed_at"), "document_id").limit(n)


def missing_reasons(documents: DataFrame) -> DataFrame:
    """How many documents that need one have no reason."""
    bad = F.col("status").isin("failed", "needs_review") & F.col("review_reason").isNull() & F.col("failure_reason").isNull()
    return documents.agg(F.count_if(bad).alias("n"))


def review_reason(confidence: Column, number: Column, date: Column, vendor: Column, total: Column) -> Column:
    """Why a document waits for review: the fields it lacks."""
    lacks = F.array_compact(F.array(*(F.when(c.isNull(), F.lit(n)) for n, c in {"invoice number": number, "invoice date": date, "vendor name": vendor, "total amount": total}.items())))
    text = F.when(F.size(lacks) > 0, F.concat(F.lit("missing "), F.array_join(lacks, ", "))).otherwise(F.concat(F.lit("confidence is "), confidence))
    return F.when(confidence != "high", text)


@dataclass
class Report:
    invoices: DataFrame
    line_items: DataFrame
    logs: DataFrame
    duplicates: DataFrame
    counters: DataFrame


def report(documents: DataFrame, items: DataFrame, logs: DataFrame, duplicates: DataFrame, since: Column, until: Column) -> Report:
    dups = duplicates.where(in_window("skipped_at", since, until)).orderBy(F.desc_nulls_last("skipped_at"), "duplicate_id")
    rows = invoices(documents, items, since, until)
    return Report(rows, window_items(documents, items, since, until), logs.where(in_window("start_time", since, until)), dups, counters(rows, dups))


#: The lists of a page: what is listed, of which table, and the columns that are shown.
LISTS = (
    ("needs_review", "invoices", ("document_id", "file_name", "vendor_name", "total_amount", "currency", "review_reason")),
    ("failed", "invoices", ("document_id", "file_name", "failure_reason")),
    ("duplicates", "duplicates", ("file_name", "original_file", "skipped_at")),
)


def _table(columns: tuple[str, ...], rows: list) -> str:
    """Values are escaped; a null is an empty cell."""

    def cells(tag: str, values) -> str:
        return "<tr>" + "".join(f"<{tag}>{'' if v is None else html.escape(str(v))}</{tag}>" for v in values) + "</tr>"

    return f"<table>{cells('th', columns)}{''.join(cells('td', r) for r in rows)}</table>"


def to_html(r: Report, since: str = "", until: str = "", mock: bool = False) -> str:
    """A page about a window: its bounds, counts and amounts by status and currency, then the first rows of each list.

    Only groups and first rows come to the driver.
    """
    counts = r.counters.head().asDict()
    by_kind = r.invoices.groupBy("status", "currency").agg(F.count(F.lit(1)).alias("documents"), F.sum("total_amount").alias("amount")).orderBy("status", "currency").collect()
    all_amounts = invoiced_amount(r.invoices).head()[0]
    parts = [
        f"<h2>Invoice Processing Report</h2><p>{html.escape(since)} to {html.escape(until)}{', made with the mock extractor' if mock else ''}</p>",
        _table(("total", "success", "needs_review", "failed", "duplicates", "adds_up"), [[counts[c] for c in ("total", "success", "needs_review", "failed", "duplicates", "adds_up")]]),
        _table(("status", "currency", "documents", "amount"), [*by_kind, (None, "all", sum(x["documents"] for x in by_kind), f"{all_amounts:,.2f}")]),
    ]
    for kind, source, columns in LISTS:
        rows = r.duplicates.limit(TOP) if source == "duplicates" else first_rows(r.invoices, kind)
        there = [c for c in columns if c in rows.columns]
        parts.append(f"<h3>{kind}: {counts[kind]}, first {TOP}</h3>" + _table(tuple(there), rows.select(*there).collect()))
    return f"<html><body>{''.join(parts)}</body></html>"
