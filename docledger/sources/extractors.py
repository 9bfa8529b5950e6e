"""Extraction by a language model behind an interface, and a deterministic stand-in."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas

ATTEMPTS = 3
INSTRUCTIONS = "Read the invoice text and answer with one JSON object and nothing else. Its keys are invoice_number, invoice_date (YYYY-MM-DD), vendor_name, total_amount, and line_items, a list of objects with description, quantity, unit_price and line_total. Use null for what the text does not say."


def ask(client: Callable[[str, str], str], text: str, attempts: int = ATTEMPTS) -> str:
    """The model's reply as JSON text. A reply that is no JSON object is asked for again; the last error is raised."""
    for k in range(attempts):
        try:
            reply = client(INSTRUCTIONS, text)
            if not isinstance(json.loads(reply), dict):
                raise ValueError("the reply is no object")
            return reply
        except Exception:
            if k + 1 == attempts:
                raise
    raise ValueError("no attempt was allowed")


def extract(texts: DataFrame, client: Callable[[str, str], str], key: str = "file_name") -> DataFrame:
    """key, parsed (null on failure) and error, from key and text."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            replies, errors = [], []
            for text in batch.column(1).to_pylist():
                try:
                    replies.append(ask(client, text or ""))
                    errors.append(None)
                except Exception as e:  # one bad reply fails its own row
                    replies.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.record_batch([batch.column(0), pa.array(replies, pa.string()), pa.array(errors, pa.string())], names=[key, "reply", "error"])

    kind = texts.schema[key].dataType.simpleString()
    rows = texts.select(key, "text").mapInArrow(run, f"`{key}` {kind}, reply string, error string")
    return rows.select(key, F.from_json("reply", schemas.PARSED).alias("parsed"), "error")


def mock(key: Column) -> Column:
    """One of three fixed records by the last two digits of a whole number: 90, 5 and 5 of a hundred."""
    # Shares, names and amounts of the three records.
    draw = F.pmod(key, F.lit(100))
    full, partial = draw < 90, draw < 95

    def item(quantity: float, total: float) -> Column:
        return F.array(F.struct(F.lit("Mock Item").alias("description"), F.lit(quantity).alias("quantity"), F.lit(40.0).alias("unit_price"), F.lit(total).alias("line_total")))

    return F.struct(
        F.concat(F.lit("MOCK-"), (F.pmod(key, F.lit(9000)) + 1000).cast("string")).alias("invoice_number"),
        F.lit("2026-09-30").alias("invoice_date"),
        F.when(partial, "Mock Stationery").otherwise("Mock Fail").alias("vendor_name"),
        F.when(full, F.lit(2000.0)).when(~partial, F.lit(500.0)).alias("total_amount"),
        F.lit("INR").alias("currency"),
        F.when(partial, item(50.0, 2000.0)).otherwise(item(10.0, 400.0)).alias("line_items"),
        F.when(full, "high").otherwise("low").alias("confidence"),
    )
