"""Validation and coercion of extracted fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .basic import blank_to_null, bound, strip, to_number
from .extract import ITEM_TYPE

NUMBER_CHARS, VENDOR_CHARS, DESCRIPTION_CHARS = 50, 200, 200
#: How far sums may differ.
TOLERANCE = 0.05


def short_text(c: Column, most: int) -> Column:
    """Stripped and cut to ``most`` characters; blank is null."""
    return blank_to_null(F.left(strip(c.cast("string")), F.lit(most)))


def valid_number(c: Column) -> Column:
    return short_text(c, NUMBER_CHARS)


def valid_vendor(c: Column) -> Column:
    return short_text(c, VENDOR_CHARS)


def valid_date(c: Column) -> Column:
    """YYYY-MM-DD of a day that exists, else null."""
    text = strip(c.cast("string"))
    return F.when(text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & text.try_cast("date").isNotNull(), text)


def _number(c: Column, kind: str) -> Column:
    return to_number(c) if kind == "string" else F.when(~F.isnan(c.cast("double")), c.cast("double"))


def valid_amount(c: Column, kind: str = "double") -> Column:
    """A number of at least zero, to two places. ``kind`` is the column's type: string or a number."""
    n = _number(c, kind)
    return F.when(n >= 0, F.round(n, 2))


def valid_currency(c: Column) -> Column:
    """Any three letters, in upper case."""
    text = F.upper(strip(c.cast("string")))
    return F.when(text.rlike(r"\A[A-Z]{3}\z"), text)


def valid_item(item: Column) -> Column:
    """Quantities under zero, and prices under zero once rounded, are null; quantities keep their places."""

    def price(c: Column) -> Column:
        return F.when(F.round(c, 2) >= 0, F.round(c, 2))

    quantity = F.when(item["quantity"] >= 0, item["quantity"])
    return F.struct(
        short_text(item["description"], DESCRIPTION_CHARS).alias("description"),
        quantity.alias("quantity"),
        price(item["unit_price"]).alias("unit_price"),
        price(item["line_total"]).alias("line_total"),
    )


def valid_items(items: Column) -> Column:
    """Items without a description are dropped."""
    return F.filter(F.transform(F.coalesce(items, F.array().cast(f"array<{ITEM_TYPE}>")), valid_item), lambda x: x["description"].isNotNull())


def document_status(confidence: Column, failure_reason: Column) -> Column:
    return F.when(failure_reason.isNotNull(), "failed").when(confidence == "high", "success").otherwise("needs_review")


def item_total(quantity: Column, unit_price: Column, line_total: Column) -> Column:
    """The stated total, else quantity times price to two places."""
    return F.coalesce(line_total, F.round(quantity * unit_price, 2))


def items_sum(items: Column) -> Column:
    """The sum of line totals; a missing one counts as zero."""
    return F.aggregate(items, F.lit(0.0), lambda a, x: a + F.coalesce(x["line_total"], F.lit(0.0)))


def subtotal_matches(subtotal: Column, items: Column) -> Column:
    """Null where there is no subtotal or no item."""
    return F.when(subtotal.isNotNull() & (F.size(items) > 0), F.abs(subtotal - items_sum(items)) <= TOLERANCE)


def total_matches(subtotal: Column, tax: Column, total: Column) -> Column:
    return F.when(subtotal.isNotNull() & tax.isNotNull(), F.abs(subtotal + tax - total) <= TOLERANCE)


def broken_rules(number: Column, date: Column, vendor: Column, total: Column, file_name: Column, file_hash: Column) -> Column:
    """Names of the required fields that are missing or wrong; an empty array is a valid record."""
    checks = {
        "invoice_number": F.length(number) >= 1,
        "invoice_date": date.try_cast("date").isNotNull(),
        "vendor_name": F.length(vendor) >= 1,
        "total_amount": total > 0,
        "file_name": file_name.isNotNull(),
        "file_hash": file_hash.isNotNull(),
    }
    return F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items())))


def model_record(number: Column, date: Column, vendor: Column, total: Column, file_name: Column, file_hash: Column, currency: Column | None = None, line_items: Column | None = None) -> Column:
    """A struct is_valid, error, status and model: a valid record waits for review, as does a broken one with its error.

    The model is the record with its types, a missing currency as USD and missing line totals filled in; null if it is broken.
    """
    broken = broken_rules(number, date, vendor, total, file_name, file_hash)
    currency = F.lit(None).cast("string") if currency is None else currency
    items = F.array().cast(f"array<{ITEM_TYPE}>") if line_items is None else F.coalesce(line_items, F.array().cast(f"array<{ITEM_TYPE}>"))
    filled = F.transform(
        items,
        lambda x: F.struct(x["description"].alias("description"), x["quantity"].alias("quantity"), x["unit_price"].alias("unit_price"), item_total(x["quantity"], x["unit_price"], x["line_total"]).alias("line_total")),
    )
    model = F.struct(
        number.alias("invoice_number"),
        date.try_cast("date").alias("invoice_date"),
        vendor.alias("vendor_name"),
        F.coalesce(currency, F.lit("USD")).alias("currency"),
        total.cast("double").alias("total_amount"),
        filled.alias("line_items"),
        file_name.alias("file_name"),
        file_hash.alias("file_hash"),
        F.lit("needs_review").alias("status"),
    )

    def record(missing: Column) -> Column:
        ok = F.size(missing) == 0
        return F.struct(ok.alias("is_valid"), blank_to_null(F.array_join(missing, ", ")).alias("error"), F.lit("needs_review").alias("status"), F.when(ok, model).alias("model"))

    return bound(broken, record)
