"""Invoice fields from text, as native column expressions: every field is one expression over the text column.

Patterns run as Java regular expressions with Unicode classes and \\n as the only line end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .basic import FLAGS, LINE_FLAGS, bound, first_match, money_to_number, safe_date, strip, to_number

# What introduces a number, a date, a vendor and a total, and how rows of items look.
NUMBERS = (
    r"(?:invoice|inv)[\s.]*(?:no\.?|number|#|:)[\s.#:]*([A-Z0-9][\w\-/]{1,30})",
    r"(?:reference|ref)[\s.]*(?:no\.?|number|#|:)[\s.#:]*([A-Z0-9][\w\-/]{1,30})",
    r"(?:bill)[\s.]*(?:no\.?|number|#|:)[\s.#:]*([A-Z0-9][\w\-/]{1,30})",
)
DATE_ANCHOR = r"(?:invoice\s+date|date|dated|billing\s+date|bill\s+date)[\s:]*(\d{1,4}[\s/\-][A-Za-z0-9]{1,12}[\s/\-,]*\d{2,4})"
DATE_SHAPES = (
    r"(\d{4}[-/]\d{1,2}[-/]\d{1,2})",
    r"(\d{1,2}[-/]\d{1,2}[-/]\d{4})",
    r"(\d{1,2}\s+[A-Za-z]+\s+\d{4})",
    r"([A-Za-z]+\s+\d{1,2},?\s+\d{4})",
)
DATE_HEAD = 500
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
VENDOR_ANCHOR = r"\b(?:from|vendor|supplier|sold\s+by|bill\s+from|company)[\s:]+(.+)"
VENDOR_SKIP = r"\A(invoice|page|date|bill|ref)\b"
VENDOR_DATE = r"\A\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}\n?\z"
TOTAL = r"(?:grand\s+total|total\s+due|amount\s+due|balance\s+due|total\s+amount|net\s+total|\btotal\b)[\s:]*(?:([A-Z]{3})\s*)?([$€£¥]?)\s*([\d,]+\.?\d*)"
SYMBOLS = {"$": "USD", "€": "EUR", "£": "GBP", "¥": "JPY"}
ISO_CODES = ("USD", "EUR", "GBP", "CAD", "AUD", "JPY", "INR", "CHF", "CNY")
NEAR = 20
ROW_QTY_FIRST = r"^\s*(\d+(?:\.\d+)?)\s+(.{3,60}?)\s+\$?([\d,]+\.\d{2})\s+\$?([\d,]+\.\d{2})\s*$"
ROW_DESC_FIRST = r"^\s*(.{3,60}?)\s+(\d+(?:\.\d+)?)\s+\$?([\d,]+\.\d{2})\s+\$?([\d,]+\.\d{2})\s*$"
ROW_TWO = r"^\s*(.{3,60}?)\s+\$?([\d,]+\.\d{2})\s*$"
#: What every row ends in.
ROW_END = r"\.\d{2}\s*$"
ROW_SKIP = r"(?i)(?:total|subtotal|tax|shipping|discount|balance)"

ITEM_TYPE = "struct<description:string,quantity:double,unit_price:double,line_total:double>"
#: Line ends as a text's own lines are counted.
_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def invoice_number(text: Column) -> Column:
    """The first kind of label that has a number wins: invoice, then reference, then bill."""
    return F.coalesce(*(first_match(text, FLAGS + pattern) for pattern in NUMBERS))


def _month_number(name: Column) -> Column:
    """1 to 12 for full names and their first three letters."""
    low = F.lower(name)
    return F.coalesce(*(F.when(low.isin(m, m[:3]), F.lit(str(k))) for k, m in enumerate(MONTHS, 1)))


def parse_date(raw: Column) -> Column:
    """YYYY-MM-DD from a stripped string of one of four shapes; day first if the first number cannot be a month."""

    def part(shape: str, group: int) -> Column:
        return first_match(raw, shape, group)

    year_first = r"\A(\d{4})[-/](\d{1,2})[-/](\d{1,2})\n?\z"
    year_last = r"\A(\d{1,2})[-/](\d{1,2})[-/](\d{4})\n?\z"
    day_name = r"(?U)\A(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})\n?\z"
    name_day = r"(?U)\A([A-Za-z]+)\s+(\d{1,2}),?\s+(\d{4})\n?\z"
    a, b, y = (part(year_last, k) for k in (1, 2, 3))
    return (
        F.when(raw.rlike(year_first), safe_date(*(part(year_first, k) for k in (1, 2, 3))))
        .when(raw.rlike(year_last), F.when(a.cast("int") > 12, safe_date(y, b, a)).otherwise(safe_date(y, a, b)))
        .when(raw.rlike(day_name), safe_date(part(day_name, 3), _month_number(part(day_name, 2)), part(day_name, 1)))
        .when(raw.rlike(name_day), safe_date(part(name_day, 3), _month_number(part(name_day, 1)), part(name_day, 2)))
    )


def invoice_date(text: Column) -> Column:
    """The first labelled date if it parses, else the first of each bare shape near the top.

    The candidates are cut out of the text once, into an array; everything after works on these short strings.
    """
    head = F.left(text, F.lit(DATE_HEAD))
    found = F.array(first_match(text, FLAGS + DATE_ANCHOR), *(first_match(head, "(?Ud)" + shape) for shape in DATE_SHAPES))
    short = F.transform(F.array_compact(found), lambda x: F.regexp_replace(strip(x), r"\.+\z", ""))
    return F.get(F.array_compact(F.transform(short, parse_date)), F.lit(0))


def vendor_name(text: Column) -> Column:
    """What follows a vendor label on its line, else the first line that is not a heading or a date."""
    labelled = F.regexp_replace(strip(first_match(text, FLAGS + VENDOR_ANCHOR)), r"[:;,.]+\z", "")
    lines = F.transform(F.split(text, _LINE_END), strip)
    fit = F.filter(lines, lambda x: (F.length(x) >= 3) & ~x.rlike(FLAGS + VENDOR_SKIP) & ~x.rlike(VENDOR_DATE))
    return F.coalesce(bound(labelled, lambda x: F.when(F.length(x) >= 2, x)), F.get(fit, F.lit(0)))


def last_total(text: Column) -> Column:
    """A struct of the last total's ISO code, sign and amount as written, and of the text close to it.

    All matches are marked in one replacement; what follows the last mark is the last match.
    """
    start, sep, end = "\x01", "\x03", "\x02"
    clean = F.translate(text, start + end + sep, "")

    def last(marked: Column) -> Column:
        return bound(F.substring_index(marked, start, -1), lambda tail: F.when(F.contains(marked, F.lit(start)), found(marked, tail)))

    def found(marked: Column, tail: Column) -> Column:
        before = F.left(marked, F.length(marked) - F.length(tail) - 1)
        # Marks of earlier matches take room in the text before; what is close is cut after they are gone.
        before = F.right(F.regexp_replace(before, f"{sep}[^{end}]*{end}|{start}", ""), F.lit(NEAR))
        after = F.left(F.regexp_replace(tail, f"(?s)\\A[^{end}]*{end}", ""), F.lit(NEAR))

        def fields(x: Column) -> Column:
            near = F.concat(before, F.get(x, F.lit(0)), after)
            return F.struct(F.get(x, F.lit(1)).alias("iso"), F.get(x, F.lit(2)).alias("sign"), F.get(x, F.lit(3)).alias("amount"), near.alias("near"))

        return bound(F.split(F.substring_index(tail, end, 1), sep), fields)

    return bound(F.regexp_replace(clean, FLAGS + TOTAL, f"{start}$0{sep}$1{sep}$2{sep}$3{end}"), last)


def total_amount(total: Column) -> Column:
    return to_number(F.regexp_replace(total["amount"], ",", ""))


def total_currency(total: Column) -> Column:
    """The sign's currency, else the code before the amount, else the first code nearby, else USD; null without an amount."""
    sign = F.coalesce(*(F.when(total["sign"] == s, F.lit(c)) for s, c in SYMBOLS.items()))
    iso, near = F.upper(total["iso"]), first_match(total["near"], r"(?U)\b([A-Z]{3})\b")
    found = F.coalesce(sign, F.when(iso.isin(*ISO_CODES), iso), F.when(near.isin(*ISO_CODES), near), F.lit("USD"))
    return F.when(total_amount(total).isNotNull(), found)


def _groups(text: Column, pattern: str, n: int) -> Column:
    """The groups of all matches. A text is gone through once; groups come out of each match, where the pattern matches as it did."""
    whole = F.when(text.rlike(LINE_FLAGS + ROW_END), F.regexp_extract_all(text, F.lit(LINE_FLAGS + pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return F.transform(whole, lambda m: F.struct(*(F.regexp_extract(m, LINE_FLAGS + pattern, k).alias(f"g{k}") for k in range(1, n + 1))))


def _item(description: Column, quantity: Column, unit_price: Column, line_total: Column) -> Column:
    return F.struct(strip(description).alias("description"), quantity.alias("quantity"), unit_price.alias("unit_price"), line_total.alias("line_total"))


def _four(match: Column) -> Column:
    """A row of four columns: a number in front is the quantity, else the second column is."""
    number_first = to_number(F.regexp_replace(match["g1"], ",", "")).isNotNull()
    description = F.when(number_first, match["g2"]).otherwise(match["g1"])
    quantity = F.when(number_first, match["g1"]).otherwise(match["g2"])
    return _item(description, money_to_number(quantity), money_to_number(match["g3"]), money_to_number(match["g4"]))


def items_qty_first(text: Column) -> Column:
    return F.transform(_groups(text, ROW_QTY_FIRST, 4), _four)


def items_desc_first(text: Column) -> Column:
    return F.transform(_groups(text, ROW_DESC_FIRST, 4), _four)


def items_two_columns(text: Column) -> Column:
    none = F.lit(None).cast("double")
    rows = F.filter(_groups(text, ROW_TWO, 2), lambda m: ~m["g1"].rlike(ROW_SKIP))
    return F.transform(rows, lambda m: _item(m["g1"], none, none, money_to_number(m["g2"])))


def line_items(text: Column) -> Column:
    """The rows of the first layout that has any."""
    layouts = [items_qty_first(text), items_desc_first(text), items_two_columns(text)]
    empty = F.array().cast(f"array<{ITEM_TYPE}>")
    return F.coalesce(*(bound(x, lambda rows: F.when(F.size(rows) > 0, rows)) for x in layouts), empty)


def confidence(*fields: Column) -> Column:
    """high with three of the key fields or more, medium with two, else low."""
    n = reduce(lambda a, b: a + b, (f.isNotNull().cast("int") for f in fields))
    return F.when(n >= 3, "high").when(n == 2, "medium").otherwise("low")


def join_pages(pages: Column) -> Column:
    """Pages under numbered headings, a blank line between them."""
    return F.array_join(F.transform(pages, lambda p, i: F.concat(F.lit("--- Page "), (i + 1).cast("string"), F.lit(" ---\n"), p)), "\n\n")
