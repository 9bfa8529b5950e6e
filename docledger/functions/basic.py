"""Small column helpers with the semantics the extraction rules rely on."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The zone of the clock in the names of text files.
OCR_ZONE = "Asia/Kolkata"
#: (?U): Unicode classes, (?i): any case, (?d): only \n ends a line, (?m): ^ and $ at lines.
FLAGS = "(?Uid)"
LINE_FLAGS = "(?Umd)"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it; the optimiser would copy it to each place."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column) -> Column:
    """Removes all white space at both ends, not only spaces."""
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null without a match or where the group is empty."""
    return bound(F.regexp_extract(text, pattern, group), blank_to_null)


#: Decimal digits beyond ASCII, and what they stand for.
_DIGITS = [(chr(k), str(unicodedata.decimal(chr(k)))) for k in range(128, sys.maxunicode + 1) if unicodedata.category(chr(k)) == "Nd"]


def plain_digits(c: Column) -> Column:
    """Decimal digits of any script as those of ASCII."""
    return F.when(c.rlike(r"(?U)[\d&&[^0-9]]"), F.translate(c, "".join(a for a, _ in _DIGITS), "".join(b for _, b in _DIGITS))).otherwise(c)


def to_number(c: Column) -> Column:
    """A string as a finite double; null for anything else. Digits may be grouped by single underscores."""
    return bound(plain_digits(c), _ascii_number)


def _ascii_number(c: Column) -> Column:
    shape = r"\A\s*[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*\z"
    return F.when(c.rlike(shape), F.regexp_replace(strip(c), "_", "").try_cast("double"))


def money_to_number(c: Column) -> Column:
    """Like ``to_number``, after currency signs, white space and commas are dropped."""
    return to_number(F.regexp_replace(c, r"(?U)[$€£¥\s,]", ""))


def safe_date(year: Column, month: Column, day: Column) -> Column:
    """A date as YYYY-MM-DD, null where the calendar has no such day."""
    return F.try_to_date(F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd").cast("string")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)\z", 1)


def suffix(name: Column) -> Column:
    """The last extension with its dot; empty for none and for names that only start with a dot."""
    return F.regexp_extract(name, r"(?s)\A.*[^/](\.[^./]+)\z", 1)


def stem(name: Column) -> Column:
    ext = suffix(name)
    return F.when(ext == "", name).otherwise(F.left(name, F.length(name) - F.length(ext)))


def relative_path(path: Column, root: str) -> Column:
    """The path below ``root``, or the path itself if it lies elsewhere."""
    prefix = root.rstrip("/") + "/"
    return F.when(path.startswith(prefix), F.substring(path, len(prefix) + 1, 1 << 30)).otherwise(path)


def in_zone(time: Column, zone: str) -> Column:
    """A time as its wall clock in a zone, whatever the session's own zone is."""
    return F.convert_timezone(None, F.lit(zone), time.cast("timestamp_ntz"))


def ocr_text_path(file_name: Column, time: Column) -> Column:
    """Where the text of a file is kept, relative to the store."""
    return F.concat(F.lit("ocr_output/"), stem(file_name), F.lit("_"), F.date_format(in_zone(time, OCR_ZONE), "yyyyMMdd_HHmmss"), F.lit(".txt"))


def clean_file_name(name: Column) -> Column:
    """A name that is safe as a file name on any system."""
    out = F.regexp_replace(name, r"[/\\]", "_")
    out = F.regexp_replace(out, "\\x00", "")
    out = F.regexp_replace(out, r"\.{2,}", ".")
    out = F.regexp_replace(out, r"\A\.+", "")
    out = F.regexp_replace(out, r"(?U)[^\w\-. ]", "_")
    return F.coalesce(blank_to_null(out), F.lit("unnamed_file"))
