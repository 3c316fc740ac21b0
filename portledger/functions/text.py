"""Scalar rules on text cells, as Column expressions."""

import sys
import unicodedata

from pyspark.sql import functions as F

# Every character Python regards as white space; SQL TRIM alone only knows the plain blank.
WHITESPACE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())

# Every Unicode decimal digit and its ASCII counterpart, position by position.
_DIGITS = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
_DIGITS_FROM = "".join(_DIGITS)
_DIGITS_TO = "".join(str(unicodedata.digit(c)) for c in _DIGITS)


def as_column(c):
    return F.col(c) if isinstance(c, str) else c


def strip(c):
    """Remove white space of any kind at both ends.

    The plain-blank trim comes first: it is cheap and leaves the character-set trim little to do. Both
    mention their input once, which keeps rules built on rules small when they are merged into a plan.
    """
    return F.btrim(F.trim(as_column(c)), F.lit(WHITESPACE))


def safe_str(c):
    """Stripped text, with null as the empty string."""
    return strip(F.coalesce(as_column(c).cast("string"), F.lit("")))


def lenient_int(c):
    """Whole number in a text cell: missing or empty gives 0, anything unreadable gives null.

    Accepts what a lenient reader accepts: outer white space, a sign, single underscores between
    digits and decimal digits of any script.
    """
    raw = F.coalesce(as_column(c).cast("string"), F.lit(""))
    ascii_text = F.translate(strip(raw), _DIGITS_FROM, _DIGITS_TO)
    plain = F.regexp_replace(ascii_text, "(?<=[0-9])_(?=[0-9])", "")
    return F.when(raw == "", F.lit(0).cast("bigint")).otherwise(plain.try_cast("bigint"))


def historical_date(c, from_date_cell=None):
    """Date text of the historical source: blank and ``-`` become empty, the rest stays as it is."""
    text = safe_str(c)
    kept = F.when(text == "-", "").otherwise(text)
    return _date_cell_first(c, from_date_cell, kept)


def weekly_date(c, from_date_cell=None):
    """Date text of the weekly source: as the historical rule, and eight digits become ISO text.

    The calendar is not checked; ``20261399`` becomes ``2026-13-99``.
    """
    text = safe_str(c)
    iso = F.regexp_replace(text, r"(?U)^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return _date_cell_first(c, from_date_cell, F.when(text == "-", "").otherwise(iso))


def _date_cell_first(c, from_date_cell, rule):
    # A true date cell is held as "YYYY-MM-DD hh:mm:ss" text; its date is the first ten characters.
    if from_date_cell is None:
        return rule
    return F.when(from_date_cell, F.substring(as_column(c), 1, 10)).otherwise(rule)


def date_parts(c):
    """Year, month and day text of a ten-character date text, otherwise three empty texts."""
    text = as_column(c)
    full = F.length(text) == 10
    cut = lambda start, size: F.when(full, F.substring(text, start, size)).otherwise("")
    return {"year": cut(1, 4), "month": cut(6, 2), "day": cut(9, 2)}


def decimal_value(c):
    """Typed sibling of a numeric text column, to nine decimal places; null where the text is no number."""
    return safe_str(c).try_cast("decimal(38,9)")


def date_value(c):
    """Typed sibling of a date text column; null where the text is no calendar date."""
    return F.try_to_date(as_column(c), "yyyy-MM-dd")
