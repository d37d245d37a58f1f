"""Text columns to numbers, dates, flags and codes.

Bad input becomes NULL, never an error: the feeds are free text and ANSI mode
would otherwise stop the job on the first bad row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's cast also takes "1d" and "1f"; the feeds' rules do not.
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

# strptime directive -> (regex group, name)
_DIRECTIVES = {
    "%m": (r"(\d{1,2})", "month"),
    "%d": (r"(\d{1,2})", "day"),
    "%Y": (r"(\d{1,4})", "year"),
    "%H": (r"([01]\d|2[0-4]|\d(?!\d))", "hour"),
    "%M": (r"([0-5]\d|\d(?!\d))", "minute"),
}


def plain_numeric(c: Column) -> Column:
    """Decimal text to double; anything else (also ``1,234``) is NULL."""
    return F.when(c.rlike(_NUMBER), F.trim(c).try_cast("double"))


def clean_numeric(c: Column) -> Column:
    """Like :func:`plain_numeric` once thousands commas are gone."""
    return plain_numeric(F.replace(c, F.lit(",")))


def null_tokens(c: Column, tokens=("", "NA", "#N/A")) -> Column:
    """NULL for the given tokens. A blank that is no token stays blank.

    The CSV reader gives NULL for an unquoted blank, so the blank is put back
    unless it counts as missing for this table.
    """
    blank_kept = c if "" in tokens else F.coalesce(c, F.lit(""))
    return F.when(~blank_kept.isin(*tokens), blank_kept)


def lenient_date(c: Column, fmt: str = "%m/%d/%Y") -> Column:
    """Date at the start of a text; what follows the format is ignored.

    Every part of ``fmt`` must be there (a format with a time rejects a bare
    date), parts may have one digit, and impossible dates are NULL.
    """
    pieces, names = [], []
    for token in re.findall(r"%\w|\s+|[^%\s]", fmt):
        if token in _DIRECTIVES:
            group, name = _DIRECTIVES[token]
            pieces.append(group)
            names.append(name)
        else:
            pieces.append(r"\s*" if token.isspace() else re.escape(token))
    # One regex pass: a text that does not match falls to the second branch,
    # whose empty groups leave no date. Zeros keep short years as they are.
    pattern = rf"^\s*{''.join(pieces)}[\s\S]*$|^[\s\S]*$"
    year, month, day = (f"${names.index(n) + 1}" for n in ("year", "month", "day"))
    return F.regexp_replace(c, pattern, f"000{year}-{month}-{day}").try_cast("date")


def _in_century(this_century: Column, pivot: int) -> Column:
    """Dates of two-digit years: those from ``pivot`` on are 19xx."""
    two_digits = F.pmod(F.year(this_century), F.lit(100))
    return F.when(two_digits >= pivot, F.add_months(this_century, -1200)).otherwise(
        this_century
    )


def month_label(c: Column, pivot: int = 69) -> Column:
    """``01-Jan-26`` style label to date, the month's name short or whole; years
    from ``pivot`` on are 19xx."""
    label = F.regexp_extract(c, r"^\s*(\d{1,2}-[A-Za-z]{3,9}-\d{1,2})", 1)
    padded = F.regexp_replace(label, r"-(\d)$", "-0$1")
    named = F.coalesce(*(F.try_to_date(padded, fmt) for fmt in ("d-MMM-yy", "d-MMMM-yy")))
    return _in_century(named, pivot)


def free_date(c: Column, pivot: int = 69) -> Column:
    """Day-month-year with any separators; month as number or name, short or whole.
    Two-digit years from ``pivot`` on are 19xx."""
    pattern = r"^\W*(\d{1,2})\W*([A-Za-z]+|\d{1,2})\W*(\d{4}|\d{2})\W*$"
    parts = [F.regexp_extract(c, pattern, i) for i in (1, 2, 3)]
    text = F.when(c.rlike(pattern), F.concat_ws(" ", *parts))
    months = ("M", "MMM", "MMMM")
    short = F.coalesce(*(F.try_to_date(text, f"d {m} yy") for m in months))
    return F.coalesce(*(F.try_to_date(text, f"d {m} yyyy") for m in months), _in_century(short, pivot))


def region(c: Column) -> Column:
    """Region code: first character of the id."""
    return F.substring(c, 1, 1)


def contains_any_case(c: Column, pattern: str) -> Column:
    """TRUE when the text holds ``pattern`` in any case; NULL text is FALSE."""
    return F.coalesce(c.rlike("(?i)" + pattern), F.lit(False))


def not_matching(c: Column, pattern: str) -> Column:
    """Filter that drops texts holding ``pattern`` and keeps NULL texts."""
    return ~contains_any_case(c, pattern)
