"""Column expressions used by the operators.

All are built-in Spark functions, so they stay inside whole-stage codegen and
are visible to the optimizer (no Python worker round trip).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_field(payload: ColumnOrName, key: str) -> Column:
    """Top-level field of a JSON object held in a string, as a string; the key is literal (dots are no path).

    Missing key, JSON ``null``, malformed JSON and NULL input all give NULL
    (the job does not fail on a bad row).
    """
    if "'" in key:
        raise ValueError("a JSON key with a quote can't be written as a path")
    return F.get_json_object(_c(payload), f"$['{key}']")


def has_text(c: ColumnOrName) -> Column:
    """``c != ''``; used as a filter it also drops NULL (three-valued logic)."""
    return _c(c) != F.lit("")


def valid_tag(c: ColumnOrName) -> Column:
    """A usable tag: not NULL, not empty and not the text ``null``."""
    c = _c(c)
    return c.isNotNull() & (c != F.lit("")) & (c != F.lit("null"))


def code_list(c: ColumnOrName, sep: str = ",") -> Column:
    """Split a separated list at a literal separator; inner and trailing empty items are kept."""
    return F.split(_c(c), separator(sep))


def separator(sep: str) -> str:
    """The regular expression of a literal separator."""
    return "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def list_item(c: ColumnOrName, index: int, sep: str = ",") -> Column:
    """Item ``index`` (0-based) of a separated list; out of range gives NULL."""
    return F.get(code_list(c, sep), F.lit(index))


def id_length(c: ColumnOrName, op: str, n: int) -> Column:
    """Id-shape rule on the character length of an id: ``op`` is one of = > >= < <=."""
    length = F.length(_c(c).cast("string"))
    ops = {
        "=": length == n,
        "==": length == n,
        ">": length > n,
        ">=": length >= n,
        "<": length < n,
        "<=": length <= n,
    }
    if op not in ops:
        raise ValueError(f"unknown comparison {op!r}")
    return ops[op]


def md5_id(c: ColumnOrName) -> Column:
    """32 lower-case hex characters of the md5 of the id's text."""
    return F.md5(_c(c).cast("string"))


def as_day(c: ColumnOrName) -> Column:
    """Calendar day of a timestamp, date or ``yyyy-MM-dd`` string."""
    return F.to_date(_c(c))


def day_string(c: ColumnOrName) -> Column:
    """Day as ``yyyy-MM-dd`` text, the form used in partition values."""
    return F.date_format(as_day(c), "yyyy-MM-dd")


def to_date(value: str | _dt.date) -> _dt.date:
    """A Python date from a ``yyyy-MM-dd`` string or a date (for literals, not a column)."""
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(value)


def days_ago(as_of: str | _dt.date, i: int) -> Column:
    """The day ``i`` days before ``as_of`` (an explicit run date, not the wall clock)."""
    return F.date_sub(F.lit(to_date(as_of)), i)
