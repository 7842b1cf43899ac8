"""Extracts from the log: distinct payloads per user and day, and day windows.

The original jobs ran one query per day in a driver loop. Here a day range is
one filter (pushed to the scan) and a set of day windows is one extra column,
so every window is computed in a single pass with a single shuffle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilekit.functions.columns import to_date
from profilekit.sources.tables import in_days


def trailing_range(as_of: str | _dt.date, from_i: int, to_i: int) -> tuple[_dt.date, _dt.date]:
    """Days ``from_i .. to_i - 1`` before ``as_of`` (``to_i`` excluded) as ``(first, last)``."""
    if to_i <= from_i:
        raise ValueError("empty day range")
    d = to_date(as_of)
    return d - _dt.timedelta(days=to_i - 1), d - _dt.timedelta(days=from_i)


def extract_payloads(log: DataFrame, id_col: str = "userid", payload_col: str = "mediadata",
                     channel: str | Sequence[str] | None = None, channel_col: str = "channel",
                     id_rule: Column | None = None, first: str | _dt.date | None = None,
                     last: str | _dt.date | None = None, keep_day: bool = True,
                     day_col: str = "etl_dt", user_alias: str = "userid", distinct: bool = True) -> DataFrame:
    """Distinct ``(user, payload[, day])`` of one channel, id rule and day range (either end may be open).

    ``distinct=False`` leaves repeats in, for a caller that filters further before removing them.
    """
    df = in_days(log, first, last, day_col=day_col) if first is not None or last is not None else log
    if channel is not None:
        chans = [channel] if isinstance(channel, str) else list(channel)
        df = df.filter(F.col(channel_col).isin(chans))
    if id_rule is not None:
        df = df.filter(id_rule)
    cols = [F.col(id_col).alias(user_alias), F.col(payload_col)]
    if keep_day:
        cols.append(F.col(day_col))
    out = df.select(*cols)
    return out.distinct() if distinct else out


def day_windows(df: DataFrame, as_of: str | _dt.date, nearest: int, width: int, count: int,
                day_col: str = "etl_dt") -> DataFrame:
    """Tumbling windows of ``width`` days counted back from ``as_of``.

    Window b (b = 0 .. count-1) covers the days ``nearest + b*width`` to
    ``nearest + b*width + width - 1`` before ``as_of``. Rows outside all windows
    are removed; ``window_start`` / ``window_end`` name the window.
    """
    d = to_date(as_of)
    ago = F.datediff(F.lit(d), F.to_date(F.col(day_col)))
    b = F.floor((ago - F.lit(nearest)) / F.lit(width)).cast("int")
    end = F.date_sub(F.lit(d), (F.lit(nearest) + b * F.lit(width)))
    start = F.date_sub(end, width - 1)
    return (df.filter((ago >= nearest) & (ago < nearest + width * count))
            .withColumn("window_start", F.date_format(start, "yyyy-MM-dd"))
            .withColumn("window_end", F.date_format(end, "yyyy-MM-dd")))


def window_range(as_of: str | _dt.date, nearest: int, width: int, count: int) -> tuple[_dt.date, _dt.date]:
    """First and last day covered by ``day_windows`` (for pushing the filter to the scan)."""
    d = to_date(as_of)
    return d - _dt.timedelta(days=nearest + width * count - 1), d - _dt.timedelta(days=nearest)
