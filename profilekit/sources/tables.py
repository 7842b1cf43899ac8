"""Table readers.

Readers return lazy DataFrames: projections and filters written afterwards
reach the parquet scan (column pruning, pushed filters, partition pruning).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilekit.functions.columns import day_string, to_date

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One of the driver's parquet tables under ``base``."""
    return spark.read.parquet(table_path(base, name))


def table_path(base: str, name: str) -> str:
    """Path of a table: one parquet file or a folder of files."""
    return f"{base.rstrip('/')}/{name}.parquet"


def stream_path(base: str, name: str) -> str:
    """The same path as a pattern that matches it alone.

    A file stream takes a plain path for a folder; as a pattern it may be one
    file or a folder of files.
    """
    path = table_path(base, name)
    return f"{path[:-1]}[{path[-1]}]"


def read_log(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A day-partitioned log dataset (``etl_dt=yyyy-MM-dd`` folders).

    Filters on ``etl_dt`` prune folders before any file is opened. Without a
    schema Spark infers the day partition as a date (comparisons with
    ``yyyy-MM-dd`` text still prune); a schema keeps it text.
    """
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def event_log(spark: SparkSession, base: str) -> DataFrame:
    """The driver's ``events`` table seen as an ad log (see ``as_event_log``)."""
    return as_event_log(table(spark, base, "events"))


def as_event_log(ev: DataFrame) -> DataFrame:
    """``events`` rows as log columns.

    ``userid`` = user_id, ``mediadata`` = props (JSON payload), ``channel`` =
    event_type, ``etl_dt`` = day of ``ts`` as text, ``ts`` kept for pushable day filters.
    """
    return ev.select(
        F.col("user_id").alias("userid"),
        F.col("props").alias("mediadata"),
        F.col("event_type").alias("channel"),
        F.col("value"),
        F.col("ts"),
        day_string("ts").alias("etl_dt"),
    )


def ntz_literal(value: _dt.datetime):
    """A ``timestamp_ntz`` literal from wall-clock time (no time zone involved)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def ntz_range(ts, lo: _dt.datetime, hi: _dt.datetime):
    """``lo <= ts < hi`` on a ``timestamp_ntz`` column; folds to literals, so it is pushed down."""
    return (ts >= ntz_literal(lo)) & (ts < ntz_literal(hi))


def in_days(df: DataFrame, first: str | _dt.date | None, last: str | _dt.date | None,
            ts_col: str | None = "ts", day_col: str = "etl_dt") -> DataFrame:
    """Rows whose day lies in ``[first, last]`` (both ends included; an end that is None is open).

    With a timestamp column the filter is written as a half-open timestamp
    range so it is pushed to the parquet scan; a ``between`` on the day column
    is added when that column exists (partition pruning when it is the
    partition column).
    """
    has_ts = bool(ts_col) and ts_col in df.columns
    # both when both exist: the day column may be a partition column (folder
    # pruning) and the timestamp range is pushed to the row groups
    has_day = day_col in df.columns or not has_ts
    if first is not None:
        day = to_date(first)
        if has_ts:
            df = df.filter(F.col(ts_col) >= ntz_literal(_dt.datetime.combine(day, _dt.time())))
        if has_day:
            df = df.filter(F.col(day_col) >= day.isoformat())
    if last is not None:
        day = to_date(last)
        if has_ts:
            after = _dt.datetime.combine(day + _dt.timedelta(days=1), _dt.time())
            df = df.filter(F.col(ts_col) < ntz_literal(after))
        if has_day:
            df = df.filter(F.col(day_col) <= day.isoformat())
    return df
