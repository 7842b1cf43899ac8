"""Id-list matching as a stream: new log files in, matched rows appended out.

The original job appended each day's matches to a table. Here new log files
are read as a stream, rows get their day window (days counted back from the
run date), rows of listed ids are kept (stream-static semi join), their
duplicates of (window, id, payload) are dropped within the watermark, and the
id list is joined as a static side. The sink is a parquet file sink
(exactly-once through its log and the checkpoint).

The watermark delay defaults to the whole range of all windows: no row of a
window can then come too late, in whatever order the files arrive, and the
state holds the distinct matched rows of that range. A shorter ``lateness``
keeps less state and drops rows that come later than it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilekit.operators.extract import day_windows, window_range
from profilekit.sources.tables import in_days


def stream_matched_ids(log_stream: DataFrame, ids: DataFrame, as_of: str | _dt.date, nearest: int,
                       width: int, count: int, channel: str | Sequence[str] | None = None,
                       id_rule: Column | None = None, list_col: str = "imei_match", id_col: str = "userid",
                       payload_col: str = "mediadata", channel_col: str = "channel", ts_col: str = "ts",
                       lateness: str | None = None) -> DataFrame:
    """Streaming ``(imei_match, imei, mediadata, window_start, window_end)``; same rows as ``match_ids``.

    ``log_stream`` is a streaming log with an event-time column ``ts_col`` and a
    day column ``etl_dt``; ``ids`` is a static id list (not deduplicated).
    """
    first, last = window_range(as_of, nearest, width, count)
    df = in_days(log_stream, first, last, ts_col=ts_col)
    if channel is not None:
        chans = [channel] if isinstance(channel, str) else list(channel)
        df = df.filter(F.col(channel_col).isin(chans))
    if id_rule is not None:
        df = df.filter(id_rule)
    if isinstance(df.schema[ts_col].dataType, T.TimestampNTZType):
        # watermarks need an instant: the wall-clock time read as UTC
        df = df.withColumn(ts_col, F.timestamp_seconds(F.unix_timestamp(F.col(ts_col))))
    windows = day_windows(df, as_of, nearest, width, count)
    rows = windows.select(F.col(id_col).cast("string").alias("imei"), F.col(payload_col).alias("mediadata"),
                          "window_start", "window_end", F.col(ts_col))
    listed = ids.select(F.col(list_col).alias("_listed")).distinct()
    rows = rows.join(listed, F.col("imei") == F.col("_listed"), "left_semi")
    deduped = (rows.withWatermark(ts_col, lateness or f"{width * count} days")
               .dropDuplicatesWithinWatermark(["imei", "mediadata", "window_start"]))
    return (deduped.join(ids.select(list_col), deduped["imei"] == F.col(list_col), "inner")
            .select(list_col, "imei", "mediadata", "window_start", "window_end"))
