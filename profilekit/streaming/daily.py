"""Per-day profiles kept up to date with Structured Streaming.

The original jobs re-ran a batch job for each of the last N days. Here a
streaming query watches the log folder; each micro-batch of new files only
tells which days changed. Those days are recomputed from the log (day
filter pushed to the scan) and their partitions of the published profile are
replaced (dynamic partition overwrite); other days are untouched.

Re-running a micro-batch after a failure recomputes the same days from the
same source and writes the same partitions, so the sink is exactly-once in
effect. Files arriving late for an old day simply make that day change again.

``closed_day_profiles`` is the event-time form: a watermarked daily window
whose rows are appended once the day can no longer change.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilekit.functions.columns import day_string
from profilekit.operators.profile import stamp, tag_bit, unpack_flags
from profilekit.sources.publish import publish
from profilekit.sources.tables import ntz_range
from profilekit.vocab import INTERESTS

ProfileBuilder = Callable[[DataFrame], DataFrame]


def _days_filter(df: DataFrame, days: Sequence[str], ts_col: str) -> DataFrame:
    first = min(days)
    last = max(days)
    lo = _dt.datetime.fromisoformat(first)
    hi = _dt.datetime.fromisoformat(last) + _dt.timedelta(days=1)
    ts = F.col(ts_col)
    return df.filter(ntz_range(ts, lo, hi) & day_string(ts).isin(list(days)))


def refresh_day_profiles(spark: SparkSession, log_dir: str, schema: T.StructType, build: ProfileBuilder,
                         sink_path: str, checkpoint_path: str, ts_col: str = "ts",
                         glob: str | None = None, max_files_per_trigger: int | None = None,
                         once: bool = True, partition_col: str | None = None):
    """Start the streaming refresh; with ``once`` it processes what is there and stops.

    ``build`` turns log rows (same schema as the files) into a profile with an
    ``etl_dt`` column; it is called on the log restricted to the changed days.
    With ``partition_col`` (a day-partitioned log) the changed days prune
    folders; otherwise the day filter is a pushed timestamp range.
    """
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    day_of = F.col(partition_col) if partition_col else day_string(ts_col)
    changes = reader.parquet(log_dir).select(day_of.alias("etl_dt"))

    batch_reader = spark.read.schema(schema)
    if glob:
        batch_reader = batch_reader.option("pathGlobFilter", glob)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        # one row per changed day: bounded by the number of days
        days = [r["etl_dt"] for r in batch.select("etl_dt").distinct().collect() if r["etl_dt"]]
        if not days:
            return
        source = batch_reader.parquet(log_dir)
        if partition_col:
            log = source.filter(F.col(partition_col).isin(days))
        else:
            log = _days_filter(source, days, ts_col)
        publish(build(log), sink_path, "overwrite", partition_col="etl_dt")

    writer = changes.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if once:
        query.awaitTermination()
    return query


def closed_day_profiles(tagged: DataFrame, user_col: str = "userid", tag_col: str = "tag",
                        ts_col: str = "ts", domain: Sequence[str] = INTERESTS,
                        lateness: str = "1 day", source: str | None = None,
                        update_dt: str | None = None) -> DataFrame:
    """Streaming flag profile per (user, day), emitted once the day is closed.

    ``tagged`` is a streaming frame of ``(user, tag, ts)``. State is kept per
    (day window, user) and dropped when the watermark passes the day. Days are
    UTC days; a ``timestamp_ntz`` event time is read as UTC wall-clock time
    (watermarks need an instant), so the day of the profile equals the day of
    the wall-clock time whatever the session time zone.
    """
    if isinstance(tagged.schema[ts_col].dataType, T.TimestampNTZType):
        tagged = tagged.withColumn(ts_col, F.timestamp_seconds(F.unix_timestamp(F.col(ts_col))))
    # the state of a (day, user) is one long: the tags seen, one bit each
    agg = (tagged.withWatermark(ts_col, lateness)
           .groupBy(F.window(ts_col, "1 day").alias("w"), F.col(user_col).alias("userid"))
           .agg(F.bit_or(tag_bit(F.col(tag_col), domain)).alias("_mask")))
    day = F.date_add(F.lit(_dt.date(1970, 1, 1)),
                     F.floor(F.unix_seconds(F.col("w.start")) / F.lit(86400)).cast("int"))
    out = agg.select("userid", F.date_format(day, "yyyy-MM-dd").alias("etl_dt"),
                     *unpack_flags(F.col("_mask"), domain))
    return stamp(out, source, update_dt)
