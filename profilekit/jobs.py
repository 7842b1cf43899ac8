"""Batch jobs over stored datasets: read -> tag -> profile -> publish.

One function per job of the original scripts, with every path, day and
parameter explicit (no wall clock, no metastore). Inputs follow FIXTURES.md:

- ad log: parquet partitioned by ``etl_dt`` with ``imei, imeimd5, idfa,
  mediadata, channelid``;
- staging tables: ``userid, mediadata`` (coded payloads) or ``user_id, appname``
  (apps), partitioned by ``etl_dt``;
- dictionaries and id lists: text files (see ``sources.files``).

Profiles are published per month (``etl_month``) or per day (``etl_dt``) with
dynamic partition overwrite, so re-running a job replaces its partitions.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profilekit.functions.columns import id_length, to_date
from profilekit.operators.daystates import flag_day_states, flags_of_days, payload_day_states, scores_of_days
from profilekit.operators.extract import extract_payloads, trailing_range
from profilekit.operators.matching import id_coverage, mapped_users, match_ids, match_titles
from profilekit.operators.profile import code_flag_profile, flag_profile, score_profile
from profilekit.operators.tagging import code_tags, dict_tags, english_tags
from profilekit.sources.files import read_id_list, read_pair_dictionary, read_scored_dictionary
from profilekit.sources.publish import publish, read_published
from profilekit.sources.tables import in_days, read_log
from profilekit.vocab import LABEL_TO_INTEREST, social_code_map

Day = str | _dt.date


def month_days(month: str) -> tuple[_dt.date, _dt.date]:
    """First and last day of a month given as ``yyyy-MM``."""
    first = _dt.date.fromisoformat(f"{month}-01")
    return first, (first + _dt.timedelta(days=31)).replace(day=1) - _dt.timedelta(days=1)


def _days(first: _dt.date, last: _dt.date) -> list[str]:
    return [(first + _dt.timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


def _covered(as_of: Day, from_i: int | None, to_i: int | None) -> list[str] | None:
    """Days a per-day run stands for (None: whatever is in the data)."""
    return None if from_i is None or to_i is None else _days(*trailing_range(as_of, from_i, to_i))


def _window(log: DataFrame, as_of: Day, from_i: int | None, to_i: int | None) -> DataFrame:
    if from_i is None or to_i is None:
        return log
    first, last = trailing_range(as_of, from_i, to_i)
    return in_days(log, first, last, ts_col=None)


def extract_staging(spark: SparkSession, log_path: str, out_path: str, as_of: Day, from_i: int, to_i: int,
                    channel: int = 4, id_col: str = "imeimd5", id_rule: Column | None = None,
                    mode: str = "overwrite") -> DataFrame:
    """Distinct ``(userid, mediadata)`` per day of one channel, days ``from_i..to_i-1`` back."""
    first, last = trailing_range(as_of, from_i, to_i)
    rule = id_rule if id_rule is not None else id_length(id_col, "=", 32)
    ext = extract_payloads(read_log(spark, log_path), id_col=id_col, channel=[channel], channel_col="channelid",
                           id_rule=rule, first=first, last=last)
    publish(ext, out_path, mode, partition_col="etl_dt", covered=_days(first, last))
    return ext


def coded_profile(spark: SparkSession, staging_path: str, out_path: str, as_of: Day,
                  month: str | None = None, from_i: int | None = None, to_i: int | None = None,
                  json_key: str = "usertag", code_map: Sequence[tuple[str, str]] | DataFrame | None = None,
                  code_len: int = 5, source: str = "social", columns: Sequence[str] | None = None) -> DataFrame:
    """Coded-tag flag profile: per month (``month``) or per day (days ``from_i..to_i-1`` back).

    ``columns`` renames the 21 interest columns (``vocab.INTEREST_LABELS`` gives the original names).
    """
    staging = _window(read_log(spark, staging_path), as_of, from_i, to_i)
    per_day = month is None
    keep = ["userid", "etl_dt"] if per_day else ["userid"]
    by = ["etl_dt"] if per_day else []
    code_map = social_code_map() if code_map is None else code_map
    if isinstance(code_map, DataFrame):
        tagged = english_tags(code_tags(staging, "mediadata", json_key, code_map, code_len, keep=keep))
        prof = flag_profile(tagged, "userid", columns=columns, by=by, source=source, update_dt=str(as_of))
    else:
        pairs = [(code, LABEL_TO_INTEREST.get(tag, tag)) for code, tag in code_map]
        prof = code_flag_profile(staging, "mediadata", json_key, pairs, code_len, "userid", by=by,
                                 columns=columns, source=source, update_dt=str(as_of))
    if per_day:
        publish(prof, out_path, partition_col="etl_dt", covered=_covered(as_of, from_i, to_i))
    else:
        publish(prof, out_path, partition_col="etl_month", partition_value=month)
    return prof


def dictionary_profile(spark: SparkSession, staging_path: str, dict_path: str, out_path: str, as_of: Day,
                       month: str | None = None, from_i: int | None = None, to_i: int | None = None,
                       source: str = "app", columns: Sequence[str] | None = None) -> DataFrame:
    """App-dictionary flag profile from ``user_id, appname`` staging rows.

    Dictionary tags may be the original interest labels or the English names.
    """
    staging = _window(read_log(spark, staging_path), as_of, from_i, to_i)
    per_day = month is None
    log = staging.select(F.col("user_id").alias("userid"), "appname", "etl_dt")
    keep = ["userid", "etl_dt"] if per_day else ["userid"]
    d = read_pair_dictionary(spark, dict_path, key="appname", value="tag")
    tagged = english_tags(dict_tags(log, "appname", d, keep=keep, dict_key="appname"))
    prof = flag_profile(tagged, "userid", columns=columns, by=["etl_dt"] if per_day else [], source=source,
                        update_dt=str(as_of))
    if per_day:
        publish(prof, out_path, partition_col="etl_dt", covered=_covered(as_of, from_i, to_i))
    else:
        publish(prof, out_path, partition_col="etl_month", partition_value=month)
    return prof


def title_score_table(spark: SparkSession, log_path: str, dict_path: str, out_path: str, first: Day, last: Day,
                      channel: int = 3, title_key: str = "title", method: str = "automaton") -> DataFrame:
    """``(yktag, iqytag, 21 scores)`` for the distinct payloads of one channel and day range."""
    log = in_days(read_log(spark, log_path), first, last, ts_col=None)
    payloads = log.filter(F.col("channelid") == channel).select("mediadata")
    # repeated payloads are matched once: the match deduplicates its results
    table = match_titles(payloads, read_scored_dictionary(spark, dict_path), require_field=title_key,
                         method=method)
    publish(table, out_path, "overwrite")
    return table


def scored_profile(spark: SparkSession, log_path: str, scores_path: str, out_path: str, as_of: Day,
                   month: str | None = None, first: Day | None = None, last: Day | None = None,
                   from_i: int | None = None, to_i: int | None = None, channel: int = 3,
                   id_col: str = "idfa", id_rule: Column | None = None, source: str = "video") -> DataFrame:
    """Averaged-score profile per month or per day.

    A month's profile covers the days of ``month``, narrowed to ``first`` and
    ``last`` where given; days outside the month never count to it.
    """
    per_day = month is None
    if per_day:
        first, last = trailing_range(as_of, from_i, to_i)
    else:
        start, end = month_days(month)
        first = max(start, to_date(first)) if first is not None else start
        last = min(end, to_date(last)) if last is not None else end
    rule = id_rule if id_rule is not None else id_length(id_col, ">", 10)
    pairs = extract_payloads(read_log(spark, log_path), id_col=id_col, channel=[channel], channel_col="channelid",
                             id_rule=rule, first=first, last=last, keep_day=per_day, distinct=False)
    scores = spark.read.parquet(scores_path)
    prof = score_profile(pairs, scores, "mediadata", "yktag", by=["etl_dt"] if per_day else [],
                         source=source, update_dt=str(as_of), distinct=True)
    if per_day:
        publish(prof, out_path, partition_col="etl_dt", covered=_covered(as_of, from_i, to_i))
    else:
        publish(prof, out_path, partition_col="etl_month", partition_value=month)
    return prof


def coded_day_states(spark: SparkSession, staging_path: str, states_path: str, as_of: Day, from_i: int, to_i: int,
                     json_key: str = "usertag", code_map: Sequence[tuple[str, str]] | None = None, code_len: int = 5) -> None:
    """Packed flags per user and day for the days ``from_i..to_i-1`` back; run for one day, it replaces that day."""
    pairs = [(code, LABEL_TO_INTEREST.get(tag, tag)) for code, tag in (social_code_map() if code_map is None else code_map)]
    staging = _window(read_log(spark, staging_path), as_of, from_i, to_i)
    publish(flag_day_states(staging, "mediadata", json_key, pairs, code_len), states_path, partition_col="etl_dt",
            covered=_covered(as_of, from_i, to_i))


def coded_month_from_days(spark: SparkSession, states_path: str, out_path: str, as_of: Day, month: str,
                          source: str = "social", columns: Sequence[str] | None = None) -> DataFrame:
    """The month's flag profile from its day states: the same rows as ``coded_profile(month=...)`` of those days."""
    prof = flags_of_days(read_published(spark, states_path), *month_days(month), columns=columns, source=source, update_dt=str(as_of))
    publish(prof, out_path, partition_col="etl_month", partition_value=month)
    return prof


def payload_states(spark: SparkSession, log_path: str, states_path: str, as_of: Day, from_i: int, to_i: int,
                   channel: int = 3, id_col: str = "idfa", id_rule: Column | None = None) -> None:
    """Distinct payload digests per user and day for the days ``from_i..to_i-1`` back."""
    first, last = trailing_range(as_of, from_i, to_i)
    rule = id_rule if id_rule is not None else id_length(id_col, ">", 10)
    pairs = extract_payloads(read_log(spark, log_path), id_col=id_col, channel=[channel], channel_col="channelid",
                             id_rule=rule, first=first, last=last, distinct=False)
    publish(payload_day_states(pairs), states_path, partition_col="etl_dt", covered=_days(first, last))


def scored_month_from_days(spark: SparkSession, states_path: str, scores_path: str, out_path: str, as_of: Day, month: str,
                           source: str = "video") -> DataFrame:
    """The month's averaged scores from its day states: the same rows as ``scored_profile(month=...)``."""
    prof = scores_of_days(read_published(spark, states_path), spark.read.parquet(scores_path), "yktag", *month_days(month),
                          source=source, update_dt=str(as_of))
    publish(prof, out_path, partition_col="etl_month", partition_value=month)
    return prof


def match_id_list(spark: SparkSession, ids_path: str, log_path: str, out_path: str, as_of: Day,
                  nearest: int, width: int, count: int, channel: int = 3, id_col: str = "imei",
                  id_rule: Column | None = None, mode: str = "overwrite") -> DataFrame:
    """Listed ids found in the log, distinct per window of ``width`` days, all windows in one pass.

    Published per ``window_end``: a re-run replaces its windows, also those
    that have become empty. ``mode="append"`` adds rows as the original did.
    """
    rule = id_rule if id_rule is not None else id_length(id_col, "=", 15)
    m = match_ids(read_id_list(spark, ids_path), read_log(spark, log_path), as_of, nearest, width, count,
                  channel=[channel], id_rule=rule, id_col=id_col, channel_col="channelid")
    d = to_date(as_of)
    ends = [(d - _dt.timedelta(days=nearest + b * width)).isoformat() for b in range(count)]
    publish(m, out_path, mode, partition_col="window_end", covered=ends)
    return m


def matched_profile(spark: SparkSession, matched_path: str, scores_path: str, out_path: str, as_of: Day,
                    source: str = "video", mode: str = "overwrite") -> DataFrame:
    """Averaged-score profile of the matched ids (``imei``)."""
    matched = spark.read.parquet(matched_path)
    prof = score_profile(matched, spark.read.parquet(scores_path), "mediadata", "yktag", user_col="imei",
                         source=source, update_dt=str(as_of))
    publish(prof, out_path, mode)
    return prof


def mapping_coverage(spark: SparkSession, ids_path: str, mapping_path: str, flag: str = "imei") -> DataFrame:
    """Listed ids with their mapping id (NULL when not mapped)."""
    return id_coverage(read_id_list(spark, ids_path), spark.read.parquet(mapping_path), flag)


def mapped_profile_users(spark: SparkSession, profile_path: str, mapping_path: str, flag: str = "imei",
                         hashed: bool = True) -> DataFrame:
    """Users of a published profile found in the mapping (by md5 or plain id)."""
    users = spark.read.parquet(profile_path).select("userid")
    return mapped_users(users, spark.read.parquet(mapping_path), flag, hashed)
