"""Mergeable day states: a month's profile from its days' states instead of its log.

A day's state holds what any longer period needs of that day, and no more:

- flags: per user one bit mask; a period's flags are the ``bit_or`` of its days';
- scores: the day's distinct (user, payload), the payload as a 16-byte digest.
  A period's averages run over its distinct payloads, so sums per day would count
  a payload of two days twice; the digests are made distinct across the days, then
  meet the score table's per-payload sums and counts.

States are day partitions. A day that arrives late or is corrected is
recomputed alone; the roll-up reads the states of the period's days and
equals the profile computed from the whole log. A score table that has changed
in between counts as it is at the roll-up.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilekit.operators.profile import code_flag_masks, score_profile, stamp, unpack_flags
from profilekit.sources.tables import in_days
from profilekit.vocab import INTERESTS

Day = str | _dt.date


def payload_digest(payload: str | Column) -> Column:
    """16 bytes that stand for a payload."""
    return F.unhex(F.md5(payload))


def flag_day_states(log: DataFrame, payload_col: str, json_key: str, code_map: Sequence[tuple[str, str]],
                    code_len: int | None, user_col: str = "userid", day_col: str = "etl_dt",
                    domain: Sequence[str] = INTERESTS) -> DataFrame:
    """``(userid, etl_dt, mask)`` of coded payloads, one row per user and day."""
    return code_flag_masks(log, payload_col, json_key, code_map, code_len, user_col, by=[day_col], domain=domain)


def flags_of_days(states: DataFrame, first: Day | None = None, last: Day | None = None, domain: Sequence[str] = INTERESTS,
                  columns: Sequence[str] | None = None, source: str | None = None, update_dt: str | None = None,
                  day_col: str = "etl_dt") -> DataFrame:
    """The flag profile of the days ``first`` to ``last``: one row per user of their states."""
    merged = (in_days(states, first, last, ts_col=None, day_col=day_col)
              .groupBy("userid").agg(F.bit_or("mask").alias("mask")))
    return stamp(merged.select("userid", *unpack_flags(F.col("mask"), list(columns or domain))), source, update_dt)


def payload_day_states(pairs: DataFrame, payload_col: str = "mediadata", user_col: str = "userid",
                       day_col: str = "etl_dt") -> DataFrame:
    """``(userid, payload_id, etl_dt)``: the distinct payloads of each user and day."""
    return pairs.select(F.col(user_col).alias("userid"), payload_digest(payload_col).alias("payload_id"), day_col).distinct()


def scores_of_days(states: DataFrame, scores: DataFrame, score_key: str, first: Day | None = None, last: Day | None = None,
                   score_cols: Sequence[str] = INTERESTS, source: str | None = None, update_dt: str | None = None,
                   day_col: str = "etl_dt") -> DataFrame:
    """The averaged-score profile of the days ``first`` to ``last``, each payload of a user counted once."""
    days = in_days(states, first, last, ts_col=None, day_col=day_col).select("userid", "payload_id")
    keyed = scores.withColumn("_payload_id", payload_digest(score_key))
    return score_profile(days, keyed, "payload_id", "_payload_id", score_cols, source=source, update_dt=update_dt, distinct=True)
