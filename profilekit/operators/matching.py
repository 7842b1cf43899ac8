"""Matching: text -> scored dictionary, id list -> log, id list -> id mapping."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilekit.functions.columns import has_text, json_field, md5_id
from profilekit.operators.bittable import few_unlisted
from profilekit.operators.extract import day_windows, window_range
from profilekit.operators.joins import bounded_broadcast, checked_join, join_side
from profilekit.operators.substring import first_key_match
from profilekit.sources.tables import in_days
from profilekit.vocab import INTERESTS


def match_titles(payloads: DataFrame, dictionary: DataFrame, text_col: str = "mediadata",
                 key_col: str = "iqytag", priority_col: str = "priority",
                 score_cols: Sequence[str] = INTERESTS, method: str = "automaton",
                 require_field: str | None = None) -> DataFrame:
    """X6: ``(yktag, iqytag, scores...)`` for each distinct text and its first dictionary key.

    With ``require_field`` only payloads whose JSON field of that name is
    non-empty take part (the match itself still runs on the whole payload
    text). A key listed twice in the dictionary fans out in the join with the
    scores (both rows are kept).
    """
    if require_field is not None:
        payloads = payloads.filter(has_text(json_field(text_col, require_field)))
    matched = first_key_match(payloads, text_col, dictionary, key_col, priority_col, method)
    scored = dictionary.select(F.col(key_col).alias("_key"), *score_cols)
    return (checked_join(matched, scored, "key", "_key", "inner")
            .select(F.col("text").alias("yktag"), F.col("key").alias("iqytag"), *score_cols))


def match_ids(ids: DataFrame, log: DataFrame, as_of: str | _dt.date, nearest: int, width: int,
              count: int, channel: str | Sequence[str] | None = None, id_rule: Column | None = None,
              list_col: str = "imei_match", id_col: str = "userid", payload_col: str = "mediadata",
              channel_col: str = "channel") -> DataFrame:
    """X9: log rows of listed ids, distinct per day window, all windows in one pass.

    ``count`` windows of ``width`` days, the nearest ending ``nearest`` days
    before ``as_of``. ``distinct`` runs over each whole window (a payload seen on
    both days of a two-day window counts once). The id list is not
    deduplicated: a repeated id repeats its matches. Both key columns are kept.
    Listed ids are kept before ``distinct``, so only their rows are shuffled;
    with a list past the broadcast bound a bit table of its ids drops most
    other rows at the scan, before the exact join.
    """
    first, last = window_range(as_of, nearest, width, count)
    df = in_days(log, first, last)
    if channel is not None:
        chans = [channel] if isinstance(channel, str) else list(channel)
        df = df.filter(F.col(channel_col).isin(chans))
    if id_rule is not None:
        df = df.filter(id_rule)
    windows = day_windows(df, as_of, nearest, width, count)
    rows = windows.select(F.col(id_col).cast("string").alias("imei"), F.col(payload_col).alias("mediadata"),
                          "window_start", "window_end")
    side, small = bounded_broadcast(ids.select(list_col))
    if not small:
        rows = few_unlisted(rows, "imei", side, list_col)
    dist = join_side(rows, side, small, "imei", list_col, "left_semi").distinct()
    return (join_side(dist, side, small, "imei", list_col)
            .select(list_col, "imei", "mediadata", "window_start", "window_end"))


def id_coverage(ids: DataFrame, mapping: DataFrame, flag: str = "imei",
                list_col: str = "imei_match") -> DataFrame:
    """X11 (first half): every listed id with its mapping id, NULL when not mapped.

    The mapping ids of the flag are made distinct first, so each listed id
    keeps exactly its own rows. Mapping ids that are not listed go before that:
    by a semi join with a list within the broadcast bound, else by a bit table
    of the list (the join decides).
    """
    mapped = mapping.filter(F.col("app_flag") == flag).select("idfa_imei")
    side, small = bounded_broadcast(ids.select(F.col(list_col).alias("_listed")))
    if small:
        mapped = mapped.join(side, mapped["idfa_imei"] == side["_listed"], "left_semi")
    else:
        mapped = few_unlisted(mapped, "idfa_imei", side, "_listed")
    mapped = mapped.distinct()
    return checked_join(ids, mapped, list_col, "idfa_imei", "left").select(list_col, "idfa_imei")


def mapped_users(users: DataFrame, mapping: DataFrame, flag: str = "imei", hashed: bool = True,
                 user_col: str = "userid", id_len: int = 32) -> DataFrame:
    """X11 (second half): profile users found in the mapping, by plain or md5 id.

    ``hashed=True`` joins the user id with the md5 of the mapping id (profile
    ids are md5 text); ``hashed=False`` joins the plain ids, as the original
    did. The mapping is not deduplicated. The left join is followed by the
    original length rule (``id_len`` characters) on the joined mapping id,
    which keeps matched rows only; the optimizer plans it as an inner join.
    """
    app = (mapping.filter(F.col("app_flag") == flag)
           .select("idfa_imei", md5_id("idfa_imei").alias("imeimd5")))
    key = "imeimd5" if hashed else "idfa_imei"
    joined = checked_join(users, app, user_col, key, "left")
    kept = joined.filter(F.length(F.col(key)) == id_len)
    return kept.select(user_col, "idfa_imei", "imeimd5")


def coverage_counts(coverage: DataFrame, list_col: str = "imei_match") -> DataFrame:
    """A6: listed ids, mapped ids and their share, as one row."""
    return coverage.agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.count("idfa_imei").alias("n_mapped"),
        F.count_distinct(list_col).alias("n_distinct_ids"),
    )
