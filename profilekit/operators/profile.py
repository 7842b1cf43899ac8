"""Profiles: one wide row per user (and per day, when asked) over a fixed interest domain.

- ``flag_profile``: 0/1 per interest, ``max(tag == t)``; a user whose rows carry
  only unmapped tags gets an all-zero row.
- ``flag_pivot``: the same result written as ``pivot`` + ``fillna(0)``.
- ``score_profile``: average of each score over the user's (payload, dictionary row)
  pairs, divided by a fixed divisor; NULL scores are ignored, all-NULL gives NULL.

Aggregations are partial + final (map-side combine), so a user holding a third
of all rows is reduced inside each map task before the shuffle. Per-day
profiles group by (user, day) in one pass and are written per day partition,
instead of one job per day.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilekit.functions.columns import code_list, has_text, json_field
from profilekit.operators.joins import bounded_broadcast, join_side
from profilekit.vocab import INTERESTS, SCORE_DIVISOR


def stamp(df: DataFrame, source: str | None, update_dt: str | _dt.date | None) -> DataFrame:
    """Add the ``source`` and ``update_dt`` columns of a published profile."""
    cols = {}
    if source is not None:
        cols["source"] = F.lit(source)
    if update_dt is not None:
        cols["update_dt"] = F.lit(str(update_dt))
    return df.withColumns(cols) if cols else df


def flag_profile(tagged: DataFrame, user_col: str, tag_col: str = "tag",
                 domain: Sequence[str] = INTERESTS, columns: Sequence[str] | None = None,
                 by: Sequence[str] = (), user_alias: str = "userid",
                 source: str | None = None, update_dt: str | None = None) -> DataFrame:
    """One 0/1 column per domain value: 1 if any row of the user (and day) has that tag.

    The same result as ``max(when(tag == t, 1) else 0)`` per column. Each row's
    tag becomes one bit of a long, and a single ``bit_or`` is aggregated per
    group: the partial aggregates that cross the shuffle are one long per
    group instead of one int per domain value; the flags are unpacked after
    the aggregation. Tags outside the domain (and ``''``) give no bit, so such a
    user keeps an all-zero row. Domains over 63 values use the per-column form.
    """
    columns = list(columns or domain)
    if len(domain) > 63:
        return flag_profile_columns(tagged, user_col, tag_col, domain, columns, by, user_alias, source, update_dt)
    packed = (tagged.groupBy(F.col(user_col).alias(user_alias), *by)
              .agg(F.bit_or(tag_bit(F.col(tag_col), domain)).alias("_mask")))
    return stamp(packed.select(user_alias, *by, *unpack_flags(F.col("_mask"), columns)), source, update_dt)


def tag_bit(tag: Column, domain: Sequence[str]) -> Column:
    """``2^i`` for the tag at position ``i`` of the domain, 0 for any other tag (domain of at most 63)."""
    bits = F.create_map(*[x for i, t in enumerate(domain) for x in (F.lit(t), F.lit(1 << i).cast("long"))])
    return F.coalesce(F.try_element_at(bits, tag), F.lit(0).cast("long"))


def unpack_flags(mask: Column, columns: Sequence[str]) -> list[Column]:
    """One 0/1 int column per bit of ``mask``, named by ``columns``."""
    return [(F.shiftright(mask, i) % 2).cast("int").alias(name) for i, name in enumerate(columns)]


def flag_profile_columns(tagged: DataFrame, user_col: str, tag_col: str = "tag",
                         domain: Sequence[str] = INTERESTS, columns: Sequence[str] | None = None,
                         by: Sequence[str] = (), user_alias: str = "userid",
                         source: str | None = None, update_dt: str | None = None) -> DataFrame:
    """The per-column form: ``groupBy(user, *by)`` with one ``max(when(tag == t, 1) else 0)`` per value."""
    columns = list(columns or domain)
    tag = F.col(tag_col)
    exprs = [F.max(F.when(tag == F.lit(t), F.lit(1)).otherwise(F.lit(0))).alias(name)
             for t, name in zip(domain, columns)]
    out = tagged.groupBy(F.col(user_col).alias(user_alias), *by).agg(*exprs)
    return stamp(out, source, update_dt)


def flag_pivot(tagged: DataFrame, user_col: str, tag_col: str = "tag",
               domain: Sequence[str] = INTERESTS, by: Sequence[str] = (),
               user_alias: str = "userid") -> DataFrame:
    """``pivot(tag, domain)`` + ``fillna(0)``: equal to ``flag_profile``."""
    out = (tagged.groupBy(F.col(user_col).alias(user_alias), *by)
           .pivot(tag_col, list(domain))
           .agg(F.max(F.lit(1))))
    return out.fillna(0, subset=list(domain))


# Scores are summed as decimals of so many places; their magnitude stays below 10 ** 16.
SCORE_PLACES = 14


def _exact(score: str) -> Column:
    """A score as a decimal; one that is not finite or too large fails the job rather than spoil a sum."""
    x = F.col(score).cast("double")
    return (F.when(F.abs(x) < 1e16, x.cast(f"decimal(30,{SCORE_PLACES})"))
            .when(x.isNotNull(), F.raise_error(F.concat(F.lit(f"score {score} out of range: "), x.cast("string"))).cast(f"decimal(30,{SCORE_PLACES})")))


def score_profile(pairs: DataFrame, scores: DataFrame, pair_key: str, score_key: str,
                  score_cols: Sequence[str] = INTERESTS, user_col: str = "userid",
                  by: Sequence[str] = (), user_alias: str | None = None,
                  divisor: float = SCORE_DIVISOR, source: str | None = None,
                  update_dt: str | None = None, distinct: bool = False) -> DataFrame:
    """Average score per user over the inner join ``pairs.pair_key == scores.score_key``.

    A repeated dictionary key fans out and so weighs the average, exactly as a
    plain join + ``avg`` would. The dictionary side is first reduced to one row
    per key holding per-score ``sum`` and non-NULL ``count``; the join is then
    many-to-one, and the user average is ``sum(sums) / sum(counts)``, the same
    value as ``avg`` over the fanned-out rows, without materialising the fan-out.
    Sums are exact (decimals of 14 places), so the averages are the same bits
    whatever the order and number of tasks.
    With ``distinct`` the pairs are made distinct here, after the scored keys
    have been kept: only rows that can be averaged are shuffled.
    """
    per_key = scores.groupBy(F.col(score_key).alias("_key")).agg(
        *[F.sum(_exact(c)).alias(f"_s_{c}") for c in score_cols],
        *[F.count(F.col(c).cast("double")).alias(f"_n_{c}") for c in score_cols],
    )
    per_key = per_key.withColumnRenamed("_key", "_skey")
    side, small = bounded_broadcast(per_key)
    rows = pairs.select(user_col, *by, F.col(pair_key).alias("_key"))
    if distinct:
        keys = side.select("_skey")
        rows = join_side(rows, F.broadcast(keys) if small else keys, small, "_key", "_skey", "left_semi").distinct()
    joined = join_side(rows, side, small, "_key", "_skey")
    exprs = [
        F.try_divide(F.try_divide(F.sum(f"_s_{c}").cast("double"), F.sum(f"_n_{c}").cast("double")),
                     F.lit(float(divisor))).alias(c)
        for c in score_cols
    ]
    out = joined.groupBy(F.col(user_col).alias(user_alias or user_col), *by).agg(*exprs)
    return stamp(out, source, update_dt)


def code_flag_profile(df: DataFrame, payload_col: str, json_key: str, code_map: Sequence[tuple[str, str]],
                      code_len: int | None, user_col: str, by: Sequence[str] = (),
                      domain: Sequence[str] = INTERESTS, columns: Sequence[str] | None = None,
                      user_alias: str = "userid", source: str | None = None, update_dt: str | None = None,
                      sep: str = ",") -> DataFrame:
    """Coded-tag flag profile without exploding the code lists.

    The same result as ``code_tags`` followed by ``flag_profile``. Each
    payload's code list is folded into one bitmask inside the row (split,
    keep codes of ``code_len`` characters, code -> bit of its tag through a map
    literal, OR). A payload without a code of the right length gives no row;
    one with valid but unmapped codes gives mask 0 (its user keeps an all-zero
    row). The rows that reach the aggregation are the payload rows, not one per
    code. ``code_map`` is an in-code list of (code, tag); a repeated code keeps
    its last tag.
    """
    masks = code_flag_masks(df, payload_col, json_key, code_map, code_len, user_col, by, domain, user_alias, sep)
    return stamp(masks.select(user_alias, *by, *unpack_flags(F.col("mask"), list(columns or domain))), source, update_dt)


def code_flag_masks(df: DataFrame, payload_col: str, json_key: str, code_map: Sequence[tuple[str, str]],
                    code_len: int | None, user_col: str, by: Sequence[str] = (), domain: Sequence[str] = INTERESTS,
                    user_alias: str = "userid", sep: str = ",") -> DataFrame:
    """``(user, *by, mask)``: the flags of ``code_flag_profile`` still packed, one bit per domain value."""
    positions = {t: i for i, t in enumerate(domain)}
    code_bits = {code: 1 << positions[tag] for code, tag in dict(code_map).items() if tag in positions}
    bit_of = (F.create_map(*[x for c, b in code_bits.items() for x in (F.lit(c), F.lit(b).cast("long"))])
              if code_bits else F.create_map().cast("map<string,bigint>"))
    field = json_field(payload_col, json_key)
    codes = code_list("_codes", sep)
    if code_len is not None:
        codes = F.filter(codes, lambda c: F.length(c) == code_len)
    mask = F.aggregate(F.col("_valid"), F.lit(0).cast("long"),
                       lambda acc, c: acc.bitwiseOR(F.coalesce(F.try_element_at(bit_of, c), F.lit(0).cast("long"))))
    rows = (df.select(F.col(user_col).alias(user_alias), *by, field.alias("_codes"))
            .filter(has_text("_codes") & ~F.startswith(F.col("_codes"), F.lit("[")))
            .select(user_alias, *by, codes.alias("_valid"))
            .filter(F.size("_valid") > 0)
            .select(user_alias, *by, mask.alias("_m")))
    return rows.groupBy(user_alias, *by).agg(F.bit_or("_m").alias("mask"))
