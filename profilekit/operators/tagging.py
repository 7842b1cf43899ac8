"""Taggers: turn a payload into (user, tag) rows.

- ``code_tags``: JSON field holding a comma list of codes, each code mapped
  through a code dictionary; an unmapped code keeps its row with tag ``''``.
- ``dict_tags``: a key column looked up in a dictionary; rows without a usable
  tag are removed.
- ``last_value_per_key``: dictionary dedupe where a repeated key keeps its last entry.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilekit.functions.columns import code_list, has_text, json_field, valid_tag
from profilekit.operators.joins import checked_join, string_bytes
from profilekit.vocab import INTEREST_LABELS, INTERESTS

CodeMap = Sequence[tuple[str, str]] | DataFrame


def map_literal(pairs: Iterable[tuple[str, str]]) -> Column:
    """An in-code dictionary as a map literal; a repeated key keeps its last value."""
    last = dict(pairs)
    if not last:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for kv in last.items() for x in kv])


def explode_codes(df: DataFrame, payload_col: str, json_key: str,
                  code_len: int | None, keep: Sequence[str], sep: str = ",") -> DataFrame:
    """JSON field -> non-empty -> split -> explode -> length rule, as ``code`` rows.

    A JSON list value (``[...]``) is not a comma string and is dropped.
    """
    field = json_field(payload_col, json_key)
    codes = (
        df.select(*keep, field.alias("_codes"))
        .filter(has_text("_codes") & ~F.startswith(F.col("_codes"), F.lit("[")))
        .select(*keep, F.explode(code_list("_codes", sep)).alias("code"))
    )
    if code_len is not None:
        codes = codes.filter(F.length("code") == code_len)
    return codes


def code_tags(df: DataFrame, payload_col: str, json_key: str, code_map: CodeMap,
              code_len: int | None, keep: Sequence[str], sep: str = ",") -> DataFrame:
    """``keep`` columns + ``code`` + ``tag``; tag is ``''`` for an unmapped code.

    An in-code dictionary becomes a map literal looked up inside the projection
    (no join, no exchange). A dictionary given as a DataFrame ``(code, tag)``
    is joined: broadcast if its size check passes, else a hot-key-salted shuffle join.
    """
    codes = explode_codes(df, payload_col, json_key, code_len, keep, sep)
    if isinstance(code_map, DataFrame):
        side = code_map.select(F.col("code").alias("_code"), "tag")
        joined = checked_join(codes, side, "code", "_code", "left",
                              byte_measure=string_bytes("_code", "tag"))
        return joined.select(*keep, "code", F.coalesce(F.col("tag"), F.lit("")).alias("tag"))
    lookup = map_literal(code_map)
    return codes.withColumn("tag", F.coalesce(F.try_element_at(lookup, F.col("code")), F.lit("")))


def dict_tags(df: DataFrame, key_col: str, dictionary: DataFrame,
              keep: Sequence[str], dict_key: str = "key", dict_tag: str = "tag") -> DataFrame:
    """``keep`` columns + ``tag`` for rows whose key is in the dictionary and whose tag is usable.

    The membership test and the lookup are one inner join; the dictionary is
    broadcast when its size is checked small, otherwise shuffled with hot app
    names salted.
    """
    d = dictionary.select(F.col(dict_key).alias("_dkey"), F.col(dict_tag).alias("tag"))
    joined = checked_join(df.select(*keep, F.col(key_col).alias("_key")), d, "_key", "_dkey", "inner",
                          byte_measure=string_bytes("_dkey", "tag"))
    return joined.filter(valid_tag("tag")).select(*keep, "tag")


def last_value_per_key(dictionary: DataFrame, key: str, value: str,
                       order: Sequence[str]) -> DataFrame:
    """One row per key holding the value of its last entry by ``order``."""
    order_struct = F.struct(*[F.col(c) for c in order])
    return (dictionary.groupBy(key)
            .agg(F.max_by(F.col(value), order_struct).alias(value)))


def english_tags(tagged: DataFrame, tag_col: str = "tag") -> DataFrame:
    """Tags given as the original interest labels become the English interest names.

    Other tag values are kept as they are, so dictionaries in either language
    feed the same 21 profile columns.
    """
    lookup = map_literal(zip(INTEREST_LABELS, INTERESTS))
    return tagged.withColumn(tag_col, F.coalesce(F.try_element_at(lookup, F.col(tag_col)), F.col(tag_col)))
