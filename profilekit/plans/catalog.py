"""The registered queries: each builds a DataFrame from the driver's tables.

Every query reads whole tables (no id subsets, no row caps); its work grows
with the tables. ``profilekit.plans.oracle`` holds the DuckDB SQL of each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilekit.functions.columns import code_list, has_text, id_length, json_field, md5_id
from profilekit.operators import evaluate as E
from profilekit.operators.daystates import flag_day_states, flags_of_days, payload_day_states, scores_of_days
from profilekit.operators.extract import extract_payloads, trailing_range
from profilekit.operators.joins import checked_join
from profilekit.operators.matching import (
    coverage_counts,
    id_coverage as _id_coverage,
    mapped_users,
    match_ids,
    match_titles as _match_titles,
)
from profilekit.operators.profile import flag_pivot as _flag_pivot
from profilekit.operators.profile import code_flag_profile, flag_profile
from profilekit.operators.profile import score_profile as _score_profile
from profilekit.operators.tagging import code_tags, dict_tags, last_value_per_key
from profilekit.plans import standins as S
from profilekit.plans import stored
from profilekit.session import shared_path
from profilekit.sources.publish import publish, read_published, with_partition_schema
from profilekit.sources.tables import as_event_log, event_log, in_days, stream_path, table
from profilekit.streaming.daily import closed_day_profiles, refresh_day_profiles
from profilekit.streaming.matching import stream_matched_ids
from profilekit.vocab import INTERESTS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _event_codes_tagged(spark: SparkSession, base: str, keep: list[str]) -> DataFrame:
    return _codes_tagged(event_log(spark, base), keep)


def _codes_tagged(log: DataFrame, keep: list[str]) -> DataFrame:
    return code_tags(log, "mediadata", S.EVENT_JSON_KEY, S.event_code_map(),
                     S.EVENT_CODE_LEN, keep=keep)


@register("json_code")
def json_code(spark: SparkSession, base: str) -> DataFrame:
    """F1 + P5: JSON field of the payload, empty/missing removed."""
    ev = table(spark, base, "events")
    return (ev.select("event_id", F.col("user_id").alias("userid"),
                      json_field("props", S.EVENT_JSON_KEY).alias("code"))
            .filter(has_text("code")))


@register("code_explode")
def code_explode(spark: SparkSession, base: str) -> DataFrame:
    """F2 + F3 + P6: split a list, one row per item, keep items of length 5."""
    part = table(spark, base, "part")
    return (part.select("p_partkey", F.explode(code_list("p_name", " ")).alias("token"))
            .filter(F.length("token") == 5))


def _code_profile(log: DataFrame, by: list[str]) -> DataFrame:
    # code lists folded into bitmasks in place; one bit_or per group
    return code_flag_profile(log, "mediadata", S.EVENT_JSON_KEY, S.event_code_map(), S.EVENT_CODE_LEN,
                             "userid", by=by, source="events", update_dt=S.AS_OF_TEXT)


@register("code_profile")
def code_profile(spark: SparkSession, base: str) -> DataFrame:
    """X2 (flagship): coded-tag flag profile per user over the whole log."""
    return _code_profile(event_log(spark, base), [])


@register("code_profile_day")
def code_profile_day(spark: SparkSession, base: str) -> DataFrame:
    """X3 + D6: the same profile per (user, day) in one pass."""
    return _code_profile(event_log(spark, base), ["etl_dt"])


@register("code_profile_exploded")
def code_profile_exploded(spark: SparkSession, base: str) -> DataFrame:
    """X2 written as the original steps: explode the codes, map each, flag profile (same rows)."""
    tagged = _event_codes_tagged(spark, base, ["userid"])
    return flag_profile(tagged, "userid", source="events", update_dt=S.AS_OF_TEXT)


def _app_dictionary(spark: SparkSession, base: str) -> DataFrame:
    # A repeated app name keeps the tag of its last dictionary line.
    return last_value_per_key(S.app_dictionary(spark, base), "appname", "tag", ["line"])


@register("dict_profile")
def dict_profile(spark: SparkSession, base: str) -> DataFrame:
    """X4 + P9 + J5 + P10: dictionary-tag flag profile (supplier = user, part name = app)."""
    tagged = dict_tags(S.app_log(spark, base), "appname", _app_dictionary(spark, base),
                       keep=["userid"], dict_key="appname")
    return flag_profile(tagged, "userid", source="app", update_dt=S.AS_OF_TEXT)


@register("dict_profile_day")
def dict_profile_day(spark: SparkSession, base: str) -> DataFrame:
    """X5 + D6: the dictionary-tag profile per (user, day) in one pass."""
    tagged = dict_tags(S.app_log(spark, base), "appname", _app_dictionary(spark, base),
                       keep=["userid", "etl_dt"], dict_key="appname")
    return flag_profile(tagged, "userid", by=["etl_dt"], source="app", update_dt=S.AS_OF_TEXT)


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@register("flag_pivot")
def flag_pivot(spark: SparkSession, base: str) -> DataFrame:
    """A1 as pivot + fillna(0): which event types each user has."""
    ev = table(spark, base, "events").select("user_id", "event_type")
    return _flag_pivot(ev, "user_id", "event_type", EVENT_TYPES, user_alias="user_id")


def _device_rule():
    # Id-shape rule of the stand-in: ids of at least two digits.
    return id_length("userid", ">=", 2)


@register("extract_payloads")
def extract_payloads_q(spark: SparkSession, base: str) -> DataFrame:
    """X1 + A3 + P7 + P8 + S4: distinct (user, payload, day) of one channel and day range."""
    return extract_payloads(event_log(spark, base), channel=S.SOCIAL_CHANNEL,
                            id_rule=_device_rule(), first="2024-01-10", last="2024-01-20")


@register("trailing_days")
def trailing_days(spark: SparkSession, base: str) -> DataFrame:
    """D1 + D2: rows and users per day over the days 13..30 before the run date."""
    first, last = trailing_range(S.AS_OF, 13, 31)
    log = in_days(event_log(spark, base), first, last)
    return log.groupBy("etl_dt").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.count_distinct("userid").alias("n_users"))


@register("payload_scores")
def payload_scores(spark: SparkSession, base: str) -> DataFrame:
    """J2: distinct payloads joined with the scored code dictionary."""
    return S.payload_scores(spark, base)


@register("match_titles")
def match_titles(spark: SparkSession, base: str) -> DataFrame:
    """X6 + J6 + J2: first passage (file order) contained in each distinct document text."""
    docs = table(spark, base, "documents")
    return _match_titles(docs, S.passage_dictionary(spark, base), text_col="text")


@register("match_titles_short")
def match_titles_short(spark: SparkSession, base: str) -> DataFrame:
    """J6 by substring equi join: first name token (file order) in each part name."""
    part = table(spark, base, "part")
    return _match_titles(part, S.token_dictionary(spark, base), text_col="p_name", method="ngram")


@register("score_profile")
def score_profile(spark: SparkSession, base: str) -> DataFrame:
    """X7 + J1 + A2: averaged scores per user over the month's distinct payloads."""
    pairs = extract_payloads(event_log(spark, base), channel=S.VIDEO_CHANNEL, id_rule=_device_rule(),
                             first="2024-01-01", last="2024-01-31", keep_day=False, distinct=False)
    return _score_profile(pairs, S.payload_scores(spark, base), "mediadata", "yktag",
                          source="events", update_dt=S.AS_OF_TEXT, distinct=True)


@register("score_profile_day")
def score_profile_day(spark: SparkSession, base: str) -> DataFrame:
    """X8 + D6: averaged scores per (user, day) for the days 2..30 before the run date."""
    first, last = trailing_range(S.AS_OF, 2, 31)
    pairs = extract_payloads(event_log(spark, base), channel=S.VIDEO_CHANNEL, id_rule=_device_rule(),
                             first=first, last=last, distinct=False)
    return _score_profile(pairs, S.payload_scores(spark, base), "mediadata", "yktag", by=["etl_dt"],
                          source="events", update_dt=S.AS_OF_TEXT, distinct=True)


def _customer_ids(spark: SparkSession, base: str) -> DataFrame:
    # Device ids are text.
    return table(spark, base, "customer").select(F.col("c_custkey").cast("string").alias("imei_match"))


def _matched(spark: SparkSession, base: str, width: int) -> DataFrame:
    if width == 1:
        nearest, count = 1, 10
    else:
        nearest, count = 2, 8
    return match_ids(_customer_ids(spark, base), event_log(spark, base), S.AS_OF, nearest, width,
                     count, channel=S.VIDEO_CHANNEL, id_rule=_device_rule())


@register("match_ids_1d")
def match_ids_1d(spark: SparkSession, base: str) -> DataFrame:
    """X9 + D4 + J3: listed ids in the log, one-day windows 1..10 days back."""
    return _matched(spark, base, 1)


@register("match_ids_2d")
def match_ids_2d(spark: SparkSession, base: str) -> DataFrame:
    """X9 + D3 + J3: listed ids in the log, two-day windows 2..17 days back."""
    return _matched(spark, base, 2)


@register("matched_score_profile")
def matched_score_profile(spark: SparkSession, base: str) -> DataFrame:
    """X10 + J4 + P2 + A2: averaged scores of the matched ids over all windows."""
    matched = _matched(spark, base, 1)
    return _score_profile(matched, S.payload_scores(spark, base), "mediadata", "yktag",
                          user_col="imei", source="events", update_dt=S.AS_OF_TEXT)


def _id_mapping(spark: SparkSession, base: str) -> DataFrame:
    o = table(spark, base, "orders")
    return o.select(F.col("o_custkey").cast("string").alias("idfa_imei"),
                    F.when(F.col("o_orderstatus") == "F", F.lit("imei")).otherwise(F.lit("idfa"))
                    .alias("app_flag"))


@register("matched_payloads")
def matched_payloads(spark: SparkSession, base: str) -> DataFrame:
    """J4 + K5: payloads of matched ids that have title scores, published, read back."""
    matched = _matched(spark, base, 1)
    scored = S.payload_scores(spark, base).select("yktag")
    joined = checked_join(matched, scored, "mediadata", "yktag", "inner")
    out = joined.select(F.col("imei").alias("userid"), "mediadata")
    path = shared_path(spark, "matched_payloads")
    publish(out, path, "overwrite")
    return read_published(spark, path, out.schema)


@register("id_coverage")
def id_coverage(spark: SparkSession, base: str) -> DataFrame:
    """X11 + J7 + A5: every listed id with its (distinct) mapping id or NULL."""
    return _id_coverage(_customer_ids(spark, base), _id_mapping(spark, base))


@register("id_coverage_counts")
def id_coverage_counts(spark: SparkSession, base: str) -> DataFrame:
    """A6: how many listed ids, how many mapped, how many distinct."""
    return coverage_counts(id_coverage(spark, base))


@register("id_coverage_md5")
def id_coverage_md5(spark: SparkSession, base: str) -> DataFrame:
    """X11 + J8 + P11 + P12 + F7: md5 profile ids found in the mapping."""
    users = (table(spark, base, "events").select(md5_id("user_id").alias("userid")).distinct())
    return mapped_users(users, _id_mapping(spark, base), hashed=True)


def _labels_pred(spark: SparkSession, base: str) -> DataFrame:
    lab = table(spark, base, "labels")
    return lab.select("doc_id", F.col("quality").alias("y"), (F.lit(1) - F.col("toxic")).alias("pred"))


@register("class_report")
def class_report_q(spark: SparkSession, base: str) -> DataFrame:
    """M3-M6: per-class and averaged precision/recall/F1/support of labels."""
    pred = _labels_pred(spark, base).withColumn("field", F.lit(0))
    return E.class_report(pred, "field", "y", "pred")


@register("segment_report")
def segment_report(spark: SparkSession, base: str) -> DataFrame:
    """M10: the same report per segment (document language)."""
    docs = table(spark, base, "documents").select("doc_id", F.col("lang").alias("segment"))
    pred = _labels_pred(spark, base).join(docs, "doc_id", "inner")
    return E.class_report(pred, "segment", "y", "pred")


@register("run_report")
def run_report(spark: SparkSession, base: str) -> DataFrame:
    """M3-M6 per run of the scored events (one run per left-out feature, plus the full run)."""
    return E.class_report(S.scored_runs(spark, base), "field", "y", "pred")


def _run_metrics(spark: SparkSession, base: str) -> DataFrame:
    found = E.ranking_metrics(S.scored_runs(spark, base), "field", "y", "p")
    return found.select("field", "auc", F.round("logloss", 9).alias("logloss"), "n_pos", "n_neg")


@register("auc_logloss")
def auc_logloss(spark: SparkSession, base: str) -> DataFrame:
    """M7 + M8: exact AUC (distributed prefix sums) and log-loss per run."""
    return _run_metrics(spark, base)


@register("segment_auc")
def segment_auc(spark: SparkSession, base: str) -> DataFrame:
    """M10 with M7 + M8: AUC and log-loss per run and segment (weekday of the event)."""
    found = E.ranking_metrics(S.scored_runs(spark, base), ["field", "segment"], "y", "p")
    return found.select("field", "segment", "auc", F.round("logloss", 9).alias("logloss"), "n_pos", "n_neg")


@register("ablation_compare")
def ablation_compare(spark: SparkSession, base: str) -> DataFrame:
    """M9: AUC and log-loss of each left-out-feature run against the full run."""
    out = E.ablation_compare(_run_metrics(spark, base), "field", S.FULL_RUN, ["auc", "logloss"])
    names = F.array(*[F.lit(f) for f in (*S.FEATURES, "none")])
    return out.withColumn("left_out", F.element_at(names, F.col("field") + 1))


@register("report_reshape")
def report_reshape(spark: SparkSession, base: str) -> DataFrame:
    """M1 + M2 + S11: run reports written as 12-line text blocks, read back to the long form."""
    path = shared_path(spark, "reports")
    blocks = E.format_reports(run_report(spark, base), _run_metrics(spark, base), "field")
    E.write_reports(blocks, "field", path)
    return E.order_long(E.read_reports(spark, path).drop("file"))


@register("vocab_count")
def vocab_count(spark: SparkSession, base: str) -> DataFrame:
    """M11 + S12: distinct feature tokens per namespace from the feature lines."""
    return E.vocabulary(S.feature_lines(spark, base), "line")


@register("month_publish")
def month_publish(spark: SparkSession, base: str) -> DataFrame:
    """X12 + K1 + K5 + P4 + D5: month profile published, read back."""
    path = shared_path(spark, "profile_month")
    profile = code_profile(spark, base)
    publish(profile, path, "overwrite", partition_col="etl_month", partition_value="2024-01")
    schema = with_partition_schema(profile, "etl_month")
    return read_published(spark, path, schema, "etl_month", ["2024-01"])


@register("day_publish")
def day_publish(spark: SparkSession, base: str) -> DataFrame:
    """X12 + K2 + D6: every day partition of the day profile in one write, read back."""
    path = shared_path(spark, "profile_day")
    profile = code_profile_day(spark, base)
    publish(profile, path, "overwrite", partition_col="etl_dt")
    return read_published(spark, path, with_partition_schema(profile, "etl_dt"))


LATE_DAY = "2024-01-17"


def _day_states(spark: SparkSession, build: Callable[[DataFrame], DataFrame], log: DataFrame, name: str) -> DataFrame:
    """Day states as they come about: one day first with half its users, then recomputed alone."""
    path = shared_path(spark, name)
    early = build(log.filter((F.col("etl_dt") != LATE_DAY) | (F.col("userid") % 2 == 0)))
    publish(early, path, partition_col="etl_dt")
    publish(build(log.filter(F.col("etl_dt") == LATE_DAY)), path, partition_col="etl_dt", covered=[LATE_DAY])
    return read_published(spark, path, with_partition_schema(early, "etl_dt"))


@register("month_from_day_states")
def month_from_day_states(spark: SparkSession, base: str) -> DataFrame:
    """X2 + D6: the whole log's flag profile from mergeable day states, one of them recomputed late."""
    states = _day_states(spark, lambda log: flag_day_states(log, "mediadata", S.EVENT_JSON_KEY, S.event_code_map(), S.EVENT_CODE_LEN),
                         event_log(spark, base), "flag-states")
    return flags_of_days(states, source="events", update_dt=S.AS_OF_TEXT)


@register("month_scores_from_day_states")
def month_scores_from_day_states(spark: SparkSession, base: str) -> DataFrame:
    """X7 + A2: the month's averaged scores from day states of distinct payloads, one of them recomputed late."""
    pairs = extract_payloads(event_log(spark, base), channel=S.VIDEO_CHANNEL, id_rule=_device_rule(), distinct=False)
    states = _day_states(spark, payload_day_states, pairs, "payload-states")
    return scores_of_days(states, S.payload_scores(spark, base), "yktag", "2024-01-01", "2024-01-31",
                          source="events", update_dt=S.AS_OF_TEXT)


@register("append_publish")
def append_publish(spark: SparkSession, base: str) -> DataFrame:
    """K3 + K4 + K6: create with the first day, append the other days, read back."""
    path = shared_path(spark, "extract")
    extract = extract_payloads_q(spark, base)
    publish(extract.filter(F.col("etl_dt") == "2024-01-10"), path, "create")
    publish(extract.filter(F.col("etl_dt") != "2024-01-10"), path, "append")
    return read_published(spark, path, extract.schema)


@register("stream_day_profile")
def stream_day_profile(spark: SparkSession, base: str) -> DataFrame:
    """Streaming refresh of the per-day coded-tag profile (new log files -> changed days)."""
    schema = table(spark, base, "events").schema
    sink = shared_path(spark, "stream_profile_day")
    ckpt = shared_path(spark, "stream_checkpoint")

    def build(log: DataFrame) -> DataFrame:
        return _code_profile(as_event_log(log), ["etl_dt"])

    refresh_day_profiles(spark, stream_path(base, "events"), schema, build, sink, ckpt)
    return read_published(spark, sink, with_partition_schema(code_profile_day(spark, base), "etl_dt"))


@register("stream_closed_days")
def stream_closed_days(spark: SparkSession, base: str) -> DataFrame:
    """Watermarked streaming day profile: days appended once closed (lateness one day)."""
    schema = table(spark, base, "events").schema
    sink = shared_path(spark, "stream_closed_days")
    ckpt = shared_path(spark, "stream_closed_checkpoint")
    stream = spark.readStream.schema(schema).parquet(stream_path(base, "events"))
    tagged = _codes_tagged(as_event_log(stream), ["userid", "ts"])
    query = (closed_day_profiles(tagged, source="events", update_dt=S.AS_OF_TEXT)
             .writeStream.format("parquet").outputMode("append")
             .partitionBy("etl_dt").option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start(sink))
    query.awaitTermination()
    return read_published(spark, sink, with_partition_schema(code_profile_day(spark, base), "etl_dt"))


@register("stream_match_ids_1d")
def stream_match_ids_1d(spark: SparkSession, base: str) -> DataFrame:
    """X9 as a stream: log files in, de-duplicated one-day-window matches appended to a parquet sink."""
    schema = table(spark, base, "events").schema
    sink = shared_path(spark, "stream_matched_ids")
    ckpt = shared_path(spark, "stream_matched_checkpoint")
    stream = spark.readStream.schema(schema).parquet(stream_path(base, "events"))
    matched = stream_matched_ids(as_event_log(stream), _customer_ids(spark, base), S.AS_OF, 1, 1, 10,
                                 channel=S.VIDEO_CHANNEL, id_rule=_device_rule())
    query = (matched.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start(sink))
    query.awaitTermination()
    return read_published(spark, sink, _matched(spark, base, 1).schema)


@register("stream_score_profile_day")
def stream_score_profile_day(spark: SparkSession, base: str) -> DataFrame:
    """X8 kept up to date by the streaming refresh: changed days of the log are re-profiled."""
    schema = table(spark, base, "events").schema
    sink = shared_path(spark, "stream_score_day")
    ckpt = shared_path(spark, "stream_score_checkpoint")
    scores = S.payload_scores(spark, base)

    def build(log: DataFrame) -> DataFrame:
        pairs = extract_payloads(as_event_log(log), channel=S.VIDEO_CHANNEL, id_rule=_device_rule(), distinct=False)
        return _score_profile(pairs, scores, "mediadata", "yktag", by=["etl_dt"], source="events",
                              update_dt=S.AS_OF_TEXT, distinct=True)

    refresh_day_profiles(spark, stream_path(base, "events"), schema, build, sink, ckpt)
    return read_published(spark, sink, with_partition_schema(score_profile_day(spark, base), "etl_dt"))


QUERIES.update(stored.QUERIES)
