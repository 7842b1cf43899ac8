"""Registered queries whose inputs are stored files: text dictionaries, id lists, reports, day-partitioned logs.

Each writes its input from the driver's tables into the shared folder, in the
layout of the original files, and runs the reader and the job over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilekit import jobs
from profilekit.functions.columns import id_length, json_field
from profilekit.operators import evaluate as E
from profilekit.operators.matching import mapped_users, match_ids, match_titles
from profilekit.operators.profile import code_flag_profile, flag_profile
from profilekit.operators.tagging import dict_tags
from profilekit.plans import standins as S
from profilekit.session import shared_path
from profilekit.sources.files import read_id_list, read_pair_dictionary, read_scored_dictionary
from profilekit.sources.publish import read_published
from profilekit.sources.tables import as_event_log, event_log, in_days, read_log, table
from profilekit.vocab import SCORED_INTERESTS

# Run of the one-class case, and the run some of whose scores are missing.
ONE_CLASS_RUN, GAPPY_RUN = 9, 1


def _text(df: DataFrame, name: str) -> str:
    path = shared_path(df.sparkSession, name)
    df.write.text(path)
    return path


def dict_file_profile(spark: SparkSession, base: str) -> DataFrame:
    """S5 + X4: the dictionary profile with its dictionary read from tab-separated text (last line wins)."""
    lines = S.app_dictionary(spark, base).orderBy("line").select(F.concat_ws("\t", "appname", "tag").alias("value"))
    d = read_pair_dictionary(spark, _text(lines, "app-dictionary"), key="appname", value="tag")
    tagged = dict_tags(S.app_log(spark, base), "appname", d, keep=["userid"], dict_key="appname")
    return flag_profile(tagged, "userid", source="app", update_dt=S.AS_OF_TEXT)


def title_file_match(spark: SparkSession, base: str) -> DataFrame:
    """S7 + S8 + X6 with F1 + P5: JSON payloads with a title, matched by a scored comma dictionary read from text."""
    tokens = S.token_dictionary(spark, base)
    lines = tokens.orderBy("priority").select(F.concat_ws(",", "iqytag", *[F.col(c).cast("string") for c in SCORED_INTERESTS]))
    dictionary = read_scored_dictionary(spark, _text(lines, "title-dictionary"))
    title = F.when(F.col("p_partkey") % 7 == 0, F.lit("")).otherwise(F.col("p_name"))
    payloads = table(spark, base, "part").select(F.to_json(F.struct(title.alias("title"))).alias("mediadata"))
    return match_titles(payloads, dictionary, require_field="title")


def id_file_match(spark: SparkSession, base: str) -> DataFrame:
    """S9 + X9: listed ids read from text, one per line, in one-day windows."""
    ids = table(spark, base, "customer").select(F.col("c_custkey").cast("string"))
    return match_ids(read_id_list(spark, _text(ids, "id-list")), event_log(spark, base), S.AS_OF, 1, 1, 10,
                     channel=S.VIDEO_CHANNEL, id_rule=id_length("userid", ">=", 2))


def partitioned_log_profile(spark: SparkSession, base: str) -> DataFrame:
    """S3 + X3: the per-day profile over some days of a log in day folders (folders pruned)."""
    path = shared_path(spark, "day-log")
    event_log(spark, base).select("userid", "mediadata", "channel", "etl_dt").write.partitionBy("etl_dt").parquet(path)
    log = in_days(read_log(spark, path), "2024-01-10", "2024-01-20", ts_col=None)
    found = code_flag_profile(log, "mediadata", S.EVENT_JSON_KEY, S.event_code_map(), S.EVENT_CODE_LEN, "userid",
                              by=["etl_dt"], source="events", update_dt=S.AS_OF_TEXT)
    return found.withColumn("etl_dt", F.col("etl_dt").cast("string"))


def multi_code_profile(spark: SparkSession, base: str) -> DataFrame:
    """X2 + F2 + F3: payloads that list three codes each."""
    k = json_field("mediadata", S.EVENT_JSON_KEY).cast("long")
    codes = F.concat_ws(",", *[c.cast("string") for c in (k, k * 7 % 100, (k + 31) % 100)])
    log = event_log(spark, base).filter(k.isNotNull()).select(
        "userid", F.to_json(F.struct(codes.alias("codes"))).alias("mediadata"))
    return code_flag_profile(log, "mediadata", "codes", S.event_code_map(), S.EVENT_CODE_LEN, "userid",
                             source="events", update_dt=S.AS_OF_TEXT)


def id_coverage_plain(spark: SparkSession, base: str) -> DataFrame:
    """J8 + P12 on the plain id: users of three-character ids found in the mapping."""
    users = table(spark, base, "events").select(F.col("user_id").cast("string").alias("userid")).distinct()
    orders = table(spark, base, "orders")
    flag = F.when(F.col("o_orderstatus") == "F", F.lit("imei")).otherwise(F.lit("idfa"))
    mapping = orders.select(F.col("o_custkey").cast("string").alias("idfa_imei"), flag.alias("app_flag"))
    return mapped_users(users, mapping, hashed=False, id_len=3)


def report_order(spark: SparkSession, base: str) -> DataFrame:
    """M2 + S11: the long report table written as CSV with a header, read back, each row's place in its order."""
    path = shared_path(spark, "long-report")
    report = E.class_report(S.scored_runs(spark, base), "field", "y", "pred")
    (report.select("label", "precision", "recall", "f1_score", "support", "field")
     .write.option("header", True).csv(path))
    return E.number_long(E.read_long_table(spark, path))


def report_metrics(spark: SparkSession, base: str) -> DataFrame:
    """M1 + M7 + M8: metrics through report files, with a run of one class and a run with missing scores."""
    runs = S.scored_runs(spark, base)
    gap = (F.col("field") == GAPPY_RUN) & (F.col("segment") == 0)
    gappy = runs.withColumn("p", F.when(~gap, F.col("p")))
    single = runs.filter("field = 0 and y = 1").withColumn("field", F.lit(ONE_CLASS_RUN))
    runs = gappy.unionByName(single)
    found = E.ranking_metrics(runs, "field", "y", "p").withColumn("logloss", F.round("logloss", 9))
    path = shared_path(spark, "metric-reports")
    E.write_reports(E.format_reports(E.class_report(runs, "field", "y", "pred"), found, "field"), "field", path)
    return E.read_report_metrics(spark, path).drop("file")


def month_score_profile(spark: SparkSession, base: str) -> DataFrame:
    """X7 as a job: one month's averaged scores from a log that holds two months."""
    log, scores, out = (shared_path(spark, n) for n in ("two-month-log", "payload-scores", "month-scores"))
    day = F.date_add(F.to_date("etl_dt"), (F.col("userid") % 2 * 31).cast("int"))
    (as_event_log(table(spark, base, "events"))
     .select(F.col("userid").cast("string").alias("idfa"), "mediadata",
             F.when(F.col("channel") == S.VIDEO_CHANNEL, 3).otherwise(4).alias("channelid"),
             F.date_format(day, "yyyy-MM-dd").alias("etl_dt"))
     .write.partitionBy("etl_dt").parquet(log))
    S.payload_scores(spark, base).write.parquet(scores)
    jobs.scored_profile(spark, log, scores, out, S.AS_OF, month="2024-01", id_rule=id_length("idfa", ">=", 2),
                        source="events")
    return read_published(spark, out).withColumn("etl_month", F.col("etl_month").cast("string"))


QUERIES = {f.__name__: f for f in (
    dict_file_profile, title_file_match, id_file_match, partitioned_log_profile, multi_code_profile, id_coverage_plain,
    report_order, report_metrics, month_score_profile)}
