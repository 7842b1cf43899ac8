"""Parameters that map the driver's tables onto the profiling jobs.

``events`` plays the ad log (user_id = device id, props = JSON payload with key
``k``, event_type = channel, ts = day). Dictionaries that the original jobs read
from files are built here from rules, so that Spark and the DuckDB oracle
build exactly the same tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profilekit.functions.columns import day_string, json_field
from profilekit.sources.tables import table
from profilekit.vocab import INTERESTS, SCORED_INTERESTS, ZERO_INTERESTS

# Run date of every stand-in job (the original used the wall clock).
AS_OF = _dt.date(2024, 1, 31)
AS_OF_TEXT = AS_OF.isoformat()

# JSON key of the coded payload and the length a code must have.
EVENT_JSON_KEY = "k"
EVENT_CODE_LEN = 2

# Codes 0..39 map to interest number k % 11 (many-to-one, 10 interests never
# reached); codes 40..99 are unmapped and keep their rows with tag ''.
EVENT_MAPPED_CODES = 40
EVENT_TAG_MODULUS = 11

# Channel of the video log, as in the title and id-match jobs.
VIDEO_CHANNEL = "view"
# Channel of the social log, as in the coded-tag extract.
SOCIAL_CHANNEL = "click"

# Codes the scored dictionary covers and its score rule.
SCORE_CODES = 100
SCORE_MODULUS = 121


def event_code_map() -> list[tuple[str, str]]:
    """Code -> interest pairs of the events stand-in."""
    return [(str(k), INTERESTS[k % EVENT_TAG_MODULUS]) for k in range(EVENT_MAPPED_CODES)]


def score_of(code: int, j: int) -> int:
    """Score of interest j for code ``code``."""
    return (code * (j + 1)) % SCORE_MODULUS


def code_scores(spark: SparkSession) -> DataFrame:
    """Scored dictionary of codes: ``iqytag`` (code text), 13 scores, 8 zero columns.

    Built with ``spark.range`` so it is a relation of the same rule the oracle uses.
    """
    k = F.col("id")
    cols = [k.cast("string").alias("iqytag")]
    cols += [((k * (j + 1)) % SCORE_MODULUS).cast("double").alias(name)
             for j, name in enumerate(SCORED_INTERESTS)]
    cols += [F.lit(0).cast("double").alias(name) for name in ZERO_INTERESTS]
    return spark.range(SCORE_CODES).select(*cols)


# Dictionary tags of the app stand-in: tag of a part = entry p_size % 23 of the
# 21 interests followed by '' and 'null' (two unusable tags that are dropped).
APP_TAG_MODULUS = 23
APP_TAGS = (*INTERESTS, "", "null")


def app_log(spark: SparkSession, base: str) -> DataFrame:
    """lineitem as an app log: supplier = user, part name = app name, ship day = day."""
    li = table(spark, base, "lineitem")
    part = table(spark, base, "part")
    return (li.join(part, li["l_partkey"] == part["p_partkey"], "inner")
            .select(F.col("l_suppkey").alias("userid"), F.col("p_name").alias("appname"),
                    day_string("l_shipdate").alias("etl_dt")))


def app_dictionary(spark: SparkSession, base: str) -> DataFrame:
    """Raw dictionary lines ``(appname, tag, line)``; a name repeats with other tags."""
    part = table(spark, base, "part")
    tags = F.array(*[F.lit(t) for t in APP_TAGS])
    return part.select(F.col("p_name").alias("appname"),
                       F.element_at(tags, (F.col("p_size") % APP_TAG_MODULUS + 1).cast("int")).alias("tag"),
                       F.col("p_partkey").alias("line"))


def item_scores(priority: Column) -> list[Column]:
    """13 scores by the score rule on a priority column, then 8 zero columns."""
    cols = [((priority * (j + 1)) % SCORE_MODULUS).cast("double").alias(name)
            for j, name in enumerate(SCORED_INTERESTS)]
    cols += [F.lit(0).cast("double").alias(name) for name in ZERO_INTERESTS]
    return cols


def passage_dictionary(spark: SparkSession, base: str) -> DataFrame:
    """Scored title dictionary from ``benchmark``: key = passage text, file order = item_id."""
    b = table(spark, base, "benchmark")
    return b.select(F.col("text").alias("iqytag"), F.col("item_id").alias("priority"),
                    *item_scores(F.col("item_id")))


def token_dictionary(spark: SparkSession, base: str) -> DataFrame:
    """Scored dictionary of all name tokens of ``part``.

    File order of a token = its first appearance: ``10 * p_partkey + position``.
    """
    part = table(spark, base, "part")
    toks = (part.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "tok"))
            .groupBy("tok").agg(F.min(F.col("p_partkey") * 10 + F.col("pos")).alias("priority")))
    return toks.select(F.col("tok").alias("iqytag"), "priority", *item_scores(F.col("priority")))


def payload_scores(spark: SparkSession, base: str) -> DataFrame:
    """Scored payload table (yktag, iqytag, 21 scores): distinct payloads, code, scores."""
    payloads = table(spark, base, "events").select(F.col("props").alias("yktag")).distinct()
    coded = payloads.select("yktag", json_field("yktag", EVENT_JSON_KEY).alias("iqytag"))
    # spark.range(SCORE_CODES): its size is fixed by construction
    return coded.join(F.broadcast(code_scores(spark)), "iqytag", "inner").select("yktag", "iqytag", *INTERESTS)


# Click-model stand-in: integer features of an event, a score per run that
# leaves one feature out (run 4 keeps all), probability (s + 0.5) / (s + 100.5).
FEATURES = ("value", "hour", "code", "weekday")
FULL_RUN = len(FEATURES)


def event_features(spark: SparkSession, base: str) -> DataFrame:
    ev = table(spark, base, "events")
    return ev.select(
        (F.col("event_type") == "click").cast("int").alias("y"),
        F.floor(F.col("value") / F.lit(10.0)).cast("long").alias("value"),
        F.hour("ts").cast("long").alias("hour"),
        F.get_json_object("props", f"$.{EVENT_JSON_KEY}").cast("long").alias("code"),
        F.weekday("ts").cast("long").alias("weekday"),
        F.col("event_type"),
    )


def scored_runs(spark: SparkSession, base: str) -> DataFrame:
    """``(field, segment, y, p, pred)``: one row per event and run; segment = weekday."""
    feats = event_features(spark, base)
    runs = []
    for r in range(FULL_RUN + 1):
        s = sum((F.coalesce(F.col(f), F.lit(0)) for i, f in enumerate(FEATURES) if i != r), F.lit(0))
        runs.append(F.struct(F.lit(r).alias("field"), s.alias("s")))
    p = (F.col("s").cast("double") + F.lit(0.5)) / (F.col("s").cast("double") + F.lit(100.5))
    return (feats.select("y", F.col("weekday").alias("segment"), F.inline(F.array(*runs)))
            .select("field", "segment", "y", p.alias("p"), (p >= F.lit(0.5)).cast("int").alias("pred")))


def feature_lines(spark: SparkSession, base: str) -> DataFrame:
    """One vocabulary line per event: head token, then ``namespace:value`` tokens."""
    feats = event_features(spark, base)
    toks = [F.concat(F.lit(f"{f}:"), F.col(f).cast("string")) for f in FEATURES]
    toks.append(F.concat(F.lit("type:"), F.col("event_type")))
    return feats.select(F.concat_ws(",", F.lit(str(len(FEATURES))), *toks).alias("line"))
