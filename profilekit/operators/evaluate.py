"""Click-model evaluation as Spark aggregations over a scored table.

Input: one row per test example and run, ``(run, label, score)`` or
``(run, label, prediction)``. Every metric is one grouped aggregation (partial
+ final), so a run holding most of the rows is reduced inside each map task.

- ``class_report``: per-class precision / recall / F1 / support and the micro,
  macro and support-weighted averages, in the long form of the report files.
- ``auc``: exact area under the ROC curve with ties counted half. Examples are
  first reduced to one row per (run, distinct score); the count of negatives
  below each score is a distributed prefix sum over range partitions of
  (run, score): a running sum inside each partition that starts from its
  runs' negatives below. No window ever holds more than a partition's share.
- ``log_loss``: mean negative log-likelihood with the probability clipped.
- ``format_reports`` / ``read_reports``: the 12-line text block per run and back.
- ``ablation_compare``: metric deltas of each run against a baseline run.
- ``vocabulary``: feature tokens ``namespace:value`` per namespace.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profilekit.operators.ranking import global_index

# --- fixed values: report layout (class names, average rows, block shape) ---
DEFAULT_CLASSES: tuple[tuple[int, str], ...] = ((0, "exposure"), (1, "click"))
AVERAGE_LABELS = ("microavg", "macroavg", "weightedavg")
REPORT_HEADER = ",precision,recall,f1-score,support"
REPORT_BLANK = ",,,,"
AUC_MARKER = "==========,auc-test,==========,,"
LOGLOSS_PREFIX = "test,logloss:"
BLOCK_LINES = 12
# positions inside a block: header 0, blank 1, classes 2-3, blank 4,
# averages 5-7, blank 8, AUC marker 9, AUC value 10, log-loss 11
CLASS_LINES = (2, 3)
AVERAGE_LINES = (5, 6, 7)
AUC_LINE = 10
LOGLOSS_LINE = 11

METRICS = ("precision", "recall", "f1_score", "support")


def _ratio(num: Column, den: Column) -> Column:
    # 0 when the denominator is 0 (no predicted / no true example of a class).
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def _f1(p: Column, r: Column) -> Column:
    return F.when((p + r) == 0, F.lit(0.0)).otherwise(F.lit(2.0) * p * r / (p + r))


def class_report(pred: DataFrame, run_col: str | None, label_col: str, pred_col: str,
                 classes: Sequence[tuple[int, str]] = DEFAULT_CLASSES) -> DataFrame:
    """Long-form report: ``(run, label, precision, recall, f1_score, support)``.

    One ``groupBy(run)`` of conditional counts; the per-class and average rows
    are then computed from those counts on the (tiny) grouped result.
    """
    y, p = F.col(label_col), F.col(pred_col)
    keys = [run_col] if run_col else []
    counts = []
    for value, name in classes:
        counts += [
            F.sum(F.when((y == value) & (p == value), 1).otherwise(0)).alias(f"tp_{name}"),
            F.sum(F.when(p == value, 1).otherwise(0)).alias(f"pp_{name}"),
            F.sum(F.when(y == value, 1).otherwise(0)).alias(f"sup_{name}"),
        ]
    g = pred.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *counts)
    names = [name for _, name in classes]
    per = {}
    for name in names:
        prec = _ratio(F.col(f"tp_{name}"), F.col(f"pp_{name}"))
        rec = _ratio(F.col(f"tp_{name}"), F.col(f"sup_{name}"))
        per[name] = (prec, rec, _f1(prec, rec), F.col(f"sup_{name}"))
    n = F.col("n")
    correct = sum((F.col(f"tp_{name}") for name in names), F.lit(0))
    micro = _ratio(correct, n)
    k = float(len(names))

    def mean(i: int) -> Column:
        return sum((per[name][i] for name in names), F.lit(0.0)) / F.lit(k)

    def weighted(i: int) -> Column:
        total = sum((per[name][i] * per[name][3] for name in names), F.lit(0.0))
        return _ratio(total, n)

    rows = [F.struct(F.lit(name).alias("label"), per[name][0].alias("precision"),
                     per[name][1].alias("recall"), per[name][2].alias("f1_score"),
                     per[name][3].cast("long").alias("support")) for name in names]
    rows.append(F.struct(F.lit("microavg").alias("label"), micro.alias("precision"), micro.alias("recall"),
                         micro.alias("f1_score"), n.cast("long").alias("support")))
    rows.append(F.struct(F.lit("macroavg").alias("label"), mean(0).alias("precision"),
                         mean(1).alias("recall"), mean(2).alias("f1_score"), n.cast("long").alias("support")))
    rows.append(F.struct(F.lit("weightedavg").alias("label"), weighted(0).alias("precision"),
                         weighted(1).alias("recall"), weighted(2).alias("f1_score"),
                         n.cast("long").alias("support")))
    return (g.select(*keys, F.explode(F.array(*rows)).alias("r"))
            .select(*keys, "r.label", "r.precision", "r.recall", "r.f1_score", "r.support"))


def _keys(run_col: str | Sequence[str]) -> list[str]:
    return [run_col] if isinstance(run_col, str) else list(run_col)


# Distinct (run, score) rows one range of the AUC holds, about.
RANGE_ROWS = 1_000_000


def score_ranges(per_score: DataFrame, keys: Sequence[str], rows: int, range_rows: int | None = None) -> DataFrame:
    """``per_score`` (one row per run and score) cut into ranges of (run, score) of about equal size, as ``_range``.

    The ranges run through all runs in order: a run of many scores, however
    close together, covers as many ranges as its size asks for, small runs share one.
    """
    spark = per_score.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / (range_rows or RANGE_ROWS)))
    # read twice (carries, rows): the range numbers are fixed by the checkpoint
    return (per_score.repartitionByRange(parts, *keys, "_score").withColumn("_range", F.spark_partition_id())
            .checkpoint(eager=True))


def ranking_metrics(scored: DataFrame, run_col: str | Sequence[str], label_col: str, score_col: str,
                    eps: float = 1e-15, range_rows: int | None = None) -> DataFrame:
    """Exact AUC and log-loss per run, with ``n_pos`` and ``n_neg``, from one pass over the rows.

    AUC is ``sum(pos * (neg_below + neg_same / 2)) / (P * N)``, NULL if a class
    is missing; log-loss the mean of ``-(y ln p + (1 - y) ln(1 - p))`` with
    ``p`` clipped to ``[eps, 1 - eps]``. Rows with a NULL score or label are
    left out of both. ``run_col`` may be several columns (a run and a segment).

    Rows are reduced to one per run and distinct score; these are range
    partitioned on (run, score). A running sum inside each range starts from the
    negatives its run has in the ranges below (its carry: one more row per run
    and range), so no window holds more than a range, whatever the runs' sizes
    and the distribution of their scores.
    """
    keys = _keys(run_col)
    y = F.col(label_col).cast("long")
    known = scored.filter(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
    per_score = (known.groupBy(*keys, F.col(score_col).alias("_score"))
                 .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")).checkpoint(eager=True))
    zero = F.lit(0).cast("long")
    ranged = score_ranges(per_score, keys, per_score.count(), range_rows).withColumn("_carry", zero)
    below = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per run and range it reaches: at most the ranges plus the runs
    carries = ranged.groupBy(*keys, "_range").agg(F.sum("neg").alias("_n")).select(
        *keys, F.lit(None).cast(per_score.schema["_score"].dataType).alias("_score"), zero.alias("pos"), zero.alias("neg"),
        "_range", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_carry"))
    inside = (Window.partitionBy(*keys, "_range").orderBy(F.col("_score").asc_nulls_first())
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = ranged.unionByName(carries).withColumn("_under", F.sum(F.col("neg") + F.col("_carry")).over(inside))
    p = F.least(F.greatest(F.col("_score").cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    loss = -(F.col("pos") * F.ln(p) + F.col("neg") * F.ln(F.lit(1.0) - p))
    n_pos, n_neg = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    return (placed.filter(F.col("_score").isNotNull()).groupBy(*keys)
            .agg(F.sum(F.col("pos").cast("double") * (F.col("_under").cast("double") + F.col("neg") / F.lit(2.0))).alias("_area"),
                 F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum(loss).alias("_loss"))
            .select(*keys, F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.col("_area") / (n_pos * n_neg)).alias("auc"),
                    (F.col("_loss") / (n_pos + n_neg)).alias("logloss"), "n_pos", "n_neg"))


def auc(scored: DataFrame, run_col: str | Sequence[str], label_col: str, score_col: str) -> DataFrame:
    """The AUC part of ``ranking_metrics``."""
    return ranking_metrics(scored, run_col, label_col, score_col).drop("logloss")


def log_loss(scored: DataFrame, run_col: str | Sequence[str], label_col: str, score_col: str,
             eps: float = 1e-15) -> DataFrame:
    """Mean log-loss per run; rows with a NULL score or label are left out."""
    p = F.least(F.greatest(F.col(score_col).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label_col).cast("double")
    term = -(y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p))
    known = scored.filter(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
    return known.groupBy(*_keys(run_col)).agg(F.avg(term).alias("logloss"))


def _num(c: Column) -> Column:
    return c.cast("string")


def format_reports(report: DataFrame, metrics: DataFrame, run_col: str,
                   classes: Sequence[tuple[int, str]] = DEFAULT_CLASSES) -> DataFrame:
    """One 12-line text block per run (``run``, ``block``), lines joined by CRLF.

    ``report`` is ``class_report`` output; ``metrics`` holds ``auc`` and
    ``logloss`` per run. Numbers are written in full precision, so reading the
    block back gives the same doubles.
    """
    line = F.concat_ws(",", F.col("label"), _num(F.col("precision")), _num(F.col("recall")),
                       _num(F.col("f1_score")), _num(F.col("support")))
    # class lines in class order, then the three averages
    names = [name for _, name in sorted(classes)]
    order = F.coalesce(
        F.when(F.col("label").isin(*names), F.array_position(F.array(*[F.lit(x) for x in names]), F.col("label"))),
        F.array_position(F.array(*[F.lit(x) for x in AVERAGE_LABELS]), F.col("label")) + 100)
    lines = report.select(run_col, order.alias("_o"), "label", line.alias("line"))
    per_run = lines.groupBy(run_col).agg(
        F.sort_array(F.collect_list(F.struct("_o", "label", "line"))).alias("_lines"))
    cls = F.filter(F.col("_lines"), lambda s: s["_o"] < 100)
    avg = F.filter(F.col("_lines"), lambda s: s["_o"] > 100)
    joined = per_run.join(metrics, run_col, "left")
    block = F.concat_ws(
        "\r\n",
        F.lit(REPORT_HEADER), F.lit(REPORT_BLANK),
        F.array_join(F.transform(cls, lambda s: s["line"]), "\r\n"),
        F.lit(REPORT_BLANK),
        F.array_join(F.transform(avg, lambda s: s["line"]), "\r\n"),
        F.lit(REPORT_BLANK), F.lit(AUC_MARKER),
        # a metric that does not exist leaves its field empty, never its line out
        F.concat(F.coalesce(_num(F.col("auc")), F.lit("")), F.lit(",,,,")),
        F.concat(F.lit(LOGLOSS_PREFIX + ","), F.coalesce(_num(F.col("logloss")), F.lit("")), F.lit(",,")),
    )
    return joined.select(run_col, block.alias("block"))


def write_reports(blocks: DataFrame, run_col: str, path: str) -> None:
    """Write each run's block as a report file of its own, under a folder that names the run."""
    (blocks.select(F.col(run_col).alias("field"), F.col("block").alias("value"))
     .write.mode("overwrite").partitionBy("field").option("lineSep", "\r\n").text(path))


def _placed_lines(spark, path: str) -> DataFrame:
    """``(file, field, at, f)``: each line of each report file, its run, its place in the block, its fields.

    The run is the folder's (``field=...``); a file of several blocks outside
    such a folder, as in the original layout, numbers its runs by the block.
    Files are read in splits, line by line: a block may begin in one task's
    split and end in another's.
    """
    raw = spark.read.text(path)
    own = [F.col("field").cast("int").alias("field")] if "field" in raw.columns else []
    lines = raw.select("value", *own, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       F.monotonically_increasing_id().alias("_row"))
    # a line's place: the lines of the file's earlier splits (one row per split) and of its own split before it
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = lines.groupBy("file", "start").agg(F.count(F.lit(1)).alias("_n")).select(
        "file", "start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("file", "start").orderBy("_row")
    pos = F.col("_before") + F.row_number().over(inside) - 1
    placed = lines.join(F.broadcast(before), ["file", "start"]).withColumn("pos", pos)
    block = F.floor(F.col("pos") / BLOCK_LINES).cast("int")
    return placed.select("file", (F.coalesce("field", block) if own else block).alias("field"),
                         (F.col("pos") % BLOCK_LINES).alias("at"), F.split("value", ",").alias("f"))


def read_reports(spark, path: str) -> DataFrame:
    """Report files -> ``(file, field, label, precision, recall, f1_score, support)``.

    Each file is a series of 12-line blocks (see ``_placed_lines``); each line is
    placed by its position in the block. A field that is no number is NULL.
    """
    rows = _placed_lines(spark, path).filter(F.col("at").isin(*CLASS_LINES, *AVERAGE_LINES))
    return rows.select(
        "file", "field",
        F.get(F.col("f"), 0).alias("label"),
        F.get(F.col("f"), 1).try_cast("double").alias("precision"),
        F.get(F.col("f"), 2).try_cast("double").alias("recall"),
        F.get(F.col("f"), 3).try_cast("double").alias("f1_score"),
        F.get(F.col("f"), 4).try_cast("double").cast("long").alias("support"),
    )


def read_report_metrics(spark, path: str) -> DataFrame:
    """``(file, field, auc, logloss)`` from the last two lines of each block (NULL where a field is empty)."""
    at = F.col("at")
    return (_placed_lines(spark, path).filter(at.isin(AUC_LINE, LOGLOSS_LINE))
            .groupBy("file", "field")
            .agg(F.max(F.when(at == AUC_LINE, F.get(F.col("f"), 0))).try_cast("double").alias("auc"),
                 F.max(F.when(at == LOGLOSS_LINE, F.get(F.col("f"), 2))).try_cast("double").alias("logloss")))


def read_long_table(spark, path: str, sep: str = ",", header: bool = True) -> DataFrame:
    """The long form as CSV (header ``Unnamed: 0,...,field``) or TSV without header."""
    schema = "label string, precision double, recall double, f1_score double, support long, field int"
    return spark.read.csv(path, sep=sep, header=header, schema=schema)


def order_long(df: DataFrame) -> DataFrame:
    """M2: order by label, then numeric field."""
    return df.orderBy("label", F.col("field").cast("int"))


def number_long(df: DataFrame, name: str = "position") -> DataFrame:
    """M2 with each row's position in that order (from 1) as a column."""
    return global_index(df.withColumn("field", F.col("field").cast("int")), ["label", "field"], name)


def ablation_compare(metrics: DataFrame, run_col: str, baseline, cols: Sequence[str]) -> DataFrame:
    """Each run's metrics with ``delta_<m> = m - m(baseline run)``.

    ``baseline`` is a run id, or ``"best"`` for the run with the highest first
    metric (ties: smallest run id). ``metrics`` has one row per run; the single
    baseline row is read once and its values enter the projection as literals.
    """
    metrics = metrics.checkpoint(eager=True)  # one row per run, computed once
    if baseline == "best":
        base = metrics.orderBy(F.desc_nulls_last(cols[0]), F.asc(run_col)).select(*cols).first()
    else:
        base = metrics.filter(F.col(run_col) == F.lit(baseline)).select(*cols).first()
    if base is None:
        raise ValueError(f"baseline run {baseline!r} not found")
    deltas = [(F.col(c) - F.lit(base[c]).cast("double")).alias(f"delta_{c}") for c in cols]
    return metrics.select(run_col, *cols, *deltas).orderBy(f"delta_{cols[0]}")


def vocabulary(lines: DataFrame, line_col: str, sep: str = ",", head_tokens: int = 1) -> DataFrame:
    """Feature vocabulary lines -> distinct tokens per namespace.

    A line holds ``head_tokens`` leading tokens, then ``namespace:value``
    tokens. The namespace is the text before the first ``:`` (a token without
    ``:`` is its own namespace, with an empty value).
    """
    toks = (lines.select(F.posexplode(F.split(F.col(line_col), sep)).alias("pos", "token"))
            .filter((F.col("pos") >= head_tokens) & (F.length("token") > 0))
            .select("token").distinct())
    return (toks.select(F.substring_index("token", ":", 1).alias("namespace"),
                        F.when(F.instr("token", ":") > 0, F.expr("substr(token, instr(token, ':') + 1)"))
                        .otherwise(F.lit("")).alias("value"))
            .groupBy("namespace").agg(F.count(F.lit(1)).alias("n_values")))
