"""Metric identities, AUC against brute force, report blocks, vocabulary, global index."""

import math
import random

import pytest
from pyspark.sql import functions as F

from profilekit.operators import evaluate as E
from profilekit.operators.ranking import global_index
from tests.conftest import rows


def _pred(spark):
    rnd = random.Random(11)
    data = []
    for run in range(3):
        for _ in range(200):
            y = 1 if rnd.random() < 0.3 + 0.1 * run else 0
            p = round(rnd.random(), 1)  # few distinct scores: many ties
            if rnd.random() < 0.05:
                p = float(rnd.choice([0, 1]))
            data.append((run, y, p, int(p >= 0.5)))
    data += [(9, 1, 0.3, 0), (9, 1, 0.6, 1)]  # a run with one class only
    return spark.createDataFrame(data, "run int, y int, p double, pred int"), data


def test_class_report_identities(spark):
    df, data = _pred(spark)
    rep = E.class_report(df, "run", "y", "pred").filter(F.col("run") == 0)
    got = {r["label"]: r for r in rep.collect()}
    d = [x for x in data if x[0] == 0]
    for value, name in E.DEFAULT_CLASSES:
        tp = sum(1 for _, y, _, p in d if y == value and p == value)
        pp = sum(1 for _, _, _, p in d if p == value)
        sup = sum(1 for _, y, _, _ in d if y == value)
        assert math.isclose(got[name]["precision"], tp / pp)
        assert math.isclose(got[name]["recall"], tp / sup)
        pr, rc = tp / pp, tp / sup
        assert math.isclose(got[name]["f1_score"], 2 * pr * rc / (pr + rc))
        assert got[name]["support"] == sup
    acc = sum(1 for _, y, _, p in d if y == p) / len(d)
    assert math.isclose(got["microavg"]["precision"], acc)
    names = [n for _, n in E.DEFAULT_CLASSES]
    assert math.isclose(got["macroavg"]["recall"], sum(got[n]["recall"] for n in names) / 2)
    w = sum(got[n]["f1_score"] * got[n]["support"] for n in names) / len(d)
    assert math.isclose(got["weightedavg"]["f1_score"], w)
    assert got["weightedavg"]["support"] == len(d)


def test_auc_matches_brute_force_pairs(spark):
    df, data = _pred(spark)
    got = {r["run"]: r["auc"] for r in E.auc(df, "run", "y", "p").collect()}
    for run in range(3):
        d = [(y, p) for r, y, p, _ in data if r == run]
        pos = [p for y, p in d if y == 1]
        neg = [p for y, p in d if y == 0]
        s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
        assert math.isclose(got[run], s / (len(pos) * len(neg)), rel_tol=0, abs_tol=1e-15)
    assert got[9] is None


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(0, 1, 1.0), (0, 0, 0.0), (0, 1, 0.0)], "run int, y int, p double")
    ll = E.log_loss(df, "run", "y", "p").first()["logloss"]
    eps = 1e-15
    expect = (-math.log(1 - eps) - math.log(1 - eps) - math.log(eps)) / 3
    assert math.isclose(ll, expect, rel_tol=1e-9)


def test_rows_without_a_score_count_in_neither_metric(spark):
    df = spark.createDataFrame([(5, 1, 0.9), (5, 0, 0.1), (5, 1, None), (5, None, 0.4), (9, 1, 0.5), (9, 1, None)],
                               "run int, y int, p double")
    got = {r["run"]: r for r in E.ranking_metrics(df, "run", "y", "p").collect()}
    assert got[5]["auc"] == 1.0 and math.isclose(got[5]["logloss"], -math.log(0.9), rel_tol=1e-12)
    assert (got[5]["n_pos"], got[5]["n_neg"]) == (1, 1)
    assert got[9]["auc"] is None and math.isclose(got[9]["logloss"], math.log(2), rel_tol=1e-12)
    assert math.isclose({r["run"]: r["logloss"] for r in E.log_loss(df, "run", "y", "p").collect()}[5], -math.log(0.9))


def test_run_ids_survive_the_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(5, 1, 0.9, 1), (5, 0, 0.1, 0), (9, 1, 0.5, 1)], "run int, y int, p double, pred int")
    path = str(tmp_path / "r")
    blocks = E.format_reports(E.class_report(df, "run", "y", "pred"), E.ranking_metrics(df, "run", "y", "p"), "run")
    E.write_reports(blocks, "run", path)
    assert {r["field"]: r["auc"] for r in E.read_report_metrics(spark, path).collect()} == {5: 1.0, 9: None}
    assert {r["field"] for r in E.read_reports(spark, path).collect()} == {5, 9}


def test_report_blocks_round_trip(spark, tmp_path):
    df, _ = _pred(spark)
    rep = E.class_report(df, "run", "y", "pred")
    metrics = (E.auc(df, "run", "y", "p").join(E.log_loss(df, "run", "y", "p"), "run"))
    path = str(tmp_path / "reports")
    blocks = E.format_reports(rep, metrics, "run")
    assert any(r["auc"] is None for r in metrics.collect())  # the one-class run takes part
    first = blocks.orderBy("run").first()["block"].split("\r\n")
    assert len(first) == E.BLOCK_LINES and first[0] == E.REPORT_HEADER and first[9] == E.AUC_MARKER
    assert [ln.split(",")[0] for ln in first[2:4]] == ["exposure", "click"]
    assert [ln.split(",")[0] for ln in first[5:8]] == list(E.AVERAGE_LABELS)
    E.write_reports(blocks, "run", path)
    back = E.read_reports(spark, path).drop("file")
    assert rows(back) == rows(rep.select(F.col("run").alias("field"), "label", "precision", "recall",
                                         "f1_score", "support"))
    m = {r["field"]: r for r in E.read_report_metrics(spark, path).collect()}
    for r in metrics.collect():
        assert m[r["run"]]["auc"] == r["auc"] and m[r["run"]]["logloss"] == r["logloss"]


def test_read_report_in_original_layout(spark, tmp_path):
    # a hand-typed block in the layout of the original report dumps (values made up)
    block = "\r\n".join([
        ",precision,recall,f1-score,support", ",,,,",
        "exposure,0.5,0.25,0.33,40", "click,0.75,0.9,0.82,60", ",,,,",
        "microavg,0.7,0.7,0.7,100", "macroavg,0.62,0.57,0.58,100", "weightedavg,0.65,0.7,0.66,100",
        ",,,,", "==========,auc-test,==========,,", "0.612345678,,,,", "test,logloss:,0.687654321,,",
    ])
    f = tmp_path / "blocks.csv"
    f.write_text(block + "\r\n" + block.replace("0.612345678", "0.5") + "\r\n")
    long = E.order_long(E.read_reports(spark, str(f)).drop("file"))
    got = long.collect()
    assert len(got) == 10
    assert [r["label"] for r in got][:2] == ["click", "click"]
    assert {r["field"] for r in got} == {0, 1}
    m = sorted((r["field"], r["auc"], r["logloss"]) for r in E.read_report_metrics(spark, str(f)).collect())
    assert m == [(0, 0.612345678, 0.687654321), (1, 0.5, 0.687654321)]


def test_long_tables(spark, tmp_path):
    csv = tmp_path / "long.csv"
    csv.write_text("Unnamed: 0,precision,recall,f1-score,support,field\nclick,0.5,0.6,0.55,10,2\n"
                   "click,0.4,0.6,0.5,10,10\nexposure,0.1,0.2,0.3,5,1\n")
    tsv = tmp_path / "long.tsv"
    tsv.write_text("click\t0.5\t0.6\t0.55\t10\t2\n")
    a = E.order_long(E.read_long_table(spark, str(csv))).collect()
    assert [(r["label"], r["field"]) for r in a] == [("click", 2), ("click", 10), ("exposure", 1)]
    b = E.read_long_table(spark, str(tsv), sep="\t", header=False).collect()
    assert b[0]["f1_score"] == 0.55 and b[0]["support"] == 10


def test_ablation_compare(spark):
    m = spark.createDataFrame([(0, 0.6, 0.7), (1, 0.65, 0.66), (2, 0.7, 0.6)], "run int, auc double, ll double")
    out = {r["run"]: r for r in E.ablation_compare(m, "run", 2, ["auc", "ll"]).collect()}
    assert math.isclose(out[0]["delta_auc"], 0.6 - 0.7) and out[2]["delta_ll"] == 0.0
    best = {r["run"]: r for r in E.ablation_compare(m, "run", "best", ["auc", "ll"]).collect()}
    assert best[2]["delta_auc"] == 0.0 and best[1]["delta_auc"] < 0


def test_vocabulary(spark):
    lines = spark.createDataFrame([("4,a:1,a:2,b:x,history:h:1,plain",), ("4,a:1,b:y,,",)], "line string")
    got = dict(rows(E.vocabulary(lines, "line")))
    assert got == {"a": 2, "b": 2, "history": 1, "plain": 1}


def test_global_index(spark):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("k"))
    idx = global_index(df, ["k"], "i", partitions=7)
    got = sorted((r["k"], r["i"]) for r in idx.collect())
    assert got == [(k, k + 1) for k in range(1000)]


def test_auc_of_a_narrow_run_among_wide_ones(spark):
    """One run has most of the scores, all within a millionth; every range still holds its share, and the AUC is exact."""
    import numpy as np

    rng = np.random.default_rng(6)
    rows = [("narrow", int(y), 0.5 + float(s) * 1e-6) for y, s in zip(rng.integers(0, 2, 12_000), rng.random(12_000), strict=True)]
    for k in range(6):
        rows += [(f"wide{k}", int(rng.random() < s), float(s)) for s in rng.random(300).round(2)]
    df = spark.createDataFrame(rows, "run string, y int, p double")
    per_score = df.groupBy("run", F.col("p").alias("_score")).agg(F.sum("y").cast("long").alias("pos")).checkpoint()
    n = per_score.count()
    sizes = [r["count"] for r in E.score_ranges(per_score, ["run"], n, 500).groupBy("_range").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 2.5 * n / len(sizes)
    got = {r["run"]: r["auc"] for r in E.ranking_metrics(df, "run", "y", "p", range_rows=500).collect()}
    for run in got:
        mine = sorted((s, y) for r, y, s in rows if r == run)
        scores, ys = np.array([s for s, _ in mine]), np.array([y for _, y in mine])
        below = np.searchsorted(scores[ys == 0], scores[ys == 1], "left") + np.searchsorted(scores[ys == 0], scores[ys == 1], "right")
        assert got[run] == pytest.approx(below.sum() / 2 / ((ys == 1).sum() * (ys == 0).sum()), rel=1e-12)


def test_one_large_report_file_is_read_by_several_tasks(spark, tmp_path):
    """Blocks that cross the borders of splits keep their lines."""
    def block(k):
        number = [f"{(k * 7 + i) % 1000 / 1000}" for i in range(3)]
        lines = [E.REPORT_HEADER, E.REPORT_BLANK, *[f"{c},{','.join(number)},{k + j}" for j, c in enumerate(("exposure", "click"))], E.REPORT_BLANK,
                 *[f"{a},{','.join(number)},{k}" for a in E.AVERAGE_LABELS], E.REPORT_BLANK, E.AUC_MARKER, f"0.{k + 1},,,,", f"{E.LOGLOSS_PREFIX},0.{k + 2},,"]
        assert len(lines) == E.BLOCK_LINES
        return lines
    runs = 400
    f = tmp_path / "raw.csv"
    f.write_text("\r\n".join(x for k in range(runs) for x in block(k)) + "\r\n", newline="")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20001")
    try:
        assert spark.read.text(str(f)).rdd.getNumPartitions() > 5
        got = sorted((r.field, r.label, r.precision, r.support) for r in E.read_reports(spark, str(f)).collect())
        metrics = {r.field: (r.auc, r.logloss) for r in E.read_report_metrics(spark, str(f)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = []
    for k in range(runs):
        for line in (block(k)[i] for i in (*E.CLASS_LINES, *E.AVERAGE_LINES)):
            label, p, _, _, s = line.split(",")
            want.append((k, label, float(p), int(s)))
    assert got == sorted(want)
    assert metrics == {k: (float(f"0.{k + 1}"), float(f"0.{k + 2}")) for k in range(runs)}
