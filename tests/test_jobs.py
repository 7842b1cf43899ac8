"""The batch jobs end to end on a small day-partitioned log (synthetic ids)."""

import hashlib


from profilekit import jobs
from profilekit.sources.publish import read_published
from profilekit.vocab import INTERESTS


def _md5(s):
    return hashlib.md5(s.encode()).hexdigest()


IMEI_A, IMEI_B = "860000000000001", "860000000000002"
IDFA_A = "IDFA-AAAA-0001"

LOG = [
    # imei, imeimd5, idfa, mediadata, channelid, etl_dt
    (IMEI_A, _md5(IMEI_A), IDFA_A, '{"usertag":"10001,10002","title":"The Big Movie 2"}', 4, "2024-01-30"),
    (IMEI_A, _md5(IMEI_A), IDFA_A, '{"usertag":"10001,10002","title":"The Big Movie 2"}', 4, "2024-01-30"),
    (IMEI_B, _md5(IMEI_B), "short", '{"usertag":"10009"}', 4, "2024-01-29"),
    (IMEI_A, _md5(IMEI_A), IDFA_A, '{"title":"The Big Movie 2"}', 3, "2024-01-30"),
    (IMEI_A, _md5(IMEI_A), IDFA_A, '{"title":"Small Film"}', 3, "2024-01-29"),
    (IMEI_B, _md5(IMEI_B), "IDFA-BBBB-0002", '{"title":"nothing known"}', 3, "2024-01-30"),
]
SCHEMA = "imei string, imeimd5 string, idfa string, mediadata string, channelid int, etl_dt string"


def test_jobs_end_to_end(spark, tmp_path):
    log = str(tmp_path / "log")
    spark.createDataFrame(LOG, SCHEMA).write.partitionBy("etl_dt").parquet(log)

    # staging extract of the social channel (md5 ids), then the coded-tag profiles
    staging = str(tmp_path / "staging")
    jobs.extract_staging(spark, log, staging, "2024-01-31", 1, 31)
    assert read_published(spark, staging).count() == 2          # duplicate row removed
    month = str(tmp_path / "month")
    prof = {r["userid"]: r for r in jobs.coded_profile(spark, staging, month, "2024-01-31", month="2024-01").collect()}
    assert prof[_md5(IMEI_A)]["game"] == 1 and prof[_md5(IMEI_A)]["car"] == 1
    assert prof[_md5(IMEI_B)]["technology"] == 1
    from profilekit.vocab import SOCIAL_CODE_LABELS
    labelled = jobs.coded_profile(spark, staging, str(tmp_path / "month_labels"), "2024-01-31", month="2024-01",
                                  code_map=list(SOCIAL_CODE_LABELS)).collect()
    assert {r["userid"]: r["game"] for r in labelled} == {_md5(IMEI_A): 1, _md5(IMEI_B): 0}
    days = str(tmp_path / "days")
    jobs.coded_profile(spark, staging, days, "2024-01-31", from_i=1, to_i=3)
    assert spark.read.parquet(days).select("etl_dt").distinct().count() == 2

    # app profile from an app staging table and a tab dictionary
    apps = str(tmp_path / "apps")
    spark.createDataFrame([("d1", "maps", "2024-01-30"), ("d1", "chat", "2024-01-30"), ("d2", "none", "2024-01-30")],
                          "user_id string, appname string, etl_dt string").write.partitionBy("etl_dt").parquet(apps)
    dict_file = tmp_path / "apps.tsv"
    dict_file.write_text("maps\ttourism\nchat\t生活\n")  # a tag in the original labels
    app_prof = jobs.dictionary_profile(spark, apps, str(dict_file), str(tmp_path / "app_month"), "2024-01-31",
                                       month="2024-01").collect()
    assert [(r["userid"], r["tourism"], r["lifestyle"]) for r in app_prof] == [("d1", 1, 1)]
    from profilekit.vocab import INTEREST_LABELS
    named = jobs.dictionary_profile(spark, apps, str(dict_file), str(tmp_path / "app_named"), "2024-01-31",
                                    month="2024-01", columns=INTEREST_LABELS).collect()
    assert named[0]["旅游"] == 1 and named[0]["生活"] == 1

    # title scores from the video channel, then the video profile
    scores_file = tmp_path / "titles.txt"
    scores_file.write_text("Big Movie," + ",".join(["60"] * 13) + "\nFilm," + ",".join(["120"] * 13) + "\n")
    scores = str(tmp_path / "scores")
    table = jobs.title_score_table(spark, log, str(scores_file), scores, "2024-01-01", "2024-01-31")
    assert sorted(r["iqytag"] for r in table.collect()) == ["Big Movie", "Film"]
    video = jobs.scored_profile(spark, log, scores, str(tmp_path / "video"), "2024-01-31", month="2024-01",
                                first="2024-01-01", last="2024-01-31").collect()
    assert len(video) == 1 and video[0]["userid"] == IDFA_A
    assert abs(video[0]["entertainment"] - (60 + 120) / 2 / 120) < 1e-12
    assert video[0]["beauty"] == 0.0

    ngram = jobs.title_score_table(spark, log, str(scores_file), str(tmp_path / "scores_ngram"), "2024-01-01",
                                   "2024-01-31", method="ngram")
    assert sorted(map(tuple, ngram.select("yktag", "iqytag").collect())) == \
        sorted(map(tuple, table.select("yktag", "iqytag").collect()))
    per_day = jobs.scored_profile(spark, log, scores, str(tmp_path / "video_days"), "2024-01-31", from_i=1, to_i=3)
    got = {str(r["etl_dt"]): r["entertainment"] for r in per_day.collect()}
    assert got == {"2024-01-30": 60 / 120, "2024-01-29": 120 / 120}

    # id list matched over one-day windows, then its score profile
    ids = tmp_path / "ids.txt"
    ids.write_text(f"{IMEI_A}\n{IMEI_B}\n")
    matched = str(tmp_path / "matched")
    jobs.match_id_list(spark, str(ids), log, matched, "2024-01-31", 1, 1, 2)
    assert spark.read.parquet(matched).count() == 3
    mp = jobs.matched_profile(spark, matched, scores, str(tmp_path / "matched_profile"), "2024-01-31").collect()
    assert [r["imei"] for r in mp] == [IMEI_A]

    # mapping coverage, plain and md5
    mapping = str(tmp_path / "mapping")
    spark.createDataFrame([(IMEI_A, "imei"), (IMEI_A, "imei"), ("x", "idfa")], "idfa_imei string, app_flag string") \
        .write.parquet(mapping)
    cov = {r["imei_match"]: r["idfa_imei"] for r in jobs.mapping_coverage(spark, str(ids), mapping).collect()}
    assert cov == {IMEI_A: IMEI_A, IMEI_B: None}
    users = jobs.mapped_profile_users(spark, month, mapping).collect()
    assert {r["userid"] for r in users} == {_md5(IMEI_A)} and len(users) == 2
    assert set(INTERESTS) <= set(spark.read.parquet(month).columns)


def _log(spark, path, days):
    rows = [(IMEI_A, _md5(IMEI_A), IDFA_A, '{"title":"T"}', 3, d) for d in days]
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").partitionBy("etl_dt").parquet(path)


def _scores(spark, path):
    spark.createDataFrame([('{"title":"T"}', "T", *[60.0] * len(INTERESTS))],
                          f"yktag string, iqytag string, {', '.join(c + ' double' for c in INTERESTS)}").write.parquet(path)


def test_month_profile_covers_its_month_only(spark, tmp_path):
    log, scores = str(tmp_path / "log"), str(tmp_path / "scores")
    _log(spark, log, ["2023-11-30", "2024-02-01"])
    _scores(spark, scores)
    for k, given in enumerate(({}, {"first": "2023-11-01"}, {"last": "2024-02-05"})):
        out = jobs.scored_profile(spark, log, scores, str(tmp_path / f"o{k}"), "2024-01-31", month="2024-01", **given)
        assert out.count() == 0
    out = jobs.scored_profile(spark, log, scores, str(tmp_path / "feb"), "2024-02-28", month="2024-02")
    assert [r["userid"] for r in out.collect()] == [IDFA_A]
    assert jobs.month_days("2024-02")[1].isoformat() == "2024-02-29"


def test_rerun_leaves_no_stale_days(spark, tmp_path):
    log, scores, out = str(tmp_path / "log"), str(tmp_path / "scores"), str(tmp_path / "out")
    _scores(spark, scores)
    _log(spark, log, ["2024-01-29", "2024-01-30"])
    run = lambda: jobs.scored_profile(spark, log, scores, out, "2024-01-31", from_i=1, to_i=4)
    run()
    assert spark.read.parquet(out).count() == 2
    again = str(tmp_path / "log2")
    _log(spark, again, ["2024-01-30"])
    jobs.scored_profile(spark, again, scores, out, "2024-01-31", from_i=1, to_i=4)
    assert [str(r["etl_dt"]) for r in spark.read.parquet(out).collect()] == ["2024-01-30"]


def test_matched_windows_are_replaced(spark, tmp_path):
    log, ids, out = str(tmp_path / "log"), str(tmp_path / "ids.txt"), str(tmp_path / "m")
    (tmp_path / "ids.txt").write_text(IMEI_A + "\n")
    _log(spark, log, ["2024-01-29", "2024-01-30"])
    for _ in range(2):
        jobs.match_id_list(spark, ids, log, out, "2024-01-31", 1, 1, 3)
    assert spark.read.parquet(out).count() == 2


def test_one_sided_day_range(spark):
    from profilekit.operators.extract import extract_payloads
    log = spark.createDataFrame([("u", "p", d) for d in ("2024-01-01", "2024-01-05", "2024-01-09")],
                                "userid string, mediadata string, etl_dt string")
    assert extract_payloads(log, first="2024-01-05").count() == 2
    assert extract_payloads(log, last="2024-01-04").count() == 1


def _published(spark, path):
    return sorted(map(tuple, read_published(spark, path).drop("etl_month").collect()), key=str)


def test_months_from_day_states_equal_whole_months_after_a_late_day(spark, tmp_path):
    """A late day is recomputed alone; the roll-up equals the profile computed from the month's log."""
    import random

    rng = random.Random(2)
    ids = [(f"86000000000{i:04d}", _md5(str(i)), f"IDFA-{i:08d}") for i in range(12)]
    rows = []
    for _ in range(600):
        a, b, c = rng.choice(ids[:1] * 6 + ids)  # one user holds a third
        codes = ",".join(str(rng.choice((10001, 10002, 10003, 10009, 99999))) for _ in range(rng.randrange(3)))
        title = f"t{rng.randrange(9)}"
        rows.append((a, b, c, f'{{"usertag":"{codes}","title":"{title}"}}', rng.choice((3, 4)), f"2024-01-{rng.randrange(1, 31):02d}"))
    late = "2024-01-12"
    log, part = str(tmp_path / "log"), str(tmp_path / "part")
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("etl_dt").parquet(log)
    spark.createDataFrame([r for i, r in enumerate(rows) if r[5] != late or i % 3 == 0], SCHEMA).write.partitionBy("etl_dt").parquet(part)
    scores = str(tmp_path / "scores")
    payloads = sorted({r[3] for r in rows})
    spark.createDataFrame([(p, *[float((len(p) * 7 + j + k) % 50) / 7 for j in range(len(INTERESTS))]) for k, p in enumerate(payloads[::2])],
                          "yktag string, " + ", ".join(f"{i} double" for i in INTERESTS)).write.parquet(scores)
    masks, digests, whole, rolled = (str(tmp_path / n) for n in ("masks", "digests", "whole", "rolled"))
    for base, (from_i, to_i) in ((part, (1, 31)), (log, (19, 20))):  # the whole month, then the late day alone
        staging = str(tmp_path / f"staging{from_i}")
        jobs.extract_staging(spark, base, staging, "2024-01-31", from_i, to_i)
        jobs.coded_day_states(spark, staging, masks, "2024-01-31", from_i, to_i)
        jobs.payload_states(spark, base, digests, "2024-01-31", from_i, to_i)
    jobs.coded_month_from_days(spark, masks, rolled, "2024-01-31", "2024-01")
    jobs.extract_staging(spark, log, str(tmp_path / "staging"), "2024-01-31", 1, 31)
    jobs.coded_profile(spark, str(tmp_path / "staging"), whole, "2024-01-31", month="2024-01")
    assert _published(spark, rolled) == _published(spark, whole) and len(_published(spark, whole)) > 5
    jobs.scored_month_from_days(spark, digests, scores, rolled + "2", "2024-01-31", "2024-01")
    jobs.scored_profile(spark, log, scores, whole + "2", "2024-01-31", month="2024-01")
    assert _published(spark, rolled + "2") == _published(spark, whole + "2") and len(_published(spark, whole + "2")) > 5
    # the roll-up reads states, not the log
    from profilekit.operators.daystates import flags_of_days
    from tests.conftest import plan_text
    plan = plan_text(flags_of_days(read_published(spark, masks), "2024-01-01", "2024-01-31"))
    assert "mediadata" not in plan and "mask" in plan
