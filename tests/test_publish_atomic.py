"""Publishing is all or nothing: broken off anywhere, readers see the old table or the new one."""

import importlib

import pytest
from pyspark.sql import functions as F

from profilekit.sources.publish import publish, read_published
from tests.conftest import rows

P = importlib.import_module("profilekit.sources.publish")
SCHEMA = "user string, n long, day string"


def frame(spark, days, n):
    return spark.createDataFrame([(f"u{i}", n, d) for d in days for i in range(5)], SCHEMA).repartition(3)


def table(spark, path):
    return rows(read_published(spark, path, frame(spark, [], 0).schema))


class Broken(Exception):
    pass


def break_at(monkeypatch, name, k):
    """The k-th call of a folder's method fails, and all after it (the process is gone)."""
    calls = [0]
    whole = getattr(P._Folder, name)

    def broken(self, *args):
        calls[0] += 1
        if calls[0] >= k:
            raise Broken
        return whole(self, *args)
    monkeypatch.setattr(P._Folder, name, broken)


@pytest.mark.parametrize("step,k", [("write", 1), ("move", 1), ("move", 2), ("move", 3), ("move", 4), ("delete", 1), ("delete", 2), ("delete", 4)])
@pytest.mark.parametrize("partition", ["day", None])
def test_broken_off_at_any_step(spark, tmp_path, monkeypatch, step, k, partition):
    path = str(tmp_path / "t")
    old = frame(spark, ["2024-01-01", "2024-01-02", "2024-01-03"], 1)
    new = frame(spark, ["2024-01-02", "2024-01-04"], 2)
    publish(old, path, partition_col=partition)
    before = table(spark, path)
    with monkeypatch.context() as m:
        break_at(m, step, k)
        with pytest.raises(Broken):
            publish(new, path, partition_col=partition, covered=["2024-01-02", "2024-01-03", "2024-01-04"])
    committed = any(n.name.startswith(P.JOURNAL) for n in (tmp_path / "t").iterdir())
    keep = old.filter("day = '2024-01-01'") if partition else old.limit(0)
    after = rows(keep.unionByName(new).select("user", "n", "day"))
    assert committed == (step == "delete" or (step == "move" and k > 1))
    assert table(spark, path) == (after if committed else before)
    assert table(spark, path) == rows(spark.read.schema(old.schema).parquet(path))  # the files themselves are settled by now
    publish(new, path, partition_col=partition, covered=["2024-01-02", "2024-01-03", "2024-01-04"])
    assert table(spark, path) == after
    assert not [n for n in (tmp_path / "t").iterdir() if n.name.startswith(P.JOURNAL)]


def test_rows_are_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    df = frame(spark, ["2024-01-01", "2024-01-02"], 1).mapInPandas(count, SCHEMA)
    path = str(tmp_path / "t")
    publish(frame(spark, ["2024-01-01", "2024-01-03"], 0), path, partition_col="day")
    publish(df, path, partition_col="day", covered=["2024-01-01", "2024-01-02", "2024-01-03"])
    assert seen.value == 10
    assert {r[2] for r in table(spark, path)} == {"2024-01-01", "2024-01-02"}


def test_a_failing_job_leaves_the_old_table_and_no_stage(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(frame(spark, ["2024-01-01"], 1), path, partition_col="day")
    bad = frame(spark, ["2024-01-01"], 2).withColumn("n", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception):
        publish(bad, path, partition_col="day")
    assert {r[1] for r in table(spark, path)} == {1}
    assert [n.name for n in (tmp_path / "t").iterdir() if n.name.startswith(P.STAGE)] == []


def test_a_table_published_over_itself(spark, tmp_path):
    """The stage is written before anything goes, so a table may be read while it is replaced."""
    path = str(tmp_path / "t")
    publish(frame(spark, ["2024-01-01", "2024-01-02"], 1), path, partition_col="day")
    again = read_published(spark, path, frame(spark, [], 0).schema).withColumn("n", F.col("n") + 1)
    publish(again, path, partition_col="day")
    assert {r[1] for r in table(spark, path)} == {2} and len(table(spark, path)) == 10
