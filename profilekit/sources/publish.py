"""Publishing profiles as parquet datasets.

Modes:

- ``overwrite`` (default): with a partition column, only the partitions present
  in the data are replaced (dynamic partition overwrite), so re-running a day
  or a month gives the same table instead of duplicated rows; with ``covered``
  days that have become empty are emptied too.
- ``append``: adds rows; re-running adds them again (the original behaviour).
- ``create``: fails if the target exists.

Every publish is all or nothing. The rows are computed once, into a staging folder
inside the target that readers skip. Its listing gives the files that
come and, with the partitions it holds, the files that go. Renaming a journal
with both lists into place is the commit; then the files are moved and the old
ones removed. Each of these steps can be repeated, by several at once: a publish
that died before the commit leaves the old table, one that died after it is
finished by the next ``publish`` or ``read_published``. A target has one writer
at a time, as with any Spark overwrite.

Writes go by column name: the target schema order is applied with ``select``.
Overwrites are rebalanced (AQE splits a day holding a third of all rows over
many tasks and merges small days).
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("overwrite", "append", "create")
# Names inside a target that begin like these are not data (as for Spark's readers).
HIDDEN = ("_", ".")
STAGE, JOURNAL = "_stage-", "_journal-"


class _Folder:
    """The target's folder on its file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.root = path.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.at("").getFileSystem(self._conf)

    def at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str = "") -> list[tuple[str, bool]]:
        """(name, is a folder) of what lies in a folder; nothing if it does not exist."""
        return [(s.getPath().getName(), s.isDirectory()) for s in self.fs.listStatus(self.at(name))] if self.exists(name) else []

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self.at(name))

    def files(self, name: str = "") -> Iterator[str]:
        """Data files at or below a folder, relative to it."""
        for part, is_folder in self.names(name):
            if not part.startswith(HIDDEN):
                if is_folder:
                    yield from (f"{part}/{f}" for f in self.files(f"{name}/{part}" if name else part))
                else:
                    yield part

    def move(self, name: str, to: str) -> None:
        """Rename, if it is still there."""
        if self.exists(name):
            self.fs.mkdirs(self.at(to).getParent())
            if not self.fs.rename(self.at(name), self.at(to)) and self.exists(name):
                raise OSError(f"cannot move {self.root}/{name}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.at(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        spark_io = self.fs.open(self.at(name))
        try:
            return bytes(spark_io.readAllBytes()).decode()
        finally:
            spark_io.close()


def _commit(folder: _Folder, run: str, come: list[str], go: list[str]) -> None:
    """From the rename on, the publish holds."""
    folder.write(f"{STAGE}{run}/_journal", json.dumps({"come": come, "go": go}))
    folder.move(f"{STAGE}{run}/_journal", f"{JOURNAL}{run}")


def _finish(folder: _Folder, run: str) -> None:
    """Carry out a journal; every step may have been done before."""
    try:
        journal = json.loads(folder.read(f"{JOURNAL}{run}"))
    except Exception:
        if folder.exists(f"{JOURNAL}{run}"):
            raise
        return  # another reader has finished it
    for name in journal["come"]:
        folder.move(f"{STAGE}{run}/{name}", name)
    for name in journal["go"]:
        folder.delete(name)
    folder.delete(f"{STAGE}{run}")
    folder.delete(f"{JOURNAL}{run}")


def recover(spark: SparkSession, path: str) -> None:
    """Finish the publishes of ``path`` that were committed and broke off."""
    folder = _Folder(spark, path)
    for name, _ in sorted(folder.names()):
        if name.startswith(JOURNAL):
            _finish(folder, name[len(JOURNAL):])


def publish(df: DataFrame, path: str, mode: str = "overwrite", partition_col: str | None = None,
            partition_value: str | _dt.date | None = None, columns: Sequence[str] | None = None,
            max_records_per_file: int | None = None, balance_files: bool = True,
            covered: Sequence[str] | None = None) -> None:
    """Write ``df`` to ``path``, all or nothing; ``df`` is computed once.

    ``partition_value`` stamps a static partition (``etl_month='2024-01'``);
    without it an existing ``partition_col`` column gives dynamic partitions
    (every day of a per-day profile in one pass). With ``balance_files`` the
    rows of an overwrite are rebalanced, by partition where there are several (one
    shuffle of the output): AQE splits a hot day over several tasks and
    merges small days, so each day gets a few files of the advisory size
    instead of one file per task and day. ``covered`` names the partition
    values the run stands for: those that exist at ``path`` and have no row in
    ``df`` any more are emptied, so that a re-run leaves no stale rows.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {sorted(MODES)}")
    spark = df.sparkSession
    folder = _Folder(spark, path)
    if mode == "create" and folder.exists():
        raise FileExistsError(f"{path} exists")
    recover(spark, path)
    out = df
    if partition_col and partition_value is not None:
        out = out.withColumn(partition_col, F.lit(str(partition_value)))
    if columns is not None:
        out = out.select(*columns)
    if partition_col and balance_files:
        out = out.hint("rebalance", partition_col) if partition_value is None else out.hint("rebalance")
    run = uuid.uuid4().hex
    stage = f"{folder.root}/{STAGE}{run}"
    writer = out.write
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_col:
        writer = writer.partitionBy(partition_col)
    try:
        writer.parquet(stage)
        go = []
        if mode == "overwrite" and partition_col:
            staged = {name for name, is_folder in folder.names(f"{STAGE}{run}") if is_folder and not name.startswith(HIDDEN)}
            there = {name for name, is_folder in folder.names() if is_folder and not name.startswith(HIDDEN)}
            stale = {f"{partition_col}={v}" for v in covered or ()} & there - staged
            for name in sorted(stale):  # an empty file keeps the partition and the schema
                spark.createDataFrame([], out.drop(partition_col).schema).write.parquet(f"{stage}/{name}")
            go = [f"{name}/{f}" for name in sorted(staged & there | stale) for f in folder.files(name)]
        elif mode == "overwrite":
            go = list(folder.files())
        _commit(folder, run, list(folder.files(f"{STAGE}{run}")), go)
    except BaseException:
        if not folder.exists(f"{JOURNAL}{run}"):
            folder.delete(f"{STAGE}{run}")
        raise
    _finish(folder, run)


def read_published(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   partition_col: str | None = None,
                   partitions: Sequence[str] | None = None) -> DataFrame:
    """Read a published dataset, a committed publish that broke off finished first; partition values stay text when a schema is given.

    ``partitions`` selects partition values; the filter prunes folders.
    """
    recover(spark, path)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    if partition_col and partitions is not None:
        df = df.filter(F.col(partition_col).isin(list(partitions)))
    return df


def with_partition_schema(df: DataFrame, partition_col: str) -> T.StructType:
    """Schema of ``df`` plus a text partition column (for ``read_published``)."""
    fields = [f for f in df.schema.fields if f.name != partition_col]
    return T.StructType(fields + [T.StructField(partition_col, T.StringType())])
