"""Join helpers: broadcast only a side whose size has been checked.

A broadcast side is shipped whole to every executor, so it must have a proven
bound. ``bounded_broadcast`` writes the side once, counts its rows (and
optionally a byte measure) on the written copy, and only then hints
``broadcast``; beyond the bound the copy goes to a shuffle join in which the
hot keys of the big side are salted (``salted_join``), and AQE splits any
remaining skewed partitions. The hot keys come from a frequent-items sketch
observed while the big side is written (``write_with_hot_keys``).
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilekit.session import shared_path

# Dictionaries up to this many rows are broadcast.
DEFAULT_MAX_ROWS = 2_000_000
# ... and up to this many bytes of key/value text.
DEFAULT_MAX_BYTES = 256 * 1024 * 1024
# Hashed keys the sketch of hot keys follows in each task (some 100 KB), and the least share it is asked for.
TRACKED = 4096
LEAST_SHARE = 1 / 512
# Types whose equal values have equal hashes.
_HASHED = (T.StringType(), T.BinaryType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DateType())


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: text and binary by their length, numbers as 8, nested values by their JSON text."""
    def of(f: T.StructField) -> Column:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + F.lit(8)
        return F.lit(8)
    return sum((of(f) for f in df.schema.fields), F.lit(0)).cast("long")


def write_measured(df: DataFrame, path: str, byte_measure: Column | None = None) -> tuple[int, int]:
    """Write ``df`` as parquet and return its (rows, bytes), observed during the write.

    All columns are measured unless ``byte_measure`` says otherwise.
    ``DataFrame.observe`` gathers the sums in the same job as the write (from
    the tasks that succeed), so measuring costs no extra pass. Where the write
    gave no observation, the written copy is measured: no size is ever assumed.
    """
    measure = byte_measure if byte_measure is not None else row_bytes(df)
    sums = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(measure), F.lit(0)).alias("b")]
    obs = Observation(f"side-size-{uuid.uuid4().hex}")
    df.observe(obs, *sums).write.mode("errorifexists").parquet(path)
    got = obs.get
    if "n" not in got or "b" not in got:
        got = df.sparkSession.read.parquet(path).agg(*sums).first().asDict()
    return int(got["n"]), int(got["b"])


def bounded_broadcast(df: DataFrame, max_rows: int | None = None,
                      byte_measure: Column | None = None,
                      max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """``(broadcast(side), True)`` if the size check passes, else ``(side, False)``.

    The side is written once to the shared checkpoint folder (a distributed
    write that also cuts its lineage); its rows and bytes are observed during
    that write (no extra pass, no single-task funnel, whatever the size). The
    written copy is what is returned: broadcast when it is within the bounds,
    otherwise for a shuffle join. Either way the side is computed exactly once.
    """
    max_rows = DEFAULT_MAX_ROWS if max_rows is None else max_rows
    max_bytes = DEFAULT_MAX_BYTES if max_bytes is None else max_bytes
    spark = df.sparkSession
    path = shared_path(spark, "join-side")
    rows, nbytes = write_measured(df, path, byte_measure)
    stored = spark.read.parquet(path)
    if rows <= max_rows and nbytes <= max_bytes:
        return F.broadcast(stored), True
    return stored, False


def string_bytes(*cols: str) -> Column:
    """Byte measure of string columns for ``bounded_broadcast``."""
    return sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in cols), F.lit(0))


def hot_keys(df: DataFrame, key: str, fraction: float = 0.01, share: float | None = None,
             seed: int = 17) -> dict:
    """Keys that alone hold at least ``share`` of the rows, with their share, estimated on a sample.

    ``share`` defaults to one shuffle partition's worth (1 / shuffle partitions),
    so at most that many keys can qualify: the result is bounded by construction.
    The estimate only decides where and how much to salt; results do not depend on it.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = share if share is not None else 1.0 / max(parts, 1)
    sample = df.select(key).filter(F.col(key).isNotNull()).sample(fraction=fraction, seed=seed)
    counts = sample.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    # At most 1/share keys can each hold a share of the rows, so the heaviest
    # ceil(1/share) keys contain all candidates; the total is observed in the same job.
    obs = Observation(f"hot-keys-{uuid.uuid4().hex}")
    ranked = counts.observe(obs, F.sum("_n").alias("t")).orderBy(F.desc("_n"))
    top = (ranked.limit(math.ceil(1.0 / share)) if share > 0 else ranked).collect()
    total = obs.get.get("t") or 0
    if total == 0:
        return {}
    return {r[key]: r["_n"] / total for r in top if r["_n"] >= share * total}


def hot_share(spark: SparkSession) -> float:
    """The share of the rows from which a key is salted: one shuffle partition's worth, ``LEAST_SHARE`` at least."""
    return max(1.0 / max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), LEAST_SHARE)


def write_with_hot_keys(df: DataFrame, path: str, key: str) -> dict[int, float]:
    """Write ``df`` as parquet; the hashes of its hot keys with their shares, observed during the write.

    A frequent-items sketch over hashed keys is built in each task and merged
    by the observation, so no job reads the rows again and no key's text
    leaves its task. The sketch follows ``TRACKED`` keys whatever their number;
    a share may be off by about one in a thousand, which changes how much is
    salted, never what is joined. Keys of a smaller share stay whole; AQE
    splits what skew they leave.
    """
    share = hot_share(df.sparkSession)
    obs, name = Observation(f"hot-keys-{uuid.uuid4().hex}"), "`" + key.replace("`", "``") + "`"
    top = min(TRACKED, math.ceil(1.0 / share))
    sums = [F.expr(f"approx_top_k(if({name} is null, null, xxhash64({name})), {top}, {TRACKED})").alias("top"),
            F.count(F.col(name)).alias("n")]
    df.observe(obs, *sums).write.mode("errorifexists").parquet(path)
    got = obs.get
    if "top" not in got or "n" not in got:  # no observation: the copy is asked
        got = df.sparkSession.read.parquet(path).agg(*sums).first().asDict()
    n = got["n"] or 0
    return {r["item"]: min(1.0, r["count"] / n) for r in got["top"] or []
            if n and r["item"] is not None and r["count"] >= share * n}


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str, how: str = "inner",
                buckets: int | None = None, hot: dict | list | None = None, hashed: bool = False) -> DataFrame:
    """Shuffle join where each hot key of ``big`` is spread over several salts.

    A hot key with share ``s`` of the big side gets about ``s * partitions``
    salts (at least 2), so each salt carries roughly one partition's worth;
    ``hot`` may also be a plain list (then every hot key gets ``buckets``), or
    hold the keys' hashes (``hashed``; both key columns are then of one type).
    Rows of ``big`` with a hot key get a deterministic salt (hash of the row,
    so a retried task sends every row to the same place); the ``small`` rows of
    those keys are replicated once per salt of their key; all other keys use
    salt 0. For a left join ``big`` must be the preserved side. Exact: every
    ``big`` row meets each matching ``small`` row exactly once.
    """
    spark = big.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(big, big_key) if hot is None else hot
    if not hot and how in ("inner", "left_semi"):
        # past its bound a side is never broadcast, whatever its files' size suggests
        return big.join(small.hint("merge"), big[big_key] == small[small_key], how)
    if isinstance(hot, dict):
        salts = {k: max(2, min(parts, math.ceil(v * parts))) for k, v in hot.items()}
    else:
        salts = {k: max(2, buckets or parts) for k in hot}
    mark = F.xxhash64 if hashed else F.col
    mark_type = T.LongType() if hashed else big.schema[big_key].dataType
    n_salts = (F.create_map(*[F.lit(x) for kv in salts.items() for x in kv]) if salts else F.create_map())
    n_salts = n_salts.cast(T.MapType(mark_type, T.IntegerType())) if hashed or not salts else n_salts
    # Content hash, not a random number: a retried task salts every row the
    # same way. Exact duplicate rows share a salt; AQE's skew-join split still
    # divides such a partition by map output blocks.
    hashable = [F.col(f.name) for f in big.schema.fields if not isinstance(f.dataType, T.MapType)]
    row_hash = F.xxhash64(*hashable)
    big_n = F.try_element_at(n_salts, mark(big_key))
    # a null key matches nothing, but a left join keeps its rows: spread them over all partitions
    big_s = big.withColumn("_salt", F.when(F.col(big_key).isNull(), F.pmod(row_hash, F.lit(parts)))
                           .when(big_n.isNotNull(), F.pmod(row_hash, big_n)).otherwise(F.lit(0)))
    small_n = F.try_element_at(n_salts, mark(small_key))
    small_salts = F.when(small_n.isNotNull(), F.sequence(F.lit(0), small_n - 1)).otherwise(F.array(F.lit(0)))
    small_s = small.withColumn("_salt_s", F.explode(small_salts))
    cond = (big_s[big_key] == small_s[small_key]) & (big_s["_salt"] == small_s["_salt_s"])
    return big_s.join(small_s.hint("merge"), cond, how).drop("_salt", "_salt_s")


def checked_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str, how: str = "inner",
                 max_rows: int | None = None, byte_measure: Column | None = None,
                 max_bytes: int | None = None) -> DataFrame:
    """Broadcast join when ``small`` passes the size check, else a hot-key-salted shuffle join."""
    side, ok = bounded_broadcast(small, max_rows, byte_measure, max_bytes)
    return join_side(big, side, ok, big_key, small_key, how)


def join_side(big: DataFrame, side: DataFrame, small: bool, big_key: str, small_key: str,
              how: str = "inner") -> DataFrame:
    """Join with a side that ``bounded_broadcast`` has written and judged.

    Beyond the bound ``big`` is written once too and its hot keys are observed
    during that write, so neither side is computed twice. Keys of types that a
    hash may tell apart though they are equal (floating point, collated or
    unlike types) are sampled from the copy instead.
    """
    if small:
        return big.join(side, big[big_key] == side[small_key], how)
    path = shared_path(big.sparkSession, "join-big")
    if big.schema[big_key].dataType == side.schema[small_key].dataType and big.schema[big_key].dataType in _HASHED:
        hot = write_with_hot_keys(big, path, big_key)
        return salted_join(big.sparkSession.read.parquet(path), side, big_key, small_key, how, hot=hot, hashed=True)
    big.write.parquet(path)
    return salted_join(big.sparkSession.read.parquet(path), side, big_key, small_key, how)
