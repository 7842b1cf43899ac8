"""Importance resampling: documents drawn by how much their word runs look like a target table's.

Every run of one to three consecutive words falls into one of ``BUCKETS`` by
its crc32. Two scans of the documents do the work, both as arrays inside tasks:
the first counts the buckets of the corpus and of the target, the second adds
up a document's bucket gains (a table of fixed size) and perturbs the sum by
noise that depends on its id alone. Scores are persisted. The cutoff of the
draw is then found by bisection: exact count jobs over the persisted scores,
each of which halves the range four times, first on the score, then, among the
documents of that score, on the tied doc_id. The selected rows are
range-partitioned in drawing order and numbered.

Defined results: a null text has no words; a null doc_id has the noise of an
empty id and comes last among ties; repeated rows each count, and each get
a rank of their own; an empty table gives no rows. Only doc_id and text are
read, so other columns may have any name.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilekit.llm.components import written
from profilekit.llm.text import claim, col, crc32_sql, map_texts, slices
from profilekit.operators.ranking import global_index

BUCKETS = 10_000
WIDTHS = (1, 2, 3)
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
CUTS = 15  # values counted by one bisection job: four halvings

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

# crc32 of a byte string is the xor of one value per byte, which depends on the byte and on
# how many bytes follow it, and of one value per length: so words are hashed as arrays.
_SHORT = 48  # longer words go through zlib one by one


def _linear() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value by bytes that follow and byte, value by length, a shifted value by bytes that follow and its four bytes)."""
    zeros = np.array([zlib.crc32(bytes(n)) for n in range(4 * _SHORT)], np.uint32)
    value = np.empty((_SHORT + 1, 256), np.uint32)
    value[0] = [zlib.crc32(bytes([b])) ^ int(zeros[1]) for b in range(256)]
    shift = np.empty((_SHORT + 2, 4, 256), np.uint32)
    for k in range(4):
        shift[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    step = value[0]  # a zero byte appended: the register's low byte leaves through the table
    for n in range(1, _SHORT + 2):
        x = shift[n - 1]
        shift[n] = (x >> np.uint32(8)) ^ step[x & np.uint32(255)]
    for n in range(1, _SHORT + 1):
        x = value[n - 1]
        value[n] = (x >> np.uint32(8)) ^ step[x & np.uint32(255)]
    return value, zeros, shift


_VALUE, _ZEROS, _SHIFT = _linear()


def _shifted(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each value as it is with ``n`` more bytes behind it (before those are added)."""
    out = _SHIFT[n, 0, x & np.uint32(255)]
    for k in (1, 2, 3):
        out ^= _SHIFT[n, k, (x >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def buckets_of(text: bytes | None) -> tuple[int, np.ndarray]:
    """(words, bucket of every run of one to three consecutive words) of a text."""
    data = _LOWER[np.frombuffer(text or b"", np.uint8)]
    edges = np.flatnonzero(np.diff(_WORD[data].view(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return 0, np.empty(0, np.uint32)
    sizes = ends - starts
    short = sizes <= _SHORT
    # xor of the bytes of every short word (bytes of no short word count as nothing)
    word = np.repeat(np.arange(len(starts)), sizes)
    at = np.flatnonzero(_WORD[data])
    behind = np.minimum(ends[word] - 1 - at, _SHORT)
    part = np.bitwise_xor.reduceat(_VALUE[behind, data[at]], np.concatenate(([0], np.cumsum(sizes)[:-1])))
    sizes_in = np.minimum(sizes, _SHORT)
    space = _VALUE[0, 32]
    out = []
    linear, total, clean = part, sizes, short
    for width in WIDTHS:
        n = len(starts) - width + 1
        if n <= 0:
            break
        if width > 1:  # one more word behind, parted by a space
            nxt, last = sizes_in[width - 1:], part[width - 1:]
            linear = _shifted(linear[:n], nxt + 1) ^ _shifted(np.full(n, space), nxt) ^ last
            total, clean = total[:n] + sizes[width - 1:] + 1, clean[:n] & short[width - 1:]
        crc = linear ^ _ZEROS[np.where(clean, total, 0)]
        for i in np.flatnonzero(~clean):  # a run that holds a long word
            crc[i] = zlib.crc32(b" ".join(data[starts[j]:ends[j]].tobytes() for j in range(i, i + width)))
        out.append(crc % np.uint32(BUCKETS))
    return len(starts), np.concatenate(out)


def bucket_counts(df: DataFrame, text: str = "text") -> np.ndarray:
    """Features per bucket over the whole table (an array of ``BUCKETS`` longs; summed in tasks, then by bucket)."""
    src = df.select(col(text).cast("string").cast("binary").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(__name__)
        total = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, 0):
            for t in batch.column(0).to_pylist():
                total += np.bincount(buckets_of(t)[1], minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["b", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in src.mapInArrow(count, "b int, n long").groupBy("b").agg(F.sum("n").alias("n")).collect():
        out[r.b] = r.n
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole gain of every bucket: 1000 times the log ratio of its smoothed shares, rounded down."""
    s_all, t_all = float(docs.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + BUCKETS) / ((float(s) + 1) * (t_all + BUCKETS))))
                     for s, t in zip(docs, target, strict=True)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, text: str = "text", keep: tuple = ("doc_id",)) -> DataFrame:
    """``keep`` plus n_words, n_features, weight of every row."""
    def make():
        def fn(texts: list) -> list:
            found = [buckets_of(t) for t in texts]
            return [[n for n, _ in found], [len(b) for _, b in found], [int(gain[b].sum()) for _, b in found]]
        return fn
    return map_texts(docs, make, [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")],
                     text=text, keep=keep)


def _cutoff(rows: DataFrame, value: str, low: int, high: int, wanted: int) -> tuple[int, int]:
    """(v, rows above v): the largest v in [low, high] with at least ``wanted`` rows of ``value`` >= v, by exact counts."""
    above = 0  # rows with value > high
    while low < high:
        span = high - low
        tries = sorted({low + max(1, span * (k + 1) // (CUTS + 1)) for k in range(CUTS)} | {high})
        got = rows.agg(*[F.count(F.when(F.col(value) >= v, 1)).alias(f"n{i}") for i, v in enumerate(tries)]).first()
        for i, v in enumerate(tries):
            if got[i] < wanted:
                high, above = v - 1, got[i]
                break
            low = v
    return low, above


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             seed: int = SEED, id_col: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null where it is not drawn."""
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    doc_id = F.col("doc_id")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8),
               16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    found = weights(docs.select(col(id_col).cast("long").alias("doc_id"), col(text).alias("text")), gain)
    drawable = F.col("n_words") >= least_words
    scored, seen = written(
        found.select("doc_id", "n_features", "weight", (F.col("weight") + noise).cast("long").alias("score"),
                     drawable.alias("drawable"), F.monotonically_increasing_id().alias("row")),
        "importance", F.count(F.when(F.col("drawable"), 1)).alias("n"),
        F.min(F.when(F.col("drawable"), F.col("score"))).alias("low"),
        F.max(F.when(F.col("drawable"), F.col("score"))).alias("high"))
    result = ["doc_id", "n_features", "weight", "score"]
    wanted = percent * (seen.get("n") or 0) // 100
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select(*result, none)
    pool = scored.filter("drawable")
    cut, above = _cutoff(pool, "score", seen["low"], seen["high"], wanted)
    # of the documents at the cutoff the smallest ids go in: bisect on the inverted id (null: last of all)
    order = F.coalesce(F.bitwise_not(doc_id), F.lit(-(1 << 63))).alias("order")
    tied = pool.filter(F.col("score") == cut).select(order)
    ends = tied.agg(F.min("order").alias("low"), F.max("order").alias("high")).first()
    last, _ = _cutoff(tied, "order", ends.low, ends.high, wanted - above)
    drawn = F.col("drawable") & ((F.col("score") > cut) | ((F.col("score") == cut) & (order >= last)))
    # every row is unique in this order; rows of one id beyond the number wanted get no rank
    first = scored.filter(drawn).select("*", (-F.col("score")).alias("down"), F.bitwise_not(order).alias("up"))
    ranked = global_index(first, ["down", "up", "row"], "rank")
    rank = F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank")
    return scored.filter(~drawn).select(*result, none).unionByName(ranked.select(*result, rank))


def resample_sql() -> str:
    """DuckDB SQL of the resampling."""
    words = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', 0)")
    runs = " UNION ALL ".join(
        f"SELECT src, r, array_to_string(words[i:i + {n - 1}], ' ') AS f FROM (SELECT src, r, words, unnest(range(1, len(words) - {n - 2})) AS i FROM worded)"
        for n in WIDTHS)
    return f"""
WITH worded AS (
    SELECT 'd' AS src, row_number() OVER () AS r, doc_id, {words} AS words FROM documents
    UNION ALL SELECT 'b', row_number() OVER (), NULL, {words} FROM benchmark),
runs AS ({runs}),
buckets AS (SELECT f, {crc32_sql('f')} % {BUCKETS} AS b FROM (SELECT DISTINCT f FROM runs)),
counts AS (SELECT b, count(*) FILTER (src = 'd') AS s, count(*) FILTER (src = 'b') AS t FROM runs JOIN buckets USING (f) GROUP BY b),
gains AS (SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {BUCKETS})::DOUBLE
    / ((s + 1)::DOUBLE * (sum(t) OVER () + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM counts),
weighed AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM runs JOIN buckets USING (f) JOIN gains USING (b)
    WHERE src = 'd' GROUP BY r),
scored AS (SELECT r, doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
    / 4294967296.0::DOUBLE)))::BIGINT AS score FROM worded LEFT JOIN weighed USING (r) WHERE src = 'd'),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n
    FROM scored WHERE n_words >= {LEAST_WORDS})
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (r)"""
