"""Shared helpers: run a per-batch function over a text column, cached word codes, record digests."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import re
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Entries a per-worker cache may hold before it starts anew; bounds memory, never results.
CACHE_ENTRIES = 400_000

# Text a function is given at once; bounds memory, never results.
SLICE_BYTES = 3_000_000

# Text that Spark puts into one Arrow batch of a text column; bounds memory on both sides, never results.
BATCH_BYTES = 8_000_000

TextFunction = Callable[[list], Sequence]


# Caches that live in a worker between tasks, and the operator they were filled for.
_WORKER_CACHES: list[dict] = []
_OWNER = [""]


def worker_cache(cache: dict) -> dict:
    """Register a cache that outlives a task."""
    _WORKER_CACHES.append(cache)
    return cache


def _trim() -> None:
    """Give freed memory back to the system where the C library can (glibc)."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def claim(owner: str) -> None:
    """Called as a task starts: another operator's caches are emptied, so that they do not add up in a worker."""
    if _OWNER[0] != owner:
        _OWNER[0] = owner
        for cache in _WORKER_CACHES:
            cache.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _trim()


def trimmed(run: Callable) -> Callable:
    """A task's function over batches that gives its freed memory back when it ends: workers outlive tasks."""
    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            _trim()
    return task


class BoundedCache(dict):
    """Memo of a pure function; emptied when full, so a worker's memory stays bounded."""

    def __init__(self, make: Callable, entries: int = CACHE_ENTRIES):
        super().__init__()
        self._make, self._entries = make, entries

    def __missing__(self, key):
        if len(self) >= self._entries:
            self.clear()
        value = self[key] = self._make(key)
        return value


def col(name: str) -> Column:
    """A column by its literal name (dots and spaces are not paths)."""
    return F.col("`" + name.replace("`", "``") + "`")


def crc_mod(name: str, n: int) -> Column:
    """crc32 of a column's text form, modulo ``n``; null for a null value."""
    return F.pmod(F.crc32(col(name).cast("string").cast("binary")), F.lit(n))


def fresh(prefix: str) -> str:
    """A column name no input uses."""
    return f"_{prefix}_{uuid.uuid4().hex[:12]}"


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``most`` bytes of the text column (at least one row each)."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def batches_of(df: DataFrame, most: int = BATCH_BYTES) -> None:
    """From now on the session's Arrow batches hold about ``most`` bytes (Spark's own bound is 64 MB, or 10,000 rows)."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def map_texts(df: DataFrame, make: Callable[[], TextFunction], fields: list[T.StructField], *,
              text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``fields``, computed from the UTF-8 bytes of ``text`` batch by batch.

    ``make()`` runs once per task and returns a function from a list of
    ``bytes | None`` to one sequence per field. Kept columns pass through as
    Arrow arrays untouched. Nothing but ``keep`` and ``text`` is read.
    """
    batches_of(df)
    # plain names on the way: kept names may hold dots or spaces
    kept = [col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    n_keep = len(kept)
    # a kept text column is read where it is, not sent twice
    at = list(keep).index(text) if text in keep and isinstance(df.schema[text].dataType, T.StringType) else n_keep
    src = df.select(*kept, *([] if at < n_keep else [col(text).cast("string").cast("binary").alias("text")]))
    made_fields = [T.StructField(f"f{i}", f.dataType) for i, f in enumerate(fields)]
    schema = T.StructType([*src.schema.fields[:n_keep], *made_fields])
    arrow_types = [to_arrow_type(f.dataType) for f in fields]
    names = [f.name for f in schema.fields]

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(make.__module__)
        fn = make()
        for batch in slices(batches, at):
            made = fn(batch.column(at).cast(pa.binary()).to_pylist())
            arrays = [batch.column(i) for i in range(n_keep)]
            arrays += [x if isinstance(x, pa.Array) else pa.array(x, type=t)
                       for x, t in zip(made, arrow_types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return src.mapInArrow(run, schema).toDF(*keep, *[f.name for f in fields])


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijective scramble (splitmix finaliser), wrapping."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-sensitive combination of two hash arrays."""
    with np.errstate(over="ignore"):
        return mix(a * _GOLDEN + np.uint64(0x632BE59BD9B4E019)) + mix(b + _GOLDEN)


# White space that parts words, and a random number per byte (A-Z as a-z).
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
BYTE_CODES[65:91] = BYTE_CODES[97:123]
_BASE = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_BLOCK_BYTES = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = max(n, 2 * len(_POWERS[0]))
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def span_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of a byte array (A-Z hashed as a-z): a polynomial in random byte values, scrambled."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * up[:len(data)], out=sums[1:])
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _GOLDEN)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words between ASCII white space."""
    edges = np.flatnonzero(np.diff(SPACE[data].view(np.int8), prepend=1, append=1))
    return edges[::2], edges[1::2]


def blocks(text: bytes) -> Iterator[bytes]:
    """The text in blocks of about a megabyte, cut at white space."""
    at = 0
    while at < len(text):
        stop = at + _BLOCK_BYTES
        if stop < len(text):
            m = _NEXT_SPACE.search(text, stop)
            stop = m.start() if m else len(text)
        yield text[at:stop]
        at = stop


_NEXT_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_codes(text: bytes | None) -> np.ndarray:
    """64-bit hash of each word ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z lower-cased; empty for null."""
    parts = []
    for block in blocks(text or b""):
        data = np.frombuffer(block, np.uint8)
        parts.append(span_codes(data, *word_spans(data)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint64)


def window_codes(codes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive codes (empty if there are fewer)."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = codes[:n]
    for k in range(1, width):
        out = chain(out, codes[k:k + n])
    return out


def crc32(data) -> int:
    """Unsigned crc32 of a bytes-like value."""
    return zlib.crc32(data) & 0xFFFFFFFF


def crc32_sql(text: str) -> str:
    """DuckDB SQL of the unsigned crc32 of a string's UTF-8 bytes, nibble by nibble (the low one of a byte first)."""
    table = []
    for x in range(16):
        for _ in range(4):
            x = (x >> 1) ^ (0xEDB88320 if x & 1 else 0)
        table.append(x)
    nibbles = (f"list_transform(range(0, 2 * octet_length(encode({text}))), lambda k: "
               f"strpos('0123456789ABCDEF', substr(hex(encode({text})), 2 * (k // 2) + 2 - k % 2, 1)) - 1)")
    step = f"lambda c, x: xor(c >> 4, list_extract({table}, (1 + (xor(c, x) & 15))::BIGINT)::BIGINT)"
    return f"xor(list_reduce({nibbles}, {step}, 4294967295::BIGINT), 4294967295)"
