"""First-match substring dictionary lookup (a theta join).

For each distinct text: the dictionary key of smallest ``priority`` (file order)
that occurs in the text as a substring; texts without any key are dropped.

``text contains key`` cannot be hashed, so two exact forms are offered, neither
of which forms text x key pairs:

- ``automaton`` (default): the key list is compiled once per Python worker into
  an Aho-Corasick automaton and every text is scanned once, in time linear in the
  text length plus matches, independent of the number of keys. Spark
  scans the texts where they lie, once, and only the matches are deduplicated;
  the key list is shipped only after its size is checked. A larger list never
  leaves the executors: tasks write it as shards of compact tries to the shared
  folder, workers map them, and the texts are scanned once as before (``keytrie``).
- ``ngram``: for title-sized texts; every substring whose length is a key
  length is exploded and equi-joined with the keys (hash join). The text is
  split into characters once and each gram is a slice, so a text of length L
  costs L x n per key length n; all key lengths are generated in one pass and
  joined once. The exploded rows make it a form for short texts.

Among keys of equal priority the smallest key wins, in every form. Empty keys
are dropped on load (an empty key would match every text).
"""

from __future__ import annotations

import uuid

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilekit.operators import keytrie
from profilekit.operators.joins import bounded_broadcast, join_side, string_bytes, write_measured
from profilekit.session import shared_path

# Bounds of one automaton: a trie node takes tens of bytes in the Python
# worker, so 16 MB of key text stay around a gigabyte at worst.
MAX_KEYS = 200_000
MAX_KEY_BYTES = 16 * 1024 * 1024

_MATCH_SCHEMA = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("priority", T.LongType()),
])


def clean_keys(dictionary: DataFrame, key_col: str, priority_col: str) -> DataFrame:
    """``(key, priority)``: non-empty keys, a repeated key at its first position."""
    return (dictionary
            .select(F.col(key_col).cast("string").alias("key"),
                    F.col(priority_col).cast("long").alias("priority"))
            .filter(F.col("key").isNotNull() & (F.length("key") > 0))
            .groupBy("key").agg(F.min("priority").alias("priority")))


_AUTOMATA: dict = {}


def _scan_with_automaton(texts: DataFrame, keys: list[tuple[str, int]]) -> DataFrame:
    """Per-task Aho-Corasick scan: ``(text, key, priority)`` of the best key per text."""
    shipped = texts.sparkSession.sparkContext.broadcast(keys)
    token = uuid.uuid4().hex

    def scan(batches):
        # Python workers are reused across tasks: build each automaton once per
        # worker process (at most two kept), not once per task
        if token not in _AUTOMATA:
            auto = ahocorasick.Automaton()
            for key, pri in shipped.value:
                auto.add_word(key, (pri, key))
            auto.make_automaton()
            while len(_AUTOMATA) >= 2:
                _AUTOMATA.pop(next(iter(_AUTOMATA)))
            _AUTOMATA[token] = auto, min((pri, key) for key, pri in shipped.value)
        auto, best_possible = _AUTOMATA[token]

        def best_of(text):
            best = None
            for _, found in auto.iter(text):
                if best is None or found < best:
                    best = found
                    if best == best_possible:
                        break
            return best

        for pdf in batches:
            found = [(t, best_of(t)) for t in pdf["text"] if t is not None]
            found = [(t, key, pri) for t, best in found if best is not None for pri, key in [best]]
            if found:
                yield pd.DataFrame(found, columns=["text", "key", "priority"])

    return texts.select("text").mapInPandas(scan, _MATCH_SCHEMA)


def _automaton(texts: DataFrame, keys: DataFrame) -> DataFrame:
    # the key list is written once to the shared folder and its size observed there
    spark = texts.sparkSession
    path = shared_path(spark, "match-keys")
    rows, nbytes = write_measured(keys, path, string_bytes("key"))
    stored = spark.read.parquet(path)
    if rows == 0:
        return spark.createDataFrame([], _MATCH_SCHEMA)
    if rows > MAX_KEYS or nbytes > MAX_KEY_BYTES:
        return _sharded(texts, stored, nbytes)
    found = _scan_with_automaton(texts, [(r["key"], r["priority"]) for r in stored.collect()])
    # texts were scanned where they lie; repeated texts give repeated rows
    return found.distinct()


def _sharded(texts: DataFrame, keys: DataFrame, nbytes: int) -> DataFrame:
    """A key list beyond one automaton: shards of it as mapped tries, every text scanned once where it lies.

    No key passes the driver; the manifest has one row per shard.
    """
    spark = texts.sparkSession
    shards = max(1, -(-nbytes // keytrie.SHARD_BYTES))
    path = shared_path(spark, "key-shards")
    keytrie.write_shards(keys, shards, shared_path(spark, "key-tries")).write.parquet(path)
    manifest = [tuple(r) for r in spark.read.parquet(path).collect()]
    return keytrie.scan_texts(texts, manifest).distinct()


def _grams_of_length(chars, text_len):
    # transform() reads a two-parameter lambda as (element, index): keep exactly one each.
    def for_length(n):
        starts = F.when(text_len >= n, F.sequence(F.lit(1), text_len - n + 1)).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(chars, i, n), ""))
    return for_length


def _ngram(texts: DataFrame, keys: DataFrame) -> DataFrame:
    side, small = bounded_broadcast(keys.withColumnRenamed("key", "_key"), byte_measure=string_bytes("_key"))
    # one row per distinct key length: a handful of values
    lengths = sorted(r["n"] for r in side.select(F.length("_key").alias("n")).distinct().collect())
    if not lengths:
        return texts.sparkSession.createDataFrame([], _MATCH_SCHEMA)
    # the text is split into characters once; every gram of every key length is
    # a slice of that array (a text of length L costs L * n per length n), and
    # all lengths are generated in one pass and joined with the keys once
    chars, text_len = F.col("_chars"), F.length(F.col("text"))
    per_length = F.transform(F.array(*[F.lit(n) for n in lengths]), _grams_of_length(chars, text_len))
    grams = (texts.select("text", F.split(F.col("text"), "", -1).alias("_chars"))
             .select("text", F.explode(F.array_distinct(F.flatten(per_length))).alias("key")))
    hits = join_side(grams, side, small, "key", "_key")
    return (hits.groupBy("text")
            .agg(F.min(F.struct("priority", "key")).alias("_b"))
            .select("text", "_b.key", "_b.priority"))


METHODS = {"automaton": _automaton, "ngram": _ngram}


def first_key_match(texts: DataFrame, text_col: str, dictionary: DataFrame, key_col: str,
                    priority_col: str, method: str = "automaton") -> DataFrame:
    """``(text, key, priority)`` for every distinct text that contains a key.

    The automaton scans texts where they lie (no shuffle of the texts) and
    deduplicates only the matches; the other forms deduplicate texts first.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; one of {sorted(METHODS)}")
    present = texts.select(F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    if method != "automaton":
        present = present.distinct()
    keys = clean_keys(dictionary, key_col, priority_col)
    return METHODS[method](present, keys)
