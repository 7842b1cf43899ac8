"""Operator 1: texts scored by a deleted-interpolation bigram model learnt from the corpus.

A token's probability mixes the maximum-likelihood estimates of its bigram and
its word with a uniform share; the weights depend on how often the context was
seen (one bucket per doubling) and are learnt by expectation-maximisation on
deleted counts: each training token is predicted from all the others, its own
occurrence taken out of every count.

Plan. Texts are cut into chunks of some million tokens, each kept as one row
of numbered words. Every chunk's distinct words and bigrams go, as sorted
64-bit keys with their training counts, to key ranges (more ranges for more
tokens); a range adds its chunks' counts and sends each chunk the totals of
its own keys. So what is shuffled is distinct n-grams per chunk, not tokens,
and a word that makes up a third of the corpus is one key per chunk. Chunks
are rejoined with their totals once and written; weights are learnt from a
histogram over all training tokens (its grid is bounded), then all texts are
scored from the written chunks.

Tokens: A-Z lower-cased words between ASCII white space, then one end token.
Cases: null and empty text are the end token alone. Very long texts are whole.
Repeated rows count and are scored each. A null id is not held out and trains.
Without training texts every token is unknown and the uniform share is all.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilekit.llm.components import written
from profilekit.llm.text import batches_of, chain, claim, col, crc_mod, mix, slices, word_codes
from profilekit.session import shuffles_freed

CHUNK_BYTES = 12_000_000      # text of one chunk
RANGE_TOKENS = 1_000_000      # tokens per key range
SPAN = 1 << 19                # tokens whose estimates are held at once
LEAST_RANGES = 64
EM_ROUNDS = 40
STEPS = 2                     # histogram cells per doubling of an estimate
END, START = mix(np.asarray([1, 2], np.uint64))  # no word hashes to them but by chance
_CELLS = 1 << 8               # cells of one estimate; bounds the histogram's grid

_CHUNKS = ("chunk long, doc_ids array<long>, held array<boolean>, sizes array<int>, types binary, tokens binary, "
           "n_tokens long, train_tokens long, train_docs long")


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents never learnt from."""
    return F.coalesce(crc_mod(doc_id, 7) == 2, F.lit(False))


def _pack(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 3)


def _unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each run (every run has at least the end token)."""
    return np.add.reduceat(values, np.cumsum(sizes) - sizes) if len(sizes) else np.empty(0)


def chunks(docs: DataFrame, held: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of numbered tokens: distinct word codes (ascending), and each token's place among them."""
    src = docs.select(col(doc_id).cast("long").alias("d"), held.alias("h"),
                      col(text).cast("string").cast("binary").alias("t"))

    def number(batches):
        claim(__name__)
        made = 0
        for b in slices(batches, 2, CHUNK_BYTES):
            parts, sizes = [], []
            for t in b.column(2):
                parts.append(np.append(word_codes(t.as_py()), END))
                sizes.append(len(parts[-1]))
            codes = np.concatenate(parts)
            del parts
            types, tokens = np.unique(codes, return_inverse=True)
            del codes
            train = ~b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            sizes = np.asarray(sizes, np.int64)
            row = [(TaskContext.get().partitionId() << 32) | made, b.column(0).to_pylist(), (~train).tolist(),
                   sizes.tolist(), types.tobytes(), _pack(tokens.astype("<u4")), int(sizes.sum()),
                   int(sizes[train].sum()), int(train.sum())]
            made += 1
            fields = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(),
                      pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([v], f) for v, f in zip(row, fields, strict=True)],
                                             names=[c.split()[0] for c in _CHUNKS.split(", ")])

    return src.mapInArrow(number, _CHUNKS)


class Chunk:
    """One chunk's words and bigrams, both in ascending key order."""

    def __init__(self, types: bytes, tokens: bytes, sizes):
        codes = np.frombuffer(types, np.uint64)
        self.sizes = np.asarray(sizes, np.int64)
        self.words = _unpack(tokens, "<i4")
        self.word_keys = codes
        n = len(codes)
        before = np.empty_like(self.words)
        before[1:] = self.words[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = n
        self.before = before
        pairs, place = np.unique(before * np.int64(n + 1) + self.words, return_inverse=True)
        place = place.astype(np.int32)
        known = np.append(codes, START)
        keys = chain(known[pairs // (n + 1)], known[pairs % (n + 1)])
        del pairs
        order = np.argsort(keys, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        self.pair_keys, self.pairs = keys[order], rank[place]


def _ranges(keys: np.ndarray, n: int) -> np.ndarray:
    """Borders of ``n`` equal key ranges in ascending keys."""
    cuts = np.asarray([(i << 64) // n for i in range(1, n)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, cuts), [len(keys)]]).astype(np.int64)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as six-byte steps from the first, or whole where a step is larger."""
    steps = np.diff(keys, prepend=np.uint64(0))
    if len(keys) and (steps[1:] >> np.uint64(48)).any():
        return b"\x08" + keys.tobytes()
    head = keys[:1].tobytes()
    return b"\x06" + head + np.ascontiguousarray(steps[1:]).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack_keys(data: bytes) -> np.ndarray:
    if data[:1] == b"\x08":
        return np.frombuffer(data, np.uint64, offset=1)
    head = np.frombuffer(data, np.uint64, 1, 1)
    steps = np.zeros(((len(data) - 9) // 6, 8), np.uint8)
    steps[:, :6] = np.frombuffer(data, np.uint8, offset=9).reshape(-1, 6)
    with np.errstate(over="ignore"):
        return np.cumsum(np.concatenate([head, steps.reshape(-1).view(np.uint64)]), dtype=np.uint64)


def range_totals(parts: DataFrame, n_ranges: int) -> DataFrame:
    """(chunk, size, part, totals, known): per chunk and key range the corpus counts of the chunk's own keys.

    ``size`` is 1 for words, 2 for bigrams. ``known`` is the range's number
    of keys with a training count, on one of its rows and 0 on the others.
    """
    def keys_of(batches):
        for b in batches:
            for r in b.to_pylist():
                c = Chunk(r["types"], r["tokens"], r["sizes"])
                train = np.repeat(~np.asarray(r["held"], bool), c.sizes)
                rows = []
                for size, keys, place in ((1, c.word_keys, c.words), (2, c.pair_keys, c.pairs)):
                    counts = np.bincount(place[train], minlength=len(keys)).astype("<u4")
                    cut = _ranges(keys, n_ranges)
                    rows += [(size, p, _pack_keys(keys[s:e]), _pack(counts[s:e]))
                             for p, (s, e) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if e > s]
                size, part, keys, counts = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["chunk"]] * len(rows)), pa.array(size, pa.int32()), pa.array(part, pa.int32()),
                     pa.array(keys, pa.binary()), pa.array(counts, pa.binary())],
                    names=["chunk", "size", "part", "keys", "counts"])

    def total(table: pa.Table) -> pa.Table:
        blocks = [_unpack_keys(k) for k in table.column("keys").to_pylist()]
        counts = np.concatenate([_unpack(c, "<u4") for c in table.column("counts").to_pylist()])
        keys, place = np.unique(np.concatenate(blocks), return_inverse=True)
        sums = np.bincount(place, weights=counts, minlength=len(keys)).astype("<u8")
        out, at = [], 0
        for b in blocks:
            out.append(_pack(sums[place[at:at + len(b)]]))
            at += len(b)
        known = [int((sums > 0).sum())] + [0] * (len(blocks) - 1)
        return pa.table({"chunk": table.column("chunk"), "size": table.column("size"), "part": table.column("part"),
                         "totals": pa.array(out, pa.binary()), "known": pa.array(known, pa.int64())})

    keyed = parts.select("chunk", "held", "sizes", "types", "tokens").mapInArrow(
        keys_of, "chunk long, size int, part int, keys binary, counts binary")
    return keyed.groupBy("size", "part").applyInArrow(
        total, "chunk long, size int, part int, totals binary, known long")


def _estimates(word, pair, context, n_words: int, deleted: int):
    """Bigram and word estimates from counts, ``deleted`` own occurrences taken out; and the context bucket."""
    context = np.maximum(context - deleted, 0)
    p1 = np.maximum(word - deleted, 0) / max(n_words - deleted, 1)
    p2 = np.where(context > 0, np.maximum(pair - deleted, 0) / np.maximum(context, 1), p1)
    return p2, p1, np.where(context > 0, np.frexp(context.astype(np.float64))[1], 0)


def _cell(p: np.ndarray, uniform: float) -> np.ndarray:
    """Histogram cell of an estimate relative to the uniform share; 0 for none."""
    with np.errstate(divide="ignore"):
        at = np.floor(np.log2(p / uniform) * STEPS) + _CELLS // 2
    return np.where(p > 0, np.clip(at, 1, _CELLS - 1), 0).astype(np.int64)


def counted(parts: DataFrame, totals: DataFrame, n_words: int, n_types: int, n_docs: int) -> DataFrame:
    """Chunks with each token's corpus counts (word, bigram), and the histogram of their training tokens."""
    left = parts.select("chunk", F.lit(0).alias("size"), F.lit(0).alias("part"), F.lit(None).cast("binary").alias("totals"),
                        "doc_ids", "held", "sizes", "types", "tokens")
    right = totals.select("chunk", "size", "part", "totals",
                          *[F.lit(None).cast(left.schema[c].dataType).alias(c)
                            for c in ("doc_ids", "held", "sizes", "types", "tokens")])

    def rejoin(table: pa.Table) -> pa.Table:
        kind, part = table.column("size").to_numpy(), table.column("part").to_numpy()
        own = int(np.flatnonzero(kind == 0)[0])
        row = table.slice(own, 1).to_pylist()[0]
        c = Chunk(row["types"], row["tokens"], row["sizes"])
        found = []
        for size in (1, 2):
            at = np.flatnonzero(kind == size)
            at = at[np.argsort(part[at])]
            found.append(np.concatenate([_unpack(table.column("totals")[int(i)].as_py(), "<u8") for i in at]))
        by_word, by_pair = (_narrowest(f) for f in found)
        word, pair = by_word[c.words], by_pair[c.pairs]
        by_context = np.append(by_word.astype(np.int64), n_docs)
        train = np.repeat(~np.asarray(row["held"], bool), c.sizes)
        uniform = 1.0 / (n_types + 1)
        counts: Counter = Counter()
        for at in range(0, len(word), SPAN):
            use = np.flatnonzero(train[at:at + SPAN]) + at
            p2, p1, bucket = _estimates(word[use].astype(np.int64), pair[use].astype(np.int64),
                                        by_context[c.before[use]], n_words, 1)
            at_cell = (bucket * _CELLS + _cell(p2, uniform)) * _CELLS + _cell(p1, uniform)
            counts.update(dict(zip(*(x.tolist() for x in np.unique(at_cell, return_counts=True)), strict=True)))
        cells, n = list(counts), list(counts.values())
        return pa.table({"doc_ids": table.column("doc_ids").slice(own, 1), "held": table.column("held").slice(own, 1),
                         "sizes": table.column("sizes").slice(own, 1),
                         "word": pa.array([_pack(_tagged(word))], pa.binary()),
                         "pair": pa.array([_pack(_tagged(pair))], pa.binary()),
                         "cells": pa.array([cells], pa.list_(pa.int64())), "n": pa.array([n], pa.list_(pa.int64()))})

    return left.unionByName(right).groupBy("chunk").applyInArrow(
        rejoin, "doc_ids array<long>, held array<boolean>, sizes array<int>, word binary, pair binary, "
                "cells array<long>, n array<long>")


def _narrowest(x: np.ndarray) -> np.ndarray:
    """Counts as the narrowest unsigned integers that hold them."""
    return x.astype(next(f"<u{w}" for w in (1, 2, 4, 8) if w == 8 or not len(x) or x.max() < 1 << (8 * w)))


def _tagged(x: np.ndarray) -> np.ndarray:
    """Unsigned integers as bytes led by their width."""
    return np.frombuffer(bytes([x.dtype.itemsize]) + x.tobytes(), np.uint8)


def _untagged(data: bytes) -> np.ndarray:
    raw = zstandard.decompress(data)
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1)


def learn_weights(cells: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> np.ndarray:
    """(buckets, 3) weights of bigram, word and uniform estimate, by EM over the histogram of deleted counts."""
    def ratio(cell):
        return np.where(cell > 0, np.exp2((cell - _CELLS // 2 + 0.5) / STEPS), 0.0)

    r1, r2, bucket = ratio(cells % _CELLS), ratio(cells // _CELLS % _CELLS), cells // (_CELLS * _CELLS)
    estimates = np.stack([r2, r1, np.ones_like(r1)], axis=1)
    weights = np.full((65, 3), 1 / 3)
    for _ in range(rounds):
        share = estimates * weights[bucket]
        share *= (counts / share.sum(axis=1))[:, None]
        sums = np.stack([np.bincount(bucket, share[:, k], 65) for k in range(3)], axis=1)
        # a pinch of every estimate, so that no text has probability zero and unseen buckets keep equal weights
        weights = (sums + 0.5) / (sums.sum(axis=1, keepdims=True) + 1.5)
    return weights


def score_texts(docs: DataFrame, held: Column | None = None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text."""
    held = F.lit(False) if held is None else held
    batches_of(docs, 64 << 20)  # chunks are cut from batches: small ones would make small chunks
    parts, seen = written(chunks(docs, held, doc_id, text), "lm-chunks", F.sum("n_tokens").alias("n"),
                          F.sum("train_tokens").alias("train"), F.sum("train_docs").alias("docs"))
    n_words, n_docs = int(seen.get("train") or 0), int(seen.get("docs") or 0)
    n_ranges = max(LEAST_RANGES, math.ceil(int(seen.get("n") or 0) / RANGE_TOKENS))
    with shuffles_freed(docs.sparkSession):  # the keys' shuffle is gone before the chunks are shuffled
        totals, known = written(range_totals(parts, n_ranges), "lm-totals",
                                F.sum(F.when(F.col("size") == 1, F.col("known"))).alias("types"))
        n_types = int(known.get("types") or 0)
        ready, _ = written(counted(parts, totals, n_words, n_types, n_docs), "lm-counted")
        grid = (ready.select(F.explode(F.arrays_zip("cells", "n")).alias("x")).groupBy("x.cells")
                .agg(F.sum("x.n").alias("n")).toArrow())  # at most 65 x _CELLS x _CELLS cells
    weights = learn_weights(grid.column("cells").to_numpy(), grid.column("n").to_numpy().astype(float))
    if not n_words:
        weights = np.tile([0.0, 0.0, 1.0], (65, 1))

    def score(batches):
        for b in batches:
            for r in b.to_pylist():
                sizes = np.asarray(r["sizes"], np.int64)
                word, pair = _untagged(r["word"]), _untagged(r["pair"])
                first = np.cumsum(sizes) - sizes
                starts = np.zeros(len(word), bool)
                starts[first] = True
                base, score_of = np.empty(len(word)), np.empty(len(word))
                for at in range(0, len(word), SPAN):
                    own = word[at:at + SPAN].astype(np.int64)
                    context = np.empty_like(own)
                    context[1:] = own[:-1]
                    context[0] = word[at - 1] if at else 0
                    context[starts[at:at + SPAN]] = n_docs
                    p2, p1, bucket = _estimates(own, pair[at:at + SPAN].astype(np.int64), context, n_words, 0)
                    w = weights[bucket]
                    score_of[at:at + SPAN] = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (n_types + 1))
                    base[at:at + SPAN] = np.log10((own + 1.0) / (n_words + 1.0 * (n_types + 1)))
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(r["held"], pa.bool_()), pa.array(sizes),
                     pa.array(_sums((word > 0).astype(np.int64), sizes).astype(np.int64)),
                     pa.array(np.full(n, n_words, np.int64)), pa.array(_sums(base, sizes)),
                     pa.array(_sums(score_of, sizes))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return ready.select("doc_ids", "held", "sizes", "word", "pair").mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
               "score double")
