"""Operator 5: exact token counts at every prefix of a text, by prefix dynamic programming.

For byte-pair encoding the tokens of a prefix are the tokens of a shorter
prefix plus one last token, and that last token is the only vocabulary entry
ending there which keeps its neighbour intact. So one left-to-right pass
gives, for every prefix, its last token and its exact token count.
The pass runs per pre-token (the split pattern of the tokenizer file never
merges across them) and is memoised; a document's table is the joined tables
of its pre-tokens, stored as one signed byte per code point: the change of the
count. A running sum answers "how many tokens has the text cut here?" and
"where must the text be cut to fit a budget?" without encoding again.

Cases: null and empty text have an empty table and 0 tokens. Very long
texts are processed whole; the table takes one byte per code point. Repeated
rows give repeated results; an empty table gives no rows; only the kept
columns are returned, so clashing extra columns do not matter.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilekit.llm.text import BoundedCache, map_texts, worker_cache

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_SPLIT = regex.compile("|".join(_CONTRACTIONS)
                       + r"| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
                       + r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_RUN = regex.compile(r"\p{White_Space}{2,}(?=\P{White_Space})")
_WIDE_GAP = re.compile(r"\s\s")


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 as it is, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Prefix token counts under one byte-level BPE tokenizer file."""

    def __init__(self, tokenizer_json: bytes):
        spec = json.loads(tokenizer_json)
        if spec["model"]["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("prefix counts need a byte-level BPE tokenizer file")
        if spec.get("normalizer") or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("prefix counts need a tokenizer without normaliser and prefix space")
        to_byte = byte_characters()
        vocab = {bytes(to_byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items()
                 if all(c in to_byte for c in piece)}
        # rank of a token: its place in the merge list; single bytes come before all merges
        self.rank: dict[int, int] = {i: -1 for piece, i in vocab.items() if len(piece) == 1}
        self.merged: dict[tuple[int, int], int] = {}  # rank of each mergeable pair
        self.parts: dict[int, tuple[int, int]] = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            left, right = (vocab[bytes(to_byte[c] for c in x)]
                           for x in (pair if isinstance(pair, list) else pair.split(" ")))
            whole = vocab[self._bytes_of(vocab, left, right)]
            self.merged.setdefault((left, right), r)
            if whole not in self.parts and whole not in self.rank:
                self.parts[whole], self.rank[whole] = (left, right), r
        # every suffix of a token, with the token's id or -1: walking back stops at the first miss
        self.suffixes: dict[bytes, int] = {}
        for piece, i in vocab.items():
            if i in self.rank:
                for k in range(1, len(piece)):
                    self.suffixes.setdefault(piece[k:], -1)
        for piece, i in vocab.items():
            if i in self.rank:
                self.suffixes[piece] = i
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self._fits = BoundedCache(self._keeps_apart, 1_000_000)
        self._tables = BoundedCache(self._piece_table, 300_000)
        self._chunks = BoundedCache(self._chunk_table, 500_000)

    def _bytes_of(self, vocab: dict[bytes, int], *ids: int) -> bytes:
        if not hasattr(self, "_names"):
            self._names = {i: p for p, i in vocab.items()}
        return b"".join(self._names[i] for i in ids)

    def _keeps_apart(self, pair: tuple[int, int]) -> bool:
        """Whether two neighbouring tokens stay as they are when their bytes are encoded together.

        They break if, at the time some merge inside them would happen, the
        pieces facing each other across the border could merge sooner. The
        border pieces at each moment are found by undoing, on the later-built
        side, the merge that made it.
        """
        left, right = pair
        before = len(self.merged) + 1
        rank, parts, merged = self.rank, self.parts, self.merged
        strict = True  # a merge across the border at the same rank wins only where it stands further left
        while True:
            r = merged.get((left, right))
            if r is not None and (r < before or (r == before and not strict)):
                return False
            a, b = rank[left], rank[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                # undo the left token's last merge: the right half faces the border
                before, strict = a, True
                left = parts[left][1]
            else:
                # of equal ranks the right one was merged later: undo it first
                before, strict = b, False
                right = parts[right][0]

    def prefix_counts(self, piece: bytes) -> list[int]:
        """Token count of each byte prefix of one pre-token."""
        last, count = [-1], [0]
        suffixes, fits = self.suffixes, self._fits
        for i in range(1, len(piece) + 1):
            # exactly one token ending here fits its neighbour, so the first that does is it
            for k in range(i - 1, -1, -1):
                t = suffixes.get(piece[k:i])
                if t is None:
                    raise ValueError("no token ends this prefix: the vocabulary lacks single bytes")
                if t >= 0 and (k == 0 or fits[last[k], t]):
                    last.append(t)
                    count.append(count[k] + 1)
                    break
        return count[1:]

    def _piece_table(self, piece: str) -> bytes:
        """Change of the count at each code point of one pre-token."""
        raw = piece.encode()
        counts = self.prefix_counts(raw)
        if len(raw) != len(piece):
            # a code point ends before each byte that is no continuation byte
            counts = [n for n, after in zip(counts, [*raw[1:], 0], strict=True) if after & 0xC0 != 0x80]
        if piece in _CONTRACTIONS and len(piece) == 3:
            # cut inside, the quote and the letter are split by the pattern
            counts[1] = self.prefix_counts(b"'")[-1] + self.prefix_counts(raw[1:2])[-1]
        return bytes([(b - a) & 0xFF for a, b in zip([0, *counts], counts, strict=False)])

    def _chunk_table(self, chunk: str) -> bytes:
        """Table of a run between plain spaces (white space inside it stands alone)."""
        return b"".join(map(self._tables.__getitem__, _SPLIT.findall(chunk)))

    def _section(self, text: str) -> np.ndarray:
        """Table of a text without special tokens."""
        if not _WIDE_GAP.search(text):
            # lone white space only: each plain space belongs to the run behind it
            first, *rest = text.split(" ")
            raw = self._chunks[first] + b"".join([self._chunks[" " + w] for w in rest])
            return np.frombuffer(raw, np.int8)
        deltas = np.frombuffer(b"".join(map(self._tables.__getitem__, _SPLIT.findall(text))), np.int8).copy()
        for m in _RUN.finditer(text):
            # a text cut at the end of a white-space run sees the whole run as one pre-token
            a, b = m.span()
            whole = int(np.frombuffer(self._tables[text[a:b]], np.int8).sum(dtype=np.int64))
            shift = whole - int(deltas[a:b].sum(dtype=np.int64))
            deltas[b - 1] += shift
            deltas[b] -= shift
        return deltas

    def table(self, text: str) -> np.ndarray:
        """Change of the token count at each code point of ``text`` (int8)."""
        if not text:
            return np.empty(0, np.int8)
        if self._special is None or not any(s in text for s in self.specials):
            return self._section(text)
        out = []
        parts = self._special.split(text)
        for i, part in enumerate(parts):
            if i % 2 == 0:
                if part:
                    out.append(self._section(part))
                continue
            # a cut inside a special string leaves ordinary text; complete, it is one token
            before = parts[i - 1]
            base = int(self._section(before).sum(dtype=np.int64)) if before else 0
            counts = [int(self._section(before + part[:k]).sum(dtype=np.int64)) for k in range(1, len(part))]
            out.append(np.diff([*counts, base + 1], prepend=base).astype(np.int8))
        return np.concatenate(out) if out else np.empty(0, np.int8)


_COUNTERS: dict[bytes, PrefixCounter] = worker_cache({})


def counter(tokenizer_json: bytes) -> PrefixCounter:
    """One counter per worker and tokenizer file."""
    if tokenizer_json not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[tokenizer_json] = PrefixCounter(tokenizer_json)
    return _COUNTERS[tokenizer_json]


def prefix_tables(docs: DataFrame, tokenizer: str | None = None, *, text: str = "text",
                  keep=("doc_id",), tables: bool = True) -> DataFrame:
    """``keep`` columns, n_bytes, n_tokens and (if ``tables``) prefix_deltas for each text.

    ``prefix_deltas`` holds one signed byte per code point; its running sum is
    the exact token count of the text cut after that code point.
    """
    with open(tokenizer or public_tokenizers.path(DEFAULT_TOKENIZER), "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # one tokenizer file, a few MB
    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    if tables:
        fields.append(T.StructField("prefix_deltas", T.BinaryType()))

    def make():
        c = counter(spec.value)

        def run(texts):
            found = [c.table(t.decode()) if t else np.empty(0, np.int8) for t in texts]
            out = [[len(t) if t else 0 for t in texts], [int(x.sum(dtype=np.int64)) for x in found]]
            return [*out, [x.tobytes() for x in found]] if tables else out
        return run

    return map_texts(docs, make, fields, text=text, keep=keep)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _cut_points(deltas: pd.Series, budget: pd.Series) -> pd.Series:
    out = []
    for d, b in zip(deltas, budget, strict=True):
        counts = np.cumsum(np.frombuffer(d or b"", np.int8), dtype=np.int64)
        ok = np.flatnonzero(counts <= b)
        n = int(ok[-1]) + 1 if len(ok) else 0
        out.append([n, int(counts[n - 1]) if n else 0])
    return pd.Series(out)


def cut_to_budget(tables: DataFrame, budget: int | Column) -> DataFrame:
    """Adds cut_chars and cut_tokens: the longest prefix of at most ``budget`` tokens, from the stored table alone."""
    b = F.lit(budget) if isinstance(budget, int) else budget
    return (tables.withColumn("_cut", _cut_points("prefix_deltas", b.cast("long")))
            .withColumns({"cut_chars": F.col("_cut")[0], "cut_tokens": F.col("_cut")[1]}).drop("_cut"))
