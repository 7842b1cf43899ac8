"""Operator 9: toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters of other scripts and digit or
sign substitutions to plain letters, drops invisible characters and turns all
else into single word borders. Lexicon entries are words and word beginnings
with a weight: the log-odds of meeting them in labelled toxic against clean
documents. Exception phrases (given ones, and two-word phrases that training
documents show to be clean) cancel the entries inside them. A document's
weights are summed, also per 1,000 words, and a logistic curve fitted on the
labelled documents turns both into a score.

Learning uses a bounded sample of the labelled rows (``max_toxic`` and
``max_clean`` documents, those of smallest id hash); whole texts of the
sampled documents are counted, near copies once. Scoring reads every whole text.

Cases: null and empty text have no hits and get the score of a text without
hits. With no labelled toxic or no labelled clean document the lexicon is
empty and every score is the labelled toxic share (0 with no labels at all).
Several labels of one document count as toxic if any is 1; null labels are
left out. Repeated rows get repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilekit.llm.text import col, crc_mod, map_texts, window_codes, word_codes, worker_cache
from profilekit.session import shared_path

MAX_TOXIC, MAX_CLEAN = 4_000, 8_000
MIN_DOCS = 4          # labelled documents an entry or an exception must occur in
MIN_WEIGHT = 2.5      # log-odds an entry must have, after
SPREAD = 1.64         # standard deviations against it
MAX_TERMS = 5_000     # entries kept, heaviest coverage first
SHORTEST, LONGEST = 4, 8  # letters of a word beginning
THRESHOLD = 0.7
EXCEPTIONS = ("trash can", "clown fish", "idiot proof")

# Look-alikes of Latin letters in Cyrillic and Greek, and signs used for letters: fixed values.
_LOOKALIKES = dict(zip("асеорхуіјѕԁһɡԛԝкмнтвгαβγεικνορτυχ", "aceopxyijsdhgqwkmhtbraßyeiknoptux", strict=True))
_SIGNS = dict(zip("0134578@$!|", "oieastbasil", strict=True))


class _Fold(dict):
    """Character table of the folding, filled as characters turn up."""

    def __missing__(self, code: int):
        c = chr(code)
        if c in _SIGNS:
            out = _SIGNS[c]
        elif unicodedata.category(c) == "Cf":
            out = ""
        else:
            out = "".join(_LOOKALIKES.get(x, x) for x in unicodedata.normalize("NFKC", c).lower())
            out = "".join(x if x.isalpha() else " " for x in out)
        self[code] = out
        return out


_FOLD = _Fold()
_SENTENCE_MARK = re.compile(r"!(?!\w)")


def fold(text: str) -> str:
    """Words of folded letters, each led by one space; one space ends the text."""
    if "!" in text:
        text = _SENTENCE_MARK.sub(" ", text)  # a mark that ends a word is punctuation
    return " " + " ".join(text.translate(_FOLD).split()) + " "


def terms(folded: str) -> set[str]:
    """Candidate entries of a document: its words, closed by a space, and their beginnings."""
    out = set()
    for w in set(folded.split()):
        n = len(w)
        if n >= SHORTEST - 1:
            out.add(f" {w} ")
            for k in range(SHORTEST, min(n, LONGEST) + 1):
                out.add(" " + w[:k])
    return out


class Lexicon:
    """Weighted entries and exception phrases in one automaton."""

    def __init__(self, weights: dict[str, float], exceptions):
        self.automaton = ahocorasick.Automaton()
        for e in exceptions:
            f = fold(e)
            if f.strip():
                self.automaton.add_word(f[:-1], (len(f) - 1, None))
        for t, w in weights.items():
            self.automaton.add_word(t, (len(t), w))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> dict[int, tuple[int, float]]:
        """Start of each matched word -> (end, weight): the heaviest entry there, unless an exception covers it."""
        found: dict[int, tuple[int, float]] = {}
        free: list[tuple[int, int]] = []
        if not len(self.automaton):
            return found
        for end, (size, weight) in self.automaton.iter(folded):
            start = end - size + 1
            if weight is None:
                free.append((start, end))
            elif start not in found or found[start][1] < weight:
                found[start] = (end, weight)
        return {s: h for s, h in found.items() if not any(a <= s and h[0] <= b + 1 for a, b in free)} if free else found


def _features(total: float, n_words: int) -> list[float]:
    return [math.log1p(total), math.log1p(1000.0 * total / max(n_words, 1)), 1.0]


def measure(lexicon: Lexicon, text: str) -> tuple[float, int, int]:
    """(sum of weights, number of hits, number of words) of a text."""
    folded = fold(text)
    found = lexicon.hits(folded)
    return sum(w for _, w in found.values()), len(found), folded.count(" ") - 1


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps (the last column, the constant, is free)."""
    w = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], ridge)
    pull[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + pull * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _smallest(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def training_sample(docs: DataFrame, labels: DataFrame, train_on, max_toxic: int, max_clean: int) -> DataFrame:
    """Written sample (toxic, text) of labelled training documents, near copies once; bounded by the two sizes."""
    spark = docs.sparkSession
    marked = (labels.select(col("doc_id").alias("doc_id"), col("toxic").cast("int").alias("toxic"))
              .filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & train_on)
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    wanted = _smallest(marked.filter("toxic = 1"), max_toxic).unionByName(
        _smallest(marked.filter("toxic = 0"), max_clean))
    # at most max_toxic + max_clean rows of two numbers
    picked = docs.select(col("doc_id").alias("doc_id"), col("text").cast("string").alias("text")).join(
        F.broadcast(wanted), "doc_id").filter(F.col("text").isNotNull())

    def make():
        def run(texts):
            keys = []
            for t in texts:
                codes = window_codes(word_codes(t), 5)
                keys.append(int(codes.min() >> np.uint64(1)) if len(codes) else hash(t or b"") & (2**62 - 1))
            return [keys]
        return run

    marked_copies = map_texts(picked, make, [T.StructField("copy", T.LongType())], keep=("doc_id", "toxic", "text"))
    path = shared_path(spark, "toxicity-sample")
    (marked_copies.groupBy("copy", "toxic").agg(F.min_by("text", "doc_id").alias("text"))
     .select("toxic", "text").write.parquet(path))
    return spark.read.parquet(path)


def _count_terms(sample: DataFrame, find) -> DataFrame:
    """Documents of either label that hold each found term, pre-counted per task."""
    def count(batches):
        seen: Counter = Counter()
        for b in batches:
            for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen.update((toxic, t) for t in find(text))
                if len(seen) > 300_000:
                    yield _term_rows(seen)
                    seen.clear()
        if seen:
            yield _term_rows(seen)

    rows = sample.select("toxic", "text").mapInArrow(count, "term string, toxic int, n long")
    return rows.groupBy("term").agg(*[F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0)).alias(name)
                                      for k, name in ((1, "a"), (0, "b"))])


def _term_rows(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([t for _, t in seen], pa.string()),
                                       pa.array([k for k, _ in seen], pa.int32()),
                                       pa.array(list(seen.values()), pa.int64())], names=["term", "toxic", "n"])


def learn(docs: DataFrame, labels: DataFrame, train_on=None, *, max_toxic: int = MAX_TOXIC,
          max_clean: int = MAX_CLEAN, exceptions=EXCEPTIONS) -> dict:
    """The model: weights of entries, exception phrases, logistic coefficients."""
    train_on = F.lit(True) if train_on is None else train_on
    sample = training_sample(docs, labels, train_on, max_toxic, max_clean)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        share = n_toxic / max(n_toxic + n_clean, 1)
        odds = math.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return {"weights": {}, "exceptions": list(exceptions), "curve": [0.0, 0.0, odds]}
    # log-odds with both counts moved towards each other by their spread: chance finds stay light
    low = F.greatest(F.col("a") - SPREAD * F.sqrt("a"), F.lit(0.0))
    high = F.col("b") + SPREAD * F.sqrt(F.col("b"))
    weight = F.log((low + 0.5) / (n_toxic + 1.0)) - F.log((high + 0.5) / (n_clean + 1.0))
    candidates = _count_terms(sample.filter("toxic = 1"), lambda t: terms(fold(t))).filter(F.col("a") >= MIN_DOCS)
    # bounded by the sample; only candidates' clean counts are needed, so the clean side is cut to them
    clean = _count_terms(sample.filter("toxic = 0"), lambda t: terms(fold(t))).select("term", F.col("b").alias("b0"))
    rated = (candidates.join(clean, "term", "left").select("term", "a", F.coalesce("b0", F.lit(0)).alias("b"))
             .withColumn("w", weight).filter(F.col("w") >= MIN_WEIGHT))
    top = rated.orderBy(F.desc("a"), F.length("term"), "term").limit(4 * MAX_TERMS).collect()
    weights = _without_offshoots({r["term"]: (r["a"], r["w"]) for r in top})
    phrases = _learned_exceptions(sample, weights)
    allowed = [*exceptions, *phrases]
    lexicon_parts = sample.sparkSession.sparkContext.broadcast((weights, allowed))

    def make():
        lexicon = Lexicon(*lexicon_parts.value)

        def run(texts):
            found = [measure(lexicon, t.decode() if t else "") for t in texts]
            return [[f[0] for f in found], [f[2] for f in found]]
        return run

    got = map_texts(sample, make, [T.StructField("total", T.DoubleType()), T.StructField("n_words", T.LongType())],
                    keep=("toxic",)).toPandas()  # two numbers per sampled row
    x = np.asarray([_features(t, n) for t, n in zip(got["total"], got["n_words"], strict=True)])
    return {"weights": weights, "exceptions": allowed, "curve": logistic(x, got["toxic"].to_numpy(float)).tolist()}


def _without_offshoots(rated: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Entries without those a shorter kept entry explains: same word beginning, about as heavy."""
    kept: dict[str, float] = {}
    for term in sorted(rated, key=lambda t: (len(t.rstrip()), t.endswith(" "), t)):
        w = rated[term][1]
        word = term.rstrip()
        parents = [kept[word[:k]] for k in range(SHORTEST + 1, len(word) + 1) if word[:k] in kept]
        if not parents or max(parents) < w - 1.5:
            kept[term] = w
    best = sorted(kept, key=lambda t: (-rated[t][0] * kept[t], t))[:MAX_TERMS]
    return {t: round(kept[t], 4) for t in best}


def _learned_exceptions(sample: DataFrame, weights: dict[str, float]) -> list[str]:
    """Two-word phrases around entries found in several clean and in no toxic training documents."""
    shared = sample.sparkSession.sparkContext.broadcast(weights)

    def find(text, made={}):  # noqa: B006 - one automaton per task
        lexicon = made.get(0) or made.setdefault(0, Lexicon(shared.value, ()))
        folded = fold(text)
        out = set()
        for start, (end, _) in lexicon.hits(folded).items():
            stop = folded.find(" ", max(end, start + 1))
            word = folded[start + 1:stop]
            after = folded[stop + 1:folded.find(" ", stop + 1)] if stop + 1 < len(folded) else ""
            before = folded[:start].rpartition(" ")[2]
            out |= {f"{word} {after}"} if after else set()
            out |= {f"{before} {word}"} if before else set()
        return out

    found = _count_terms(sample, find).filter((F.col("a") == 0) & (F.col("b") >= MIN_DOCS))
    return [r["term"] for r in found.orderBy(F.desc("b"), "term").limit(MAX_TERMS).collect()]


_LEXICONS: dict[str, Lexicon] = worker_cache({})


def score(docs: DataFrame, model: dict, *, text: str = "text", keep=("doc_id",), prefix: str = "") -> DataFrame:
    """``keep`` columns plus score, predicted, n_hits for every text (names led by ``prefix``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_TERMS entries and phrases
    key = shared_path(docs.sparkSession, "lexicon")

    def make():
        m = shared.value
        if key not in _LEXICONS:
            _LEXICONS.clear()
            _LEXICONS[key] = Lexicon(m["weights"], m["exceptions"])
        lexicon, curve = _LEXICONS[key], m["curve"]

        def run(texts):
            scores, hits = [], []
            for t in texts:
                total, n, words = measure(lexicon, t.decode()) if t else (0.0, 0, 0)
                z = sum(c * f for c, f in zip(curve, _features(total, words), strict=True))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                hits.append(n)
            return [scores, [int(s >= THRESHOLD) for s in scores], hits]
        return run

    fields = [T.StructField(prefix + "score", T.DoubleType()), T.StructField(prefix + "predicted", T.IntegerType()),
              T.StructField(prefix + "n_hits", T.LongType())]
    return map_texts(docs, make, fields, text=text, keep=keep)


def held_out(doc_id: str = "doc_id"):
    """Documents whose labels are never learnt from."""
    return F.coalesce(crc_mod(doc_id, 3) == 1, F.lit(False))
