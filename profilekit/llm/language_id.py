"""Operator 4: language of code-switched text by a linear-chain conditional random field.

Every word gets emission scores from its affixes (1-4 letters at either end),
inner letter pairs and triples, and lexicon features (whether it is among a
language's characteristic words); learned transitions join neighbouring words.
Forward-backward gives each word's posterior; a document's language is the one
with the largest posterior sum over its words with letters, its score that
sum's mean.

The field is fitted by AdaGrad on the conditional likelihood of word sequences
spliced from labelled documents, so that it sees switches between languages.
The sample is bounded: ``docs_per_language`` documents of each language
(smallest id hash; more than ``MOST_LANGUAGES`` labels are an error),
``SEGMENTS`` runs of words from each, spread over the whole text. Prediction reads every whole text.

Cases: null, empty or letterless text gives ``und`` with score 0. Ties go to
the language first in order. Without any labelled training text all texts are
``und``. Repeated rows get repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilekit.llm.text import chain, col, crc_mod, map_texts, mix, worker_cache

UNKNOWN = "und"
DOCS_PER_LANGUAGE = 400
MOST_LANGUAGES = 1_000  # more distinct labels are an error: the column holds no languages then
SEGMENTS, SEGMENT_WORDS = 8, 30
SEQUENCE, BATCH, EPOCHS, RATE = 40, 64, 4, 0.2
BUCKETS = 1 << 17
LEXICON_WORDS = 2_000  # characteristic words kept per language
CHUNK_WORDS = 200_000  # words whose messages are held at once
WORD_ENTRIES = 300_000  # memoised words
FEATURE_WORDS = 50_000  # words whose features are held at once
_LETTER = regex.compile(r"\p{L}")
_EDGES = regex.compile(r"^[^\p{L}]+|[^\p{L}]+$")


def held_out(doc_id: str = "doc_id"):
    """Documents whose language is never learnt from."""
    return F.coalesce(crc_mod(doc_id, 4) == 2, F.lit(False))


def _core(word: str) -> str:
    """A lower-cased word without what is no letter at its ends."""
    return word if word.isalpha() else _EDGES.sub("", word)


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, place of the word) of every feature of lower-cased words; words without letters have none.

    Features are the word itself, its entry in the lexicon, its first and last
    one to four letters, and its letter pairs and triples, as often as they occur.
    """
    cores = [_core(w) for w in words]
    sizes = np.fromiter(map(len, cores), np.int64, len(cores))
    letters = np.frombuffer("".join(cores).encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    full = np.flatnonzero(sizes)
    if not len(full):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    word = np.repeat(np.arange(len(cores)), sizes)
    place = np.arange(len(letters)) - starts[word]
    listed = np.fromiter((lexicon.get(cores[i], -1) + 2 for i in full), np.uint64, len(full))
    whole = np.add.reduceat(chain(letters, place.astype(np.uint64)), starts[full])
    found = [(1, whole, full), (2, listed, full)]
    for tag, at, step in ((3, starts, 1), (4, ends - 1, -1)):
        owner, run = full, np.full(len(full), tag, np.uint64)
        for k in range(4):
            live = sizes[owner] > k
            owner, run = owner[live], run[live]
            run = chain(run, letters[at[owner] + step * k])
            found.append((tag + 2 * k, run, owner))
    run = letters
    for tag, width in ((11, 2), (12, 3)):
        run = chain(run[:-1], letters[width - 1:])
        inside = np.flatnonzero(place[:len(run)] + width <= sizes[word[:len(run)]])
        found.append((tag, run[inside], word[inside]))
    buckets = [mix(h + np.uint64(tag << 40)) % np.uint64(BUCKETS) for tag, h, _ in found]
    return np.concatenate(buckets).astype(np.int64), np.concatenate([o for _, _, o in found])


class Field:
    """A fitted field: languages, feature weights, transitions, start weights, lexicon."""

    def __init__(self, languages: list[str], weights: np.ndarray, transitions: np.ndarray, start: np.ndarray,
                 lexicon: dict[str, int]):
        self.languages, self.weights, self.lexicon = languages, weights, lexicon
        self.transitions, self.start = transitions, start
        self._rows: dict[str, int] = {}
        self._scores = np.zeros((0, len(languages)), np.float32)
        self._lettered = np.zeros(0, bool)

    def _emissions(self, words: list[list[str]]) -> None:
        """Make sure that every word has a row of exponentiated emission scores."""
        new = list(set().union(*words).difference(self._rows))
        if len(self._rows) + len(new) > WORD_ENTRIES:
            self._rows, new = {}, list(set().union(*words))
            self._scores, self._lettered = self._scores[:0], self._lettered[:0]
        if not new:
            return
        n_lang = len(self.languages)
        scores, lettered = np.zeros((len(new), n_lang), np.float32), np.zeros(len(new), bool)
        for at in range(0, len(new), FEATURE_WORDS):  # features are many: some words at once
            part = new[at:at + FEATURE_WORDS]
            bucket, owner = word_features(part, self.lexicon)
            sums = np.stack([np.bincount(owner, self.weights[bucket, y], len(part)) for y in range(n_lang)], axis=1)
            scores[at:at + len(part)] = np.exp(sums - sums.max(axis=1, keepdims=True))
            lettered[at + owner] = True
        base = len(self._rows)
        self._rows.update((w, base + i) for i, w in enumerate(new))
        self._scores = np.concatenate([self._scores, scores])
        self._lettered = np.concatenate([self._lettered, lettered])

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        open_chunk: list[tuple[int, list[str]]] = []
        size = 0
        for i in sorted(range(len(texts)), key=lambda i: -len(texts[i] or b"")):
            text = texts[i].decode() if texts[i] else ""
            words = text.lower().split() if self.languages and _LETTER.search(text) else []
            if words:
                open_chunk.append((i, words))
                size += len(words)
            if size >= CHUNK_WORDS:
                self._close(open_chunk, names, scores)
                open_chunk, size = [], 0
        self._close(open_chunk, names, scores)
        return names, scores

    def _close(self, chunk: list[tuple[int, list[str]]], names: list[str], scores: list[float]) -> None:
        if not chunk:
            return
        chunk.sort(key=lambda x: -len(x[1]))
        words = [ws for _, ws in chunk]
        self._emissions(words)
        get = self._rows.__getitem__
        rows = np.fromiter((r for ws in words for r in map(get, ws)), np.int64, sum(map(len, words)))
        sums, counts = self.posterior_sums(rows, np.asarray([len(ws) for ws in words]))
        for (i, _), s, n in zip(chunk, sums, counts, strict=True):
            if n:
                best = int(np.argmax(s))
                names[i], scores[i] = self.languages[best], float(min(1.0, s[best] / n))

    def posterior_sums(self, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posterior sums over lettered words of each sequence (longest first), and the count of those words."""
        n_docs, n_lang = len(lengths), len(self.languages)
        starts = np.cumsum(lengths) - lengths
        x, lettered = self._scores[rows], self._lettered[rows]
        move = np.exp(self.transitions).astype(np.float32)
        forward = np.empty((len(rows), n_lang), np.float32)
        # sequences still running at each position: a shrinking prefix, as the longest come first
        running = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
        a = np.broadcast_to(np.exp(self.start).astype(np.float32), (n_docs, n_lang))
        for t, k in enumerate(running):
            at = starts[:k] + t
            a = a[:k] * x[at] if t == 0 else (a[:k] @ move) * x[at]
            a /= a.sum(axis=1, keepdims=True)
            forward[at] = a
        sums = np.zeros((n_docs, n_lang))
        b = np.ones((n_docs, n_lang), np.float32)
        for t in range(lengths[0] - 1, -1, -1):
            k = running[t]
            at = starts[:k] + t
            g = forward[at] * b[:k]
            g /= g.sum(axis=1, keepdims=True)
            sums[:k] += g * lettered[at][:, None]
            back = (b[:k] * x[at]) @ move.T
            b[:k] = back / back.sum(axis=1, keepdims=True)
        return sums, np.add.reduceat(lettered.astype(np.int64), starts)


def spliced(segments: list[tuple[int, list[str]]], rng: np.random.Generator) -> tuple[list[list[str]], np.ndarray]:
    """Training sequences of SEQUENCE words, cut from runs of random segments, and their labels."""
    words: list[str] = []
    labels: list[int] = []
    for i in rng.permutation(len(segments)):
        label, ws = segments[i]
        cut = len(ws) if rng.random() < 0.5 else int(rng.integers(3, max(4, len(ws) + 1)))
        words += ws[:cut] if rng.random() < 0.5 else ws[-cut:]
        labels += [label] * (len(words) - len(labels))
    n = max(1, len(words) // SEQUENCE)
    while len(words) < SEQUENCE:  # very small samples: repeat
        words, labels = words + words, labels + labels
    return ([words[i * SEQUENCE:(i + 1) * SEQUENCE] for i in range(n)],
            np.asarray(labels[:n * SEQUENCE]).reshape(n, SEQUENCE))


def fit(segments: list[tuple[str, list[str]]], seed: int = 7) -> Field:
    """Fit the field on labelled word runs."""
    languages = sorted({lang for lang, _ in segments})
    if not languages:
        return Field([], np.zeros((BUCKETS, 0)), np.zeros((0, 0)), np.zeros(0), {})
    index = {lang: i for i, lang in enumerate(languages)}
    marked = [(index[lang], [w.lower() for w in ws]) for lang, ws in segments if ws]
    lexicon = characteristic_words(marked, len(languages))
    n_lang = len(languages)
    rng = np.random.default_rng(seed)
    w, gw = np.zeros((BUCKETS, n_lang)), np.full((BUCKETS, n_lang), 1e-2)
    trans, gt = np.zeros((n_lang, n_lang)), np.full((n_lang, n_lang), 1e-2)
    start, gs = np.zeros(n_lang), np.full(n_lang, 1e-2)
    vocabulary = sorted({word for _, ws in marked for word in ws})
    bucket, of = word_features(vocabulary, lexicon)
    ordered = np.split(bucket[np.argsort(of, kind="stable")], np.cumsum(np.bincount(of, minlength=len(vocabulary)))[:-1])
    features = dict(zip(vocabulary, ordered, strict=True))
    for _ in range(EPOCHS):
        sequences, labels = spliced(marked, rng)
        for at in range(0, len(sequences), BATCH):
            batch, gold = sequences[at:at + BATCH], labels[at:at + BATCH]
            found = [features[word] for ws in batch for word in ws]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.concatenate(found)
            owner = np.repeat(np.arange(len(found)), sizes)
            e = np.stack([np.bincount(owner, w[flat, y], len(found)) for y in range(n_lang)], axis=1)
            g, g_trans, g_start = _gradients(e.reshape(len(batch), SEQUENCE, n_lang), gold, trans, start)
            g = g.reshape(-1, n_lang) / len(batch)
            used, place = np.unique(flat, return_inverse=True)
            dw = np.stack([np.bincount(place, g[owner, y], len(used)) for y in range(n_lang)], axis=1) + 1e-5 * w[used]
            gw[used] += dw * dw
            w[used] -= RATE * dw / np.sqrt(gw[used])
            for value, total, grad in ((trans, gt, g_trans / len(batch)), (start, gs, g_start / len(batch))):
                total += grad * grad
                value -= RATE * grad / np.sqrt(total)
    return Field(languages, w.astype(np.float32), trans, start, lexicon)


def _gradients(e: np.ndarray, gold: np.ndarray, trans: np.ndarray, start: np.ndarray):
    """Expected minus observed counts of a batch: per word, per transition, per start."""
    n, length, n_lang = e.shape
    x = np.exp(e - e.max(axis=2, keepdims=True))
    move = np.exp(trans)
    alpha, beta = np.empty_like(x), np.ones_like(x)
    a = np.exp(start) * x[:, 0]
    alpha[:, 0] = a / a.sum(axis=1, keepdims=True)
    for t in range(1, length):
        a = (alpha[:, t - 1] @ move) * x[:, t]
        alpha[:, t] = a / a.sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        b = (beta[:, t + 1] * x[:, t + 1]) @ move.T
        beta[:, t] = b / b.sum(axis=1, keepdims=True)
    post = alpha * beta
    post /= post.sum(axis=2, keepdims=True)
    pairs = alpha[:, :-1, :, None] * move * (x * beta)[:, 1:, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    g_trans = pairs.sum(axis=(0, 1))
    np.add.at(g_trans, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), -1.0)
    g_start = post[:, 0].sum(axis=0) - np.bincount(gold[:, 0], minlength=n_lang)
    observed = np.zeros_like(post)
    np.put_along_axis(observed, gold[:, :, None], 1.0, axis=2)
    return post - observed, g_trans, g_start


def characteristic_words(marked: list[tuple[int, list[str]]], n_lang: int) -> dict[str, int]:
    """Word -> the language at least nine tenths of whose uses it has, for the most used of each language."""
    uses: dict[str, Counter] = {}
    for label, ws in marked:
        for w in ws:
            uses.setdefault(_core(w), Counter())[label] += 1
    own: dict[int, list[tuple[int, str]]] = {i: [] for i in range(n_lang)}
    for w, c in uses.items():
        (label, n), total = c.most_common(1)[0], sum(c.values())
        if w and n >= 3 and n >= 0.9 * total:
            own[label].append((-n, w))
    return {w: label for label, ws in own.items() for _, w in sorted(ws)[:LEXICON_WORDS]}


def learn(docs: DataFrame, train_on=None, docs_per_language: int = DOCS_PER_LANGUAGE) -> Field:
    """Fit on a bounded sample of ``docs`` (columns doc_id, text, lang) where ``train_on`` holds."""
    train_on = F.lit(True) if train_on is None else train_on
    rows = docs.filter(train_on & col("lang").isNotNull() & col("text").isNotNull() & col("doc_id").isNotNull())
    rows = rows.select(col("doc_id").alias("doc_id"), col("lang").cast("string").alias("lang"), col("text").alias("text"))
    counts = rows.groupBy("lang").count().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} distinct values of lang")
    if not counts:
        return fit([])
    # a first cut by hash leaves about twice the wanted documents of each language
    share = F.create_map(*[F.lit(x) for r in counts
                           for x in (r["lang"], min(1.0, (2.0 * docs_per_language + 50) / r["count"]))])
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))
    near = rows.filter(hashed < F.try_element_at(share, F.col("lang")) * 1_000_003)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (near.select("doc_id", "lang").withColumn("r", F.row_number().over(order))
           .filter(F.col("r") <= docs_per_language).select("doc_id", "lang").distinct())
    picked = near.join(F.broadcast(ids), ["doc_id", "lang"])  # ids: at most docs_per_language per language

    def cut(batches):
        for b in batches:
            langs, runs = [], []
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = text.split()
                n = min(SEGMENTS, -(-len(words) // SEGMENT_WORDS))
                for i in range(n):
                    at = i * max(0, len(words) - SEGMENT_WORDS) // max(1, n - 1)
                    langs.append(lang)
                    runs.append(words[at:at + SEGMENT_WORDS])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(runs, pa.list_(pa.string()))],
                                             names=["lang", "words"])

    # at most languages x docs_per_language x SEGMENTS runs of SEGMENT_WORDS words
    got = picked.select("lang", "text").mapInArrow(cut, "lang string, words array<string>").toArrow()
    segments = sorted(zip(got.column("lang").to_pylist(), got.column("words").to_pylist(), strict=True))
    return fit([s for s in segments if any(map(_LETTER.search, s[1]))])


_FIELDS: dict[str, Field] = worker_cache({})


def predict(docs: DataFrame, field: Field, *, text: str = "text", keep=("doc_id",), prefix: str = "") -> DataFrame:
    """``keep`` columns plus lang_pred and score of every text (names led by ``prefix``)."""
    # weights: BUCKETS x languages numbers, whatever the size of the corpus
    shared = docs.sparkSession.sparkContext.broadcast(
        (field.languages, field.weights, field.transitions, field.start, field.lexicon))
    key = uuid.uuid4().hex

    def make():
        if key not in _FIELDS:
            _FIELDS.clear()
            _FIELDS[key] = Field(*shared.value)
        return _FIELDS[key].predict

    fields = [T.StructField(prefix + "lang_pred", T.StringType()), T.StructField(prefix + "score", T.DoubleType())]
    return map_texts(docs, make, fields, text=text, keep=keep)
