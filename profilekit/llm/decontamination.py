"""Operator 10: benchmark decontamination by template canonicalisation.

Words become typed placeholders where they are what a re-parameterised copy
would change: numbers (digits or number words), names (capitalised;
neighbouring ones of a sentence are one) and units behind a number. A
capitalised word that opens a sentence is a name unless it is a common opener
or the benchmark has it in lower case at least as often as capitalised inside
a sentence (a word it does not have cannot match as a literal). What is left,
lower-cased and without edge punctuation, are literals. Five-token windows of
these templates are hashed; windows with fewer than ``LITERALS`` literals say
too little and are not used. Documents' windows that a fixed-size bit table of
the benchmark's windows lets through are joined with them by hash; items with
at least 80 per cent of their windows in a document are candidates, and those
that lose no more windows than one changed token in ten (at least one) can
break. Each candidate is then aligned with the item's template: the windows
must match as templates (not only as hashes), tokens between them are held
against the places that follow on, 80 per cent of the windows, or of the tokens
near one place, must be met, and the placeholders' values must change
consistently: one value in the item always stands for one value in the document.
Beside the templates, windows of the case-folded words themselves (five, or all
an item has) find the documents that hold an item word for word at any place,
also items with too few literals or tokens for a template.

Cases: null, empty or short texts: an item with fewer than five tokens is one
template window of all its tokens (at least three or all of them literals),
looked for in documents of just as many tokens; word for word it is found
anywhere. An item of placeholders alone matches nothing. Repeated rows give repeated results; rows of null id are not
reported (a filter keeps them). Empty tables give no rows. All windows of
whole texts are used; a window in every document is one row per document.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilekit.llm.components import written
from profilekit.llm.text import blocks, claim, col, crc32, map_texts, mix, span_codes, word_codes, word_spans
from profilekit.operators.joins import bounded_broadcast

WIDTH, SHARE, LITERALS, CONSISTENT = 5, 0.8, 3, 0.8
TOKENS_A_CHANGE = 10  # tokens of an item for each changed literal its candidates may have
TABLE_BITS = 1 << 22  # of the bit table: half a megabyte, whatever the benchmark's size

# Word lists (fixed values).
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split())
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "kilometre kilometres mg g kg gram grams kilogram kilograms lb lbs oz pound pounds ounce ounces ton tons ml l liter "
    "liters litre litres gallon gallons cup cups ms s sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years dollar dollars euro euros cent cents percent degree degrees watt watts volt "
    "volts kmh mph".split())
OPENERS = frozenset(
    "a after all also an and another any are as at because before both but by can could did do does during each every find "
    "first for from given has have he her his how however i if in is it its let many most my no not of on one or our she "
    "should since so some that the their then there these they this those though to under until was we were what when where "
    "which while who whose why will with would you your".split())

_EDGES = re.compile(r"^\W+|\W+$")
NUM, NAME, UNIT = (np.uint64(crc32(x)) for x in (b"<number>", b"<name>", b"<unit>"))


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a:b + 1] = True
    return out


_CORE = _table((48, 57), (65, 90), (97, 122), (128, 255))  # bytes of letters and digits, and of all beyond ASCII
_DIGIT, _STOP = _table((48, 57)), _table(*[(ord(c), ord(c)) for c in ".!?:;"])


def _codes_of(words) -> np.ndarray:
    text = " ".join(sorted(words)).encode()
    return np.sort(word_codes(text))


_NUMBERS, _UNITS, _OPENERS = _codes_of(NUMBER_WORDS), _codes_of(UNITS), _codes_of(OPENERS)
_ORDINAL = re.compile(rb"\d+(?:st|nd|rd|th)", re.I).fullmatch


def _among(codes: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    return known[at] == codes


def _core_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes are letters or digits; Latin-1 signs and the general punctuation block are not."""
    core = _CORE[data]
    if len(data) and data.max() >= 0xC2:
        for at in np.flatnonzero(data[:-1] == 0xC2):
            core[at:at + 2] = False
        for at in np.flatnonzero((data[:-2] == 0xE2) & ((data[1:-1] & 0xFE) == 0x80)):
            core[at:at + 3] = False
    return core


_PLACES = np.asarray([(k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1) for k in range(WIDTH)], np.uint64)

_FOLDED = 0x2545F4914F6CDD1D  # sets hashes of words apart from those of templates


class Template:
    """Tokens of a text: code (placeholder or literal), whether literal, and the words each covers.

    ``plain``: sorted codes of the words that are no names where they open a sentence.
    """

    def __init__(self, text: bytes | None, plain: np.ndarray = _OPENERS):
        self.text = text = text or b""
        parts = [_tokens(b) for b in blocks(text)]
        if not parts:
            parts = [_tokens(b"")]
        self.n_words = sum(p[0] for p in parts)
        offsets = np.cumsum([0, *[p[0] for p in parts[:-1]]])
        place = np.concatenate([p[1] + o for p, o in zip(parts, offsets, strict=True)])
        codes, digits, capital, ends = (np.concatenate([p[k] for p in parts]) for k in range(2, 6))
        number = digits | _among(codes, _NUMBERS)
        before = np.zeros(len(codes), bool)
        before[1:] = number[:-1]
        unit = before & ~number
        unit[unit] = _among(codes[unit], _UNITS)
        opens = np.ones(len(codes), bool)
        opens[1:] = ends[:-1]
        name = capital & ~(number | unit)
        at = np.flatnonzero(name & opens)
        name[at] = ~_among(codes[at], plain)
        first = np.ones(len(codes), bool)
        first[1:] = ~(name[1:] & name[:-1] & ~opens[1:])
        literal = ~(number | unit | name)
        self.folded = codes
        codes = np.where(number, NUM, np.where(unit, UNIT, np.where(name, NAME, codes)))
        self.codes, self.literal, self.starts = codes[first], literal[first], place[first]

    def value(self, i: int) -> bytes:
        """The words of token ``i``, lower-cased, without edge punctuation."""
        if not hasattr(self, "words"):
            self.words = self.text.split()
        end = self.starts[i + 1] if i + 1 < len(self.starts) else self.n_words
        return b" ".join(_EDGES.sub("", w.decode()).lower().encode() for w in self.words[self.starts[i]:end]).strip()

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, start) of the usable windows of ``width`` tokens."""
        n = len(self.codes) - width + 1
        if n <= 0 or width < 1:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        # a position's code and place in the window give one scrambled term; the window's hash is their sum
        h = np.zeros(n, np.uint64)
        for k in range(width):
            h += mix(self.codes[k:k + n] + _PLACES[k])
        literals = np.concatenate([[0], np.cumsum(self.literal, dtype=np.int32)])
        at = np.flatnonzero(literals[width:] - literals[:n] >= min(LITERALS, width))
        return h[at] + np.uint64(width), at

    def folded_windows(self, width: int) -> np.ndarray:
        """Hashes of all windows of ``width`` case-folded words."""
        n = len(self.folded) - width + 1
        if n <= 0 or width < 1:
            return np.empty(0, np.uint64)
        h = np.full(n, _FOLDED + width, np.uint64)
        for k in range(width):
            h += mix(self.folded[k:k + n] + _PLACES[k])
        return h

    def holds(self, item: Template) -> bool:
        """Whether the item's case-folded words follow on each other here; they must not be placeholders alone."""
        n = len(item.folded)
        if not item.literal.any() or n > len(self.folded):
            return False
        spots = np.arange(len(self.folded) - n + 1)
        for k in range(n):
            if not len(spots):
                return False
            spots = spots[self.folded[spots + k] == item.folded[k]]
        return len(spots) > 0


def _tokens(block: bytes):
    """(words, place of each token, code, all digits, capital, ends a sentence) of one block; bare signs are no tokens."""
    low = block.decode().lower().encode()
    if len(low) != len(block):  # a letter whose lower case is longer: ASCII case only
        low = block.lower()
    data, own = np.frombuffer(low, np.uint8), np.frombuffer(block, np.uint8)
    starts, ends = word_spans(own)
    core = _core_bytes(own)
    solid = np.flatnonzero(core)
    # first and last letter or digit of each word
    before = np.zeros(len(own) + 1, np.int32)
    np.cumsum(core, out=before[1:])
    left, right = before[starts], before[ends] - 1
    kept = np.flatnonzero(left <= right)
    if not len(kept):
        return len(starts), kept, np.empty(0, np.uint64), *[np.zeros(0, bool)] * 3
    a, b, e = solid[left[kept]], solid[right[kept]] + 1, ends[kept]
    codes = span_codes(data, a, b)
    digits = np.zeros(len(a), bool)
    for k in np.flatnonzero(_DIGIT[own[a]]):  # words that start with a digit: digits and signs only, or an ordinal
        inside = own[a[k]:b[k]]
        digits[k] = not (_CORE[inside] & ~_DIGIT[inside]).any() or _ORDINAL(inside.tobytes()) is not None
    changed = own != data
    capital = changed[a] | changed[np.minimum(a + 1, len(own) - 1)] & (own[a] >= 0xC2)
    stop = (b < e) & (_STOP[own[np.minimum(b, len(own) - 1)]] | _STOP[own[e - 1]])
    return len(starts), kept, codes, digits, capital, stop


def item_width(template: Template) -> int:
    """Window width for an item: five tokens, or all it has."""
    return min(WIDTH, len(template.codes))


def plain_words(benchmark: DataFrame, text: str = "text") -> np.ndarray:
    """Sorted codes of words that are no names where they open a sentence: fixed ones, and by their use in the benchmark."""
    def count(batches):
        claim(__name__)
        for b in batches:
            low, high = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for t in b.column(0).to_pylist():
                for block in blocks(t or b""):
                    _, _, codes, _, capital, ends = _tokens(block)
                    inside = np.zeros(len(codes), bool)
                    inside[1:] = ~ends[:-1]
                    low.append(codes[~capital])
                    high.append(codes[capital & inside])
            parts = [np.unique(np.concatenate(x), return_counts=True) for x in (low, high)]
            words = np.concatenate([w for w, _ in parts]).view(np.int64)
            n = [c for _, c in parts]
            zeros = [np.zeros(len(c), np.int64) for c in n]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words), pa.array(np.concatenate([n[0], zeros[1]])), pa.array(np.concatenate([zeros[0], n[1]]))],
                names=["word", "low", "high"])

    # at most the benchmark's words, eight bytes each
    found = (benchmark.select(col(text).cast("string").cast("binary").alias("t"))
             .mapInArrow(count, "word long, low long, high long").groupBy("word")
             .agg(F.sum("low").alias("low"), F.sum("high").alias("high"))
             .filter("low > 0 and low >= high").select("word").toArrow())
    return np.union1d(_OPENERS, found.column("word").to_numpy().view(np.uint64))


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
                 plain: np.ndarray = _OPENERS) -> DataFrame:
    """(item_id, width, n_tokens, windows, folded_width, folded): distinct window hashes of every item, of both kinds."""
    def make():
        def run(texts):
            templates = [Template(t, plain) for t in texts]
            widths = [item_width(t) for t in templates]
            spans = [min(WIDTH, len(t.folded)) if t.literal.any() else 0 for t in templates]
            return [widths, [len(t.codes) for t in templates], [np.unique(t.windows(w)[0]).astype(np.int64)
                                                                for t, w in zip(templates, widths, strict=True)],
                    spans, [np.unique(t.folded_windows(w)).astype(np.int64) for t, w in zip(templates, spans, strict=True)]]
        return run

    src = benchmark.select(col(item_id).alias("item_id"), col(text).alias("text")).filter("item_id is not null")
    fields = [T.StructField("width", T.IntegerType()), T.StructField("n_tokens", T.IntegerType()),
              T.StructField("windows", T.ArrayType(T.LongType())), T.StructField("folded_width", T.IntegerType()),
              T.StructField("folded", T.ArrayType(T.LongType()))]
    return map_texts(src, make, fields, keep=("item_id",))


def _bit(hashes):
    return hashes & np.uint64(TABLE_BITS - 1)


def find(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, overlap, exact, n_slots, consistency."""
    spark = docs.sparkSession
    plain = plain_words(benchmark, item_text)
    items, _ = written(item_windows(benchmark, item_id, item_text, plain), "benchmark-windows")
    n = F.size("windows")
    # windows a candidate must have: a share of them, or all that some changed tokens leave
    changed = F.greatest(F.lit(1), F.floor(F.col("n_tokens") / TOKENS_A_CHANGE))
    need = F.greatest(F.lit(1), F.least(F.ceil(F.lit(SHARE) * n), n - WIDTH * changed))
    rows = (items.select("item_id", need.alias("need"), F.lit(False).alias("words"), F.explode("windows").alias("window"))
            .unionByName(items.select("item_id", F.size("folded").cast("long").alias("need"), F.lit(True).alias("words"),
                                      F.explode("folded").alias("window"))))
    # set bits of the table: at most TABLE_BITS small numbers
    set_bits = rows.select(F.col("window").bitwiseAND(F.lit(TABLE_BITS - 1)).cast("int").alias("bit")).distinct().toArrow()
    table = np.zeros(TABLE_BITS // 8, np.uint8)
    bits = set_bits.column("bit").to_numpy()
    np.bitwise_or.at(table, bits >> 3, (1 << (bits & 7)).astype(np.uint8))
    widths, spans = (sorted(r[0] for r in items.select(c).distinct().collect() if r[0])  # 1 to WIDTH
                     for c in ("width", "folded_width"))
    shared, openers = spark.sparkContext.broadcast(table), spark.sparkContext.broadcast(plain)

    def make():
        flat = shared.value

        def run(texts):
            out = []
            for t in texts:
                template, found = Template(t, openers.value), []
                kinds = [template.windows(w)[0] for w in widths if w == WIDTH or len(template.codes) == w]
                for h in [*kinds, *map(template.folded_windows, spans)]:
                    bit = _bit(h)
                    found.append(h[(flat[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1])
                out.append(np.unique(np.concatenate(found)).astype(np.int64) if found else np.empty(0, np.int64))
            return [out]
        return run

    source = docs.select(col(doc_id).alias("doc_id"), col(text).cast("string").alias("text")).filter("doc_id is not null")
    hits = (map_texts(source, make, [T.StructField("windows", T.ArrayType(T.LongType()))])
            .filter(F.size("windows") > 0).select("doc_id", F.explode("windows").alias("window")))
    pairs = (hits.distinct().join(rows, "window").groupBy("doc_id", "item_id", "words")
             .agg(F.count(F.lit(1)).alias("n"), F.first("need").alias("need"))
             .filter("n >= need").select("doc_id", "item_id").distinct())
    pairs, _ = written(pairs, "leak-candidates")
    ids, _ = bounded_broadcast(pairs.select("doc_id").distinct())
    texts = source.join(ids, "doc_id", "left_semi")
    item_texts = (benchmark.select(col(item_id).alias("item_id"), col(item_text).cast("string").alias("item_text"))
                  .filter("item_id is not null"))
    both = pairs.join(texts, "doc_id").join(item_texts, "item_id")
    compared = both.select("doc_id", "item_id", F.col("text").cast("binary"), F.col("item_text").cast("binary"))
    out = T.StructType([compared.schema["doc_id"], compared.schema["item_id"],
                        *[T.StructField(n, t) for n, t in _RESULT]])

    def check(batches):
        claim(__name__)
        last, template = None, None
        for b in batches:
            made = []
            for t, i in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if template is None or t != last:
                    last, template = t, Template(t, openers.value)
                made.append(align(Template(i, openers.value), template))
            cols = list(zip(*made, strict=True)) if made else [[]] * len(_RESULT)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *[pa.array(c, type=k) for c, k in zip(cols, _ARROW, strict=True)]],
                names=out.names)

    found = compared.mapInArrow(check, out)
    return found.filter((F.col("overlap") >= SHARE) & (F.col("consistency") >= CONSISTENT))


_RESULT = [("overlap", T.DoubleType()), ("exact", T.BooleanType()), ("n_slots", T.LongType()),
           ("consistency", T.DoubleType())]
_ARROW = [pa.float64(), pa.bool_(), pa.int64(), pa.float64()]


def align(item: Template, doc: Template) -> tuple[float, bool, int, float]:
    """(share of the item in the document, same values throughout, slots met, consistent share).

    The share is that of its windows or, if more, of its tokens met near one
    place: within the item's length of the commonest shift. An item the
    document holds word for word is met as a whole.

    The consistent share is over the slots whose value the item repeats: of
    each value's slots, those with its most frequent counterpart.

    Windows that occur several times in the document are read at the place
    that follows on from the window before, else at their first place.
    """
    width = item_width(item)
    wanted, at = item.windows(width)
    have, places = doc.windows(width)
    order = np.argsort(have, kind="stable")
    ranked = have[order]
    met: dict[int, int] = {}  # item token -> document token
    matched = 0
    shift = None
    for h, i in zip(wanted, at, strict=True):
        lo, hi = np.searchsorted(ranked, h, "left"), np.searchsorted(ranked, h, "right")
        spots = [int(p) for p in places[order[lo:hi]]
                 if (item.codes[i:i + width] == doc.codes[p:p + width]).all()]
        if not spots:
            continue
        matched += 1
        spot = int(i) + shift if shift is not None and int(i) + shift in spots else spots[0]
        shift = spot - int(i)
        for k in range(width):
            met.setdefault(int(i) + k, spot + k)
    nearby = _filled(item, doc, met)
    share = max(matched / len(wanted), nearby / len(item.codes)) if len(wanted) else 0.0
    slots = [(item.value(i), doc.value(d)) for i, d in met.items() if not item.literal[i]]
    uses: dict[bytes, Counter] = {}
    for own, other in slots:
        uses.setdefault(own, Counter())[other] += 1
    repeated = [c for c in uses.values() if c.total() > 1]
    agreed, checked = sum(c.most_common(1)[0][1] for c in repeated), sum(c.total() for c in repeated)
    consistency = agreed / checked if checked else 1.0
    if (share < SHARE or consistency < CONSISTENT) and doc.holds(item):
        return 1.0, True, int((~item.literal).sum()), 1.0
    return share, all(a == b for a, b in slots), len(slots), consistency


def _filled(item: Template, doc: Template, met: dict[int, int]) -> int:
    """Adds to ``met`` equal tokens beside and between the met ones; how many are met near the commonest shift."""
    if not met:
        return 0
    n = len(item.codes)
    shifts, after = [None] * n, None
    for i in range(n):  # shift of the next met token before, then of the one behind
        after = met[i] - i if i in met else after
        shifts[i] = [after]
    after = None
    for i in range(n - 1, -1, -1):
        after = met[i] - i if i in met else after
        shifts[i].append(after)
    common = Counter(d - i for i, d in met.items()).most_common(1)[0][0]
    for i in range(n):
        if i not in met:
            for shift in shifts[i]:
                d = -1 if shift is None else i + shift
                if 0 <= d < len(doc.codes) and doc.codes[d] == item.codes[i]:
                    met[i] = d
                    break
    return sum(abs(d - i - common) <= n for i, d in met.items())
