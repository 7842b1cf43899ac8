"""Operator 3: near-duplicate documents by SuperMinHash, banding, verification and grouping.

A document's set is its distinct five-word shingles (with fewer words the
whole sequence as one). SuperMinHash draws, for every element, a random
permutation of the signature's slots with growing ranks; the ranks of one
element exclude each other, which lowers the variance against independent
hashes. Level by level, all elements of a batch place their next rank; a
document is finished as soon as no later level can lower any slot.

Documents with equal sets become one class first (one aggregation, whatever
the number of copies). Class signatures are cut into bands; in each bucket the
members are compared with the smallest one, on full sets. Buckets that the
links found leave in several components are searched for links across them
too: small ones pair by pair, crowded ones by an exact prefix filter on their
members' differences to what most of them share (``delta_marks``), so that loose
members of a large group of copies are not compared with all of it. Bands are
as many as the threshold asks for (``banding``): 24 of 6 ranks at 85 per cent,
29 of 5 at 80, so that a pair at the threshold meets in no bucket with
probability of about 1.2e-5 at most.

Inside, a class has a number of its own and its text is found by id and text
hash, so that rows of one id with different texts are documents of their own.

Cases: null, empty or wordless text has an empty set and is linked with
nothing. A null id gets a null component and is kept. Rows of equal id and
text are one document. Ties cannot arise: components are named by their
smallest id. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilekit.llm.components import components, written
from profilekit.llm.text import chain, claim, col, map_texts, mix, slices, trimmed, window_codes, word_codes
from profilekit.operators.joins import bounded_broadcast

WIDTH = 5
THRESHOLD = 85  # per cent, of the query
MISS = 1.25e-5    # probability at most that a pair at the threshold meets in no bucket
MOST_BANDS, MOST_ROWS = 32, 6
SLOTS = 1 << 22   # of the table of shingle uses
BIT_WORDS = 8     # 64-bit words of a difference's bit map
VOTERS = 64       # members of a hub, about, that make its pivot set
CROWD = 32        # classes in a bucket up to which all its open pairs are compared
_BINS = (-1.0, -0.75, -0.5, -0.25, 0.0, 0.25, 0.5, 0.75, 1.0, 1.25, 1.5, 2.0, 3.0, 4.0, 8.0)
_CHUNK = 150_000  # elements whose permutations are held at once
_LEVEL = 48       # bits of a rank below its level


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit codes of a text's shingles."""
    codes = word_codes(text)
    if 0 < len(codes) < WIDTH:
        return window_codes(codes, len(codes)) ^ np.uint64(len(codes))
    return np.unique(window_codes(codes, WIDTH))


def super_min_hash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash signatures (one row per non-empty set) as integers: level, then random bits."""
    out = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= _CHUNK):
            size += len(sets[end])
            end += 1
        _place(sets[at:end], out[at:end], slots)
        at = end
    return out


def _place(sets: list[np.ndarray], out: np.ndarray, slots: int) -> None:
    items = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = out.reshape(-1)
    perm = None
    for level in range(slots):
        with np.errstate(over="ignore"):
            rank = mix(items + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        pick = level + (mix(rank) % np.uint64(slots - level)).astype(np.int64)
        if perm is None:
            slot = first = pick
        else:
            rows = np.arange(len(items))
            slot = perm[rows, pick].astype(np.int64)
            perm[rows, pick] = perm[:, level]
            perm[:, level] = slot
        value = (np.uint64(level) << np.uint64(_LEVEL)) | (rank >> np.uint64(64 - _LEVEL))
        np.minimum.at(flat, owner * slots + slot, value)
        # a later level cannot lower a slot that holds a rank of this level or an earlier one
        going = (out.max(axis=1) >= np.uint64((level + 1) << _LEVEL))[owner]
        if not going.any():
            return
        items, owner = items[going], owner[going]
        if perm is None:
            perm = np.tile(np.arange(slots, dtype=np.uint16), (len(items), 1))
            rows, first = np.arange(len(items)), first[going]
            perm[rows, first] = 0
            perm[:, 0] = first
        else:
            perm = perm[going]


def banding(threshold: int) -> tuple[int, int]:
    """(bands, ranks of each): the most ranks whose bands are few and miss a pair at the threshold with at most ``MISS``."""
    for rows in range(MOST_ROWS, 0, -1):
        bands = math.ceil(math.log(MISS) / math.log1p(-(min(threshold, 99) / 100) ** rows))
        if bands <= MOST_BANDS:
            break
    return bands, rows


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    cut = signatures.reshape(len(signatures), bands, rows)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), cut.shape[:2])
    for r in range(rows):
        keys = chain(keys, cut[:, :, r])
    return keys


def sketches(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
             threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_digest (equal for equal sets) and band keys of every document."""
    fields = [T.StructField("n_shingles", T.LongType()), T.StructField("set_digest", T.BinaryType()),
              T.StructField("bands", T.ArrayType(T.LongType()))]
    n_bands, n_rows = banding(threshold)

    def make():
        def run(texts):
            sets = [shingle_set(t) for t in texts]
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(super_min_hash([sets[i] for i in full], n_bands * n_rows), n_bands, n_rows)
            ends = np.zeros(len(sets) + 1, np.int32)
            ends[1:] = np.cumsum([n_bands if len(s) else 0 for s in sets])
            bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1).astype(np.int64)))
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            return [[len(s) for s in sets], digests, bands]
        return run

    keyed = docs.select(col(doc_id).cast("long").alias("doc_id"), _text_hash(text).alias("text_hash"), col(text).alias("text"))
    return map_texts(keyed, make, fields, keep=("doc_id", "text_hash"))


def _text_hash(text: str):
    """Tells the texts of one id apart."""
    return F.xxhash64(col(text).cast("string"))


def verified(pairs: DataFrame, texts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough; ``texts``: id, text of all ids in them."""
    met = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
           .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
           .select("a", "b", F.col("ta").cast("binary"), F.col("tb").cast("binary")))

    @trimmed
    def compare(batches):
        claim(__name__)
        last, other = None, None  # neighbouring rows often share b
        for b in slices(batches, 2):
            keep = []
            for k, ta, tb in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(),
                                 strict=True):
                if k != last:
                    last, other = k, shingle_set(tb)
                own = shingle_set(ta)
                common = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(100 * common >= threshold * (len(own) + len(other) - common))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return met.mapInArrow(compare, "a long, b long")


def _slots(shingles: np.ndarray) -> np.ndarray:
    """The slot of each shingle."""
    return (mix(shingles) & np.uint64(SLOTS - 1)).astype(np.int64)


def delta_marks(own: np.ndarray, pivot: np.ndarray, uses: np.ndarray,
                threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray, int, int, np.ndarray, int]:
    """Marks of a set relative to a pivot set: two sets near each other share one, unless f + f' <= 0 (below).

    With the marks come the bin of partners that each is for, the set's own bin,
    f (below), a bit map of the difference's shingles and
    how many of them fell on a bit already set: of two sets with c common
    shingles in their differences, at least c less that number of bits are common.

    With d the size of a set's difference to the pivot, n its own and t the
    threshold, let f = (100 + t) d - (100 - t) n. Two sets are near iff their
    difference is at most (100 - t) / (100 + t) of the sum of their sizes; so
    if f + f' <= 0 they are, and each of them is near the set of smallest f,
    to which such sets are linked. Else their differences to the pivot must have
    (f + f') / (2 (100 + t)) shingles in common:
    a prefix filter over these differences, rare shingles first, finds all
    such pairs. ``uses`` counts, at least, the sets that hold a shingle's slot:
    an added shingle that no other set holds cannot be common. Partners are
    told apart by bins of f, as the prefix's length depends on it.
    """
    delta = np.setxor1d(own, pivot, assume_unique=True)
    f = (100 + threshold) * len(delta) - (100 - threshold) * len(own)
    count = uses[_slots(delta)]
    order = np.lexsort((delta, count))
    tokens = delta[order]
    shared = (count[order] > 1) | np.isin(tokens, pivot, assume_unique=True)
    borders = [int(x * (100 - threshold) * len(pivot)) for x in _BINS]
    mine = sum(f >= x for x in borders[1:])
    out, bins = [], []
    for other, low in enumerate(borders):
        if other + 1 < len(borders) and f + borders[other + 1] <= 0:
            continue
        need = max(1, -(-(f + low) // (2 * (100 + threshold))))
        if int(shared.sum()) < need:
            continue
        take = tokens[:len(tokens) - need + 1]
        take = take[shared[:len(take)]]
        if len(take):
            out.append(chain(take, np.full(len(take), min(mine, other) << 8 | max(mine, other), np.uint64)))
            bins.append(np.full(len(take), other, np.int8))
    bits = np.zeros(BIT_WORDS * 64, np.uint8)
    bits[(mix(delta) % np.uint64(len(bits))).astype(np.int64)] = 1
    return (np.concatenate(out) if out else np.empty(0, np.uint64), np.concatenate(bins) if bins else np.empty(0, np.int8),
            mine, f, np.packbits(bits).view(np.int64), len(delta) - int(bits.sum()))


def consensus(hubs: DataFrame, texts: DataFrame) -> DataFrame:
    """(pivot, shared): the shingles that most members of each hub have, as its pivot set; ``hubs``: id, pivot.

    Copies of one text differ from it by their own changes only, so differences to
    the common text are the smallest there are. About ``VOTERS`` members of a hub are
    asked: the result of the search does not depend on the pivot set, its work does.
    """
    sizes, _ = bounded_broadcast(hubs.groupBy("pivot").agg(F.count(F.lit(1)).alias("members")))
    every = F.ceil(F.col("members") / VOTERS)
    asked = hubs.join(sizes, "pivot").filter(F.pmod(F.xxhash64("id"), every) == 0).select("id", "pivot")

    def vote(table: pa.Table) -> pa.Table:
        sets = [shingle_set(t) for t in table.column("t").to_pylist()]
        found, n = np.unique(np.concatenate(sets), return_counts=True)
        common = pa.array([found[2 * n > len(sets)].view(np.int64)], pa.list_(pa.int64()))
        return pa.table({"pivot": table.column("pivot")[:1], "shared": common})

    voters = asked.join(texts, "id").select("pivot", F.col("text").cast("binary").alias("t"))
    return voters.groupBy("pivot").applyInArrow(vote, "pivot long, shared array<long>")


def pivot_marks(spokes: DataFrame, texts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(id, pivot, marks, others, bin, f, bits, twice) for the rows (id, pivot); a mark belongs to one pivot.

    ``others`` has the bin of partners that each mark is for, ``bin`` is the row's own.

    Pivot sets are those of ``consensus``; a hub without one has the empty set.
    """
    held = texts.join(spokes.select("id").distinct(), "id", "left_semi")

    @trimmed
    def slots(batches):
        claim(__name__)
        seen = np.zeros(SLOTS, np.int32)
        for b in slices(batches, 0):
            for t in b.column(0).to_pylist():
                np.add.at(seen, _slots(shingle_set(t)), 1)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(seen[used].astype(np.int64))], names=["slot", "n"])

    # a table of fixed size: at most SLOTS pairs of numbers, whatever the corpus
    found = (held.select(F.col("text").cast("binary")).mapInArrow(slots, "slot int, n long")
             .groupBy("slot").agg(F.least(F.sum("n"), F.lit(30_000)).cast("short").alias("n")).toArrow())
    uses = np.zeros(SLOTS, np.uint16)
    uses[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(uses)
    sets, _ = bounded_broadcast(consensus(spokes, texts))
    met = (spokes.join(texts.select("id", F.col("text").alias("t")), "id").join(sets, "pivot", "left")
           .select("id", "pivot", F.col("t").cast("binary"), "shared"))

    @trimmed
    def mark(batches):
        claim(__name__)
        last, pivot = None, None  # neighbouring rows often share the pivot
        for b in slices(batches, 2):
            out, bins, sums = [], [], []
            for k, (p, t) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                if p != last:
                    held = b.column(3)[k].values
                    last, pivot = p, np.empty(0, np.uint64) if held is None else held.to_numpy().view(np.uint64)
                marks, others, *rest = delta_marks(shingle_set(t), pivot, shared.value, threshold)
                sums.append(rest)
                bins.append(others)
                out.append(chain(marks, np.full(len(marks), p, np.int64).view(np.uint64)).view(np.int64))
            own, f, bits, twice = zip(*sums, strict=True) if sums else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.list_(pa.int64())), pa.array(bins, pa.list_(pa.int8())),
                 pa.array(own, pa.int8()), pa.array(f, pa.int64()), pa.array(bits, pa.list_(pa.int64())),
                 pa.array(twice, pa.int64())],
                names=["id", "pivot", "marks", "others", "bin", "f", "bits", "twice"])

    return met.mapInArrow(mark, "id long, pivot long, marks array<long>, others array<byte>, bin byte, f long, "
                                "bits array<long>, twice long")


def open_marks(deltas: DataFrame, placed: DataFrame) -> DataFrame:
    """(key, id, n, g, f, bits, twice): the marks by which a row may meet one of another component; ``placed``: id, n, g.

    A mark is for partners of one bin: it is left out where that bin of the row's pivot holds
    no row of another component, so what most members of a crowd would have to look for
    among themselves, though they are linked already, is never written out.
    """
    rows = deltas.join(placed, "id")
    held = (rows.groupBy("pivot", "bin").agg(F.min("g").alias("lo"), F.max("g").alias("hi"))
            .groupBy("pivot").agg(F.map_from_entries(F.collect_list(F.struct("bin", F.struct("lo", "hi")))).alias("held")))
    held, _ = bounded_broadcast(held)

    def open_to(mark):
        found = F.try_element_at("held", mark["others"])
        return F.coalesce((found["lo"] != F.col("g")) | (found["hi"] != F.col("g")), F.lit(False))

    kept = F.array_distinct(F.transform(F.filter(F.arrays_zip("marks", "others"), open_to), lambda m: m["marks"]))
    return (rows.join(held, "pivot").withColumn("kept", kept)
            .select("id", "n", "g", "f", "bits", "twice", F.explode("kept").alias("key"))
            .select("key", "id", "n", "g", "f", "bits", "twice"))


def _can_share(a: str, b: str, threshold: int):
    """Whether the bit maps of two differences leave room for the shingles they must have in common."""
    common = sum((F.bit_count(F.col(f"{a}bits")[i].bitwiseAND(F.col(f"{b}bits")[i])) for i in range(BIT_WORDS)), F.lit(0))
    needed = F.ceil((F.col(f"{a}f") + F.col(f"{b}f")) / (2 * (100 + threshold)))
    return F.coalesce(common >= needed - F.least(f"{a}twice", f"{b}twice"), F.lit(True))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                    threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document; ``threshold``: similarity of a link in per cent."""
    found = grouped(docs, doc_id=doc_id, text=text, threshold=threshold).select("doc_id", "n_shingles", "component_id")
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def grouped(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and group (a number; null: linked with nothing) of every document."""
    sketch, _ = written(sketches(docs, doc_id=doc_id, text=text, threshold=threshold), "sketches")
    classes, _ = written(
        sketch.filter("n_shingles > 0 and doc_id is not null").groupBy("set_digest")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("of"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
        .withColumn("id", F.col("of.doc_id")), "classes")
    # a class is known by its smallest id; classes of one id (texts that differ) get numbers of their own
    twins, seen = written(classes.groupBy("id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select(F.col("id").alias("twin")),
                          "twins", F.count(F.lit(1)).alias("n"))
    several = bool(seen.get("n"))
    if several:
        side, _ = bounded_broadcast(twins)
        classes, _ = written(classes.join(side, classes["id"] == side["twin"], "left").withColumn(
            "id", F.when(F.col("twin").isNotNull(), F.xxhash64("set_digest")).otherwise(F.col("id"))).drop("twin"), "classes")
    members = classes.select("id", "n", F.explode("bands").alias("key"))
    # first the smallest member of each bucket against the others
    centres = (members.groupBy("key").agg(F.min_by(F.struct("id", "n"), F.col("id")).alias("c"),
                                          F.count(F.lit(1)).alias("size")).filter("size > 1")
               .select("key", F.col("c.id").alias("b"), F.col("c.n").alias("nb")))
    near_size = F.lit(100) * F.least("n", "nb") >= F.lit(threshold) * F.greatest("n", "nb")
    first, _ = written(members.join(centres, "key").filter((F.col("id") != F.col("b")) & near_size)
                       .select(F.col("id").alias("a"), "b").distinct(), "pairs")
    # texts of the documents in buckets of several classes, once
    crowded = members.join(centres.select("key"), "key").select("id").distinct()
    ids, _ = bounded_broadcast(crowded)
    wanted = classes.join(ids, "id", "left_semi").select("id", F.col("of.doc_id").alias("w"), F.col("of.text_hash").alias("h"))
    source = docs.select(col(doc_id).cast("long").alias("w"), _text_hash(text).alias("h"), col(text).cast("string").alias("text"))
    side, _ = bounded_broadcast(wanted)
    # a row per class: repeated rows must not multiply in the joins
    texts, _ = written(source.join(side, ["w", "h"]).select("id", "text").dropDuplicates(["id"]), "texts")
    links, _ = written(verified(first, texts, threshold), "links")
    group = components(links)
    # buckets still in several components: pairs across them that are not yet compared
    placed = members.join(group, "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("g"))
    opened = (placed.groupBy("key").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.min("id").alias("pivot"),
                                        F.count(F.lit(1)).alias("size")).filter("lo < hi").select("key", "pivot", "size"))
    loose, _ = written(placed.join(opened, "key"), "open-buckets")
    spokes, many = written(loose.filter(F.col("size") > CROWD).select("id", "pivot").distinct(), "spokes",
                           F.count(F.lit(1)).alias("n"))
    more_links = None
    # in small buckets all pairs, in crowded ones those with a common mark
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("f", "long"), ("bits", "array<long>"), ("twice", "long"))]
    shared = loose.filter(F.col("size") <= CROWD).select("key", "id", "n", "g", *nothing)
    if many["n"]:
        # crowded buckets with common members get one pivot set: one difference per class
        hubs = components(spokes.select(F.col("id").alias("a"), F.col("pivot").alias("b")))
        deltas, _ = written(pivot_marks(hubs.withColumnRenamed("component", "pivot"), texts, threshold), "deltas")
        best, _ = bounded_broadcast(deltas.groupBy("pivot").agg(F.min(F.struct("f", "id")).alias("r")))
        sure = deltas.join(best, "pivot").filter((F.col("f") + F.col("r.f") <= 0) & (F.col("id") != F.col("r.id")))
        more_links, _ = written(sure.select(F.col("id").alias("a"), F.col("r.id").alias("b")), "links")
        # what those links join needs no more comparing
        group = components(links.unionByName(more_links))
        loose, _ = written(loose.drop("g").join(group, "id", "left").select(
            "key", "id", "n", F.coalesce("component", "id").alias("g"), "pivot", "size"), "open-buckets")
        shared = loose.filter(F.col("size") <= CROWD).select("key", "id", "n", "g", *nothing)
        marks, _ = written(open_marks(deltas, loose.select("id", "n", "g").distinct()), "marks")
        split = marks.groupBy("key").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).filter("lo < hi").select("key")
        shared = shared.unionByName(marks.join(split, "key"))
    left, _ = written(shared, "open-marks")
    right = left.select("key", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("g").alias("gb"),
                        *[F.col(c).alias(f"b{c}") for c in ("f", "bits", "twice")])
    rest = (left.join(right, "key")
            .filter((F.col("id") > F.col("b")) & (F.col("g") != F.col("gb")) & near_size & _can_share("", "b", threshold))
            .select(F.col("id").alias("a"), "b").distinct().join(first, ["a", "b"], "left_anti"))
    rest, seen = written(rest, "pairs", F.count(F.lit(1)).alias("n"))
    if seen["n"]:
        found, _ = written(verified(rest, texts, threshold), "links")
        more_links = found if more_links is None else more_links.unionByName(found)
    if more_links is not None:
        group = components(links.unionByName(more_links))
    named = classes.select("set_digest", "id", "of.doc_id").join(group, "id", "left").select(
        "set_digest", "doc_id", F.coalesce("component", "id").alias("group"))
    if several:  # a component is named by the smallest id of all its documents
        names = named.groupBy("group").agg(F.min("doc_id").alias("component_id"))
        named = named.select("set_digest", "group").join(names, "group")
    else:
        named = named.select("set_digest", "group", F.col("group").alias("component_id"))
    known = F.col("doc_id").isNotNull()
    return sketch.join(named, "set_digest", "left").select(
        "doc_id", "text_hash", "n_shingles", F.when(known, F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.when(known, F.col("group")).alias("group"))
