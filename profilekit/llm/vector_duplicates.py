"""Operator 8: near-duplicate vectors by a random-projection tree forest.

Every tree splits the vectors again and again at the median of a random
projection; a vector closer to the split than a margin goes to both sides
(spill), so a close pair is separated in one tree with a small probability
and in all trees with a negligible one. A node is split on, whatever the size
of the table, until it holds few vectors or until a split would save hardly
any comparisons, as among near copies, which no projection parts.

Each tree is a step of its own, so one tree's copies are on disk at a time.
Its upper part is fitted on a sample of a label's vectors and deals them to
cells of some ten thousand, many vectors to a row; its lower part is grown in
the task that gets the cell, on all the vectors there. A label no larger than
a cell is one cell, with all its trees in one step, and a small one is
compared pair by pair. A step returns no pairs, only who hangs together: what
is already known to do so is not compared again, so near copies cost a cell
little more than a pass over them.

Components come from these links over all steps. A vector's links are then
counted among all vectors of its component, which comes to one task, so a pair
counts once and counts even if no leaf held it. Components past ``GROUP``
vectors get a forest of their own and are compared in blocks of about
``BLOCK``; a pair counts in the first leaf that its two vectors share.

Cosines are taken in single precision and, where its error could decide, again
in double precision. Equal vectors of one label are one weighted class.

Cases: vectors that are null, empty, zero or hold null or non-finite numbers,
and null labels, link with nothing; vectors of different length never link.
Rows of equal vec_id are one vector (the smallest label and bytes); a null
vec_id links with nothing, has a null component and is kept. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilekit.llm.components import components, written
from profilekit.llm.text import batches_of, col
from profilekit.operators.joins import bounded_broadcast
from profilekit.session import scratch, shared_path, shuffles_freed

COSINE = 0.98
TREES = 6
SPILL = 0.6          # margin, in spreads of the projected distance of a pair at the threshold
SAMPLE = 20_000      # vectors the splits of upper trees are fitted on, more for tables of many cells
MOST_SAMPLE = 200_000
SAMPLE_BYTES = 64_000_000
CELL_SAMPLE = 32     # sampled vectors a cell should have
LEAST_SAMPLE = 16    # sampled vectors below which a node is not split
CELL = 60_000        # vectors a task should hold at once ...
CELL_BYTES = 16_000_000  # ... and their bytes
EXACT = 8_000        # vectors of a label that are compared pair by pair
LEAF = 600           # vectors a leaf should hold
WORTH = 0.8          # share of a node's comparisons that its children may have together
FEW = 1_000          # vectors below which labels share a row when dealt
GROUP = 32_000       # vectors of a component that are compared in one task ...
GROUP_BYTES = 64_000_000  # ... and their bytes
BLOCK = 2048
ROWS = 256           # rows of one matrix product ...
PRODUCT = 8_000_000  # ... and its cosines
SMALL = 512          # rows of small groups that are compared together


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Unit vectors (float64) of the rows."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # keeps squares of extreme numbers finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The bytes of a column of ``size`` bytes a value, a row for each."""
    if not len(column):
        return np.empty((0, size), np.uint8)
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], np.uint8, size * len(column), first).reshape(-1, size)


def binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column over ``data``: value i ends at ``ends[i]`` bytes."""
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


class Vectors:
    """Raw vectors of one length with their unit vectors."""

    def __init__(self, raw: np.ndarray, dtype: str):
        self.numbers = raw.view(dtype)
        self.unit = np.empty(self.numbers.shape, np.float32)
        for at in range(0, len(raw), 4096):
            self.unit[at:at + 4096] = unit_rows(self.numbers[at:at + 4096])
        self.error = 1.2e-7 * (self.unit.shape[1] + 8)  # bound of a single-precision cosine's error

    def near(self, a: np.ndarray, b: np.ndarray, unit: np.ndarray | None = None) -> np.ndarray:
        """Which pairs of the rows ``a`` and ``b`` (with their unit vectors, if at hand) are at the threshold."""
        cosines = self.unit[a] @ (self.unit[b] if unit is None else unit).T
        near = cosines >= COSINE - self.error
        if near.any():
            unsure = np.flatnonzero((near & (cosines < COSINE + self.error)).ravel())
            for at in range(0, len(unsure), 10_000):
                some = unsure[at:at + 10_000]
                i, j = np.divmod(some, len(b))
                near.ravel()[some] = (unit_rows(self.numbers[a[i]]) * unit_rows(self.numbers[b[j]])).sum(axis=1) >= COSINE
        return near


def margin(dim: int) -> float:
    """How far from a split a vector goes to both sides."""
    return SPILL * math.sqrt(2 - 2 * COSINE) / math.sqrt(dim)


def halves(x: np.ndarray, rng) -> tuple[np.ndarray, float, np.ndarray, np.ndarray] | None:
    """(direction, split, rows below, rows above) of a node's vectors; None if no split saves comparisons."""
    edge = margin(x.shape[1])
    for _ in range(2):
        direction = rng.standard_normal(x.shape[1])
        direction = (direction / np.linalg.norm(direction)).astype(np.float32)
        p = x @ direction
        split = float(np.median(p[::max(1, len(p) // 2000)]))
        low, high = np.flatnonzero(p <= split + edge), np.flatnonzero(p >= split - edge)
        if len(low) ** 2 + len(high) ** 2 < WORTH * len(x) ** 2:
            return direction, split, low, high
    return None


class Tree:
    """Directions, split points and children of one tree; leaves are numbered, with the vectors they should hold."""

    def __init__(self, sample: np.ndarray, scale: float, seed: list[int], most: float):
        rng = np.random.default_rng(seed)
        self.margin = margin(sample.shape[1])
        self.directions: list[np.ndarray] = []
        self.splits: list[float] = []
        self.children: list[tuple[int, int]] = []  # >= 0: node, < 0: leaf -1 - n
        self.holds: list[float] = []
        self.root = self._grow(sample, scale, rng, most)

    def _grow(self, x: np.ndarray, scale: float, rng, most: float) -> int:
        if len(x) * scale > most and len(x) >= LEAST_SAMPLE and (found := halves(x, rng)):
            direction, split, low, high = found
            node = len(self.splits)
            self.directions.append(direction)
            self.splits.append(split)
            self.children.append((0, 0))
            self.children[node] = (self._grow(x[low], scale, rng, most), self._grow(x[high], scale, rng, most))
            return node
        self.holds.append(max(1, len(x)) * scale)
        return -len(self.holds)

    def leaves(self, x: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """(rows, leaf) of every leaf that rows of ``x`` fall into."""
        out, todo = [], [(np.arange(len(x)), self.root)]
        while todo:
            rows, node = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                out.append((rows, -1 - node))
                continue
            p = x[rows] @ self.directions[node]
            low, high = self.children[node]
            todo.append((rows[p <= self.splits[node] + self.margin], low))
            todo.append((rows[p >= self.splits[node] - self.margin], high))
        return out


def grown(x: np.ndarray, seed: list[int]) -> Iterator[np.ndarray]:
    """Rows of each leaf of a tree grown on all of ``x``."""
    rng, todo = np.random.default_rng(seed), [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        found = halves(x[rows], rng) if len(rows) > LEAF else None
        if found:
            todo += [rows[found[2]], rows[found[3]]]
        elif len(rows) > 1:
            yield rows


def unite(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the groups of the pairs; ``low`` holds the smallest row of each row's group."""
    while len(a):
        x, y = low[a], low[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while len(a):
            following = low[low]
            if (following == low).all():
                break
            low[:] = following


def hanging(vectors: Vectors, rows: np.ndarray, keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that show which of ``rows`` hang together by links (between equal ``keys``)."""
    low, rest, crowd = np.arange(len(rows)), np.arange(len(rows)), np.empty(0, np.int64)
    if keys is None and len(rows) > 64:
        for first in (0, len(rows) // 3, 2 * len(rows) // 3):
            met = np.flatnonzero(vectors.near(rows[first:first + 1], rows)[0])
            unite(low, np.full(len(met), first), met)
        sizes = np.bincount(low)
        if sizes.max() >= len(rows) / 4:  # members of one crowd need not meet
            rest, crowd = np.flatnonzero(low != sizes.argmax()), np.flatnonzero(low == sizes.argmax())
    place, some = np.concatenate((rest, crowd)), max(1, min(ROWS, PRODUCT // max(1, len(rows))))
    unit = vectors.unit[rows[place]] if len(rest) else None
    for at in range(0, len(rest), some):
        one, other = rest[at:at + some], place[at:]
        near = vectors.near(rows[one], rows[other], unit[at:])
        np.fill_diagonal(near, False)
        if keys is not None:
            near &= keys[one][:, None] == keys[other][None, :]
        found = np.flatnonzero(near.ravel())
        if len(found):
            i, j = np.divmod(found, len(other))
            unite(low, one[i], other[j])
    tied = np.flatnonzero(low != np.arange(len(rows)))
    return rows[tied], rows[low[tied]]


def blocks_of(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of whole groups of equal sorted keys: small groups together, large ones alone."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    at = 0
    while at < len(starts) - 1:
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + SMALL, side="right")) - 1)
        yield int(starts[at]), int(starts[stop])
        at = stop


def cell_links(kinds: np.ndarray, ids: np.ndarray, raw: np.ndarray, dtype: str, cell: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (id, smallest id) that show which vectors of a cell hang together. cell: -1 for labels that are whole here."""
    order = np.lexsort((ids, kinds))
    kinds, ids, vectors = kinds[order], ids[order], Vectors(raw[order], dtype)
    low, alone = np.arange(len(ids)), kinds[0] == kinds[-1]
    if cell < 0 and (not alone or len(ids) <= EXACT):
        for start, stop in blocks_of(kinds):
            if stop - start > 1:
                rows = np.arange(start, stop)
                unite(low, *hanging(vectors, rows, None if kinds[start] == kinds[stop - 1] else kinds[rows]))
    else:
        for tree in range(TREES) if cell < 0 else [step]:
            found = [hanging(vectors, rows) for rows in grown(vectors.unit, [vectors.unit.shape[1], tree, cell + 1])]
            if found:
                unite(low, *(np.concatenate(x) for x in zip(*found, strict=True)))
    tied = np.flatnonzero(low != np.arange(len(ids)))
    return ids[tied], ids[low[tied]]


def gathered(batches: Iterator[pa.RecordBatch], most: int = CELL_BYTES) -> Iterator[pa.Table]:
    """The batches in tables of about ``most`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def by_size(table: pa.Table) -> Iterator[tuple[int, pa.Table, np.ndarray]]:
    """(bytes of a vector, its rows, their vectors) for each length of vector in the table."""
    sizes = table.column("size").to_numpy()
    for size in np.unique(sizes):
        part = table if len(table) and (sizes == size).all() else table.take(np.flatnonzero(sizes == size))
        yield int(size), part, matrix(part.column("v").combine_chunks() if part.column("v").num_chunks != 1
                                      else part.column("v").chunk(0), int(size))


def cells_of(tree: Tree, x: np.ndarray, ids: np.ndarray, most: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, cell) of all cells the rows go to; a leaf of near copies far past a cell is dealt as pairs of parts."""
    for rows, leaf in tree.leaves(x):
        parts = min(4000, math.ceil(tree.holds[leaf] / (2 * most))) if tree.holds[leaf] > 4 * most else 1
        if parts == 1:
            yield rows, np.full(len(rows), leaf << 24)
            continue
        own = ((ids[rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts
        for other in range(parts):
            some = own != other
            yield rows[some], (leaf << 24) + (np.minimum(own[some], other) << 12) + np.maximum(own[some], other)


def deal(batches: Iterator[pa.RecordBatch], trees: dict[int, Tree], bins: int, dtype: str) -> Iterator[pa.RecordBatch]:
    """Vectors of a cell, many to a row: size, key, cell, and their kinds, ids and bytes one after the other."""
    for table in gathered(batches):
        for size, part, raw in by_size(table):
            kinds, ids, n = (part.column(c).to_numpy() for c in ("kind", "id", "n"))
            hot = np.isin(kinds, np.fromiter(trees, np.int64, len(trees)))
            rows, keys, cells = [whole := np.flatnonzero(~hot)], [np.where(n[whole] < FEW, -1 - kinds[whole] % bins, kinds[whole])], [
                np.full(len(whole), -1)]
            for kind in np.unique(kinds[hot]):
                own = np.flatnonzero(kinds == kind)
                unit = unit_rows(raw[own].view(dtype)).astype(np.float32)
                for some, cell in cells_of(trees[kind], unit, ids[own], cell_rows(size)):
                    rows.append(own[some])
                    keys.append(np.full(len(some), kind))
                    cells.append(cell)
            row, key, cell = (np.concatenate(x) for x in (rows, keys, cells))
            order = np.lexsort((cell, key))
            row, key, cell = row[order], key[order], cell[order]
            ends = np.flatnonzero(np.concatenate(((key[1:] != key[:-1]) | (cell[1:] != cell[:-1]), [True]))) if len(row) else row
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ends), size), pa.int32()), pa.array(key[ends]), pa.array(cell[ends]),
                 binary(kinds[row], 8 * (ends + 1)), binary(ids[row], 8 * (ends + 1)), binary(raw[row], size * (ends + 1))],
                names=["size", "key", "cell", "kinds", "ids", "v"])


DEALT = "size int, key long, cell long, kinds binary, ids binary, v binary"


def link_cells(batches: Iterator[pa.RecordBatch], dtype: str, step: int) -> Iterator[pa.RecordBatch]:
    """Links of every cell, from rows of ``deal`` sorted by size, key and cell."""
    def done() -> Iterator[pa.RecordBatch]:
        if held:
            kinds, ids, raw = (np.concatenate([np.frombuffer(h[k], t) for h in held]) for k, t in enumerate((np.int64, np.int64, np.uint8)))
            held.clear()
            a, b = cell_links(kinds, ids, raw.reshape(-1, at[0]), dtype, at[2], step)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    held, at = [], None
    for batch in batches:
        for i, key in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)):
            if key != at:
                yield from done()
                at = key
            held.append([batch.column(k)[i].as_buffer() for k in (3, 4, 5)])
    yield from done()


def link_sums(near: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weight of each row's links."""
    kind = np.float32 if weights.sum() < 1 << 24 else np.float64
    return (near.astype(kind) @ weights.astype(kind)).astype(np.int64)


def group_links(vectors: Vectors, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Links (weighted) of each row among the rows of its key; keys are sorted."""
    links = np.zeros(len(keys), np.int64)
    for start, stop in blocks_of(keys):
        mixed = keys[start] != keys[stop - 1]
        for at in range(start, stop, ROWS):
            one, other = np.arange(at, min(at + ROWS, stop)), np.arange(at, stop)
            near = vectors.near(one, other, vectors.unit[at:stop])
            if mixed:
                near &= keys[one][:, None] == keys[other][None, :]
            np.fill_diagonal(near, False)
            links[one] += link_sums(near, weights[other])
            later = near[:, len(one):]
            if later.any():
                links[other[len(one):]] += link_sums(later.T, weights[one])
    return links


def count_links(batches: Iterator[pa.RecordBatch], dtype: str) -> Iterator[pa.RecordBatch]:
    """id, component, w and links of the vectors of each component, from rows sorted by component."""
    def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for _, part, raw in by_size(table):
            keys, ids, w = (part.column(c).to_numpy() for c in ("component", "id", "w"))
            links = group_links(Vectors(raw, dtype), keys, w)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, keys, w, links)], names=["id", "component", "w", "links"])

    held = None
    for table in gathered(batches):
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        keys = table.column("component").to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))  # the last component may go on
        yield from done(table.slice(0, last).combine_chunks())
        held = table.slice(last)
    if held is not None:
        yield from done(held.combine_chunks())


def cell_rows(size: int) -> int:
    """Vectors of ``size`` bytes a task should hold at once."""
    return min(CELL, max(1000, CELL_BYTES // max(1, size)))


def read_vectors(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> tuple[DataFrame, str]:
    """(vec_id, label, v): raw bytes of usable vectors, null for others; and their number type."""
    kind = vectors.schema[embedding].dataType.elementType
    dtype = "<f4" if isinstance(kind, T.FloatType) else "<f8"
    src = vectors.select(col(vec_id).cast("long").alias("vec_id"), col(label).alias("label"),
                         col(embedding).cast(T.ArrayType(T.FloatType() if dtype == "<f4" else T.DoubleType())).alias("e"))
    label_type = src.schema["label"].dataType
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label_type),
                           T.StructField("v", T.BinaryType())])

    def pack(batches):
        for b in batches:
            lists = b.column(2)
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype(dtype)  # nulls become NaN
            odd, some = (np.concatenate(([0], np.cumsum(x))) for x in (~np.isfinite(flat), flat != 0))
            odd, some = odd[ends], some[ends]
            usable = lists.is_valid().to_numpy(zero_copy_only=False) & (odd[1:] == odd[:-1]) & (some[1:] > some[:-1])
            bits = pa.py_buffer(np.packbits(usable, bitorder="little"))
            offsets = (ends * flat.itemsize).astype(np.int32)
            v = pa.Array.from_buffers(pa.binary(), len(b), [bits, pa.py_buffer(offsets), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), v], names=["vec_id", "label", "v"])

    return src.mapInArrow(pack, schema), dtype


def sampled(rows: DataFrame, n: int, wanted: float) -> DataFrame:
    """About ``wanted`` of the ``n`` rows, by a hash of the id."""
    if wanted >= n:
        return rows
    return rows.filter(F.xxhash64("id") < F.lit(int((2 * wanted / n - 1) * 2**63)))


def upper_samples(rows: DataFrame, hot: list, dtype: str) -> dict[int, np.ndarray]:
    """Unit vectors by kind on which the upper trees of large labels are fitted; ``hot``: kind, n and size of each."""
    n, size = sum(r.n for r in hot), max(r.size for r in hot)
    wanted = min(max(SAMPLE, CELL_SAMPLE * sum(math.ceil(r.n / cell_rows(r.size)) for r in hot)), MOST_SAMPLE, max(1, SAMPLE_BYTES // size))
    table = sampled(rows.filter("hot").select("kind", "id", "v"), n, wanted).select("kind", "v").toArrow()
    found: dict[int, list[bytes]] = {r.kind: [] for r in hot}
    for kind, v in zip(table.column("kind").to_pylist(), table.column("v").to_pylist(), strict=True):
        found[kind].append(v)
    return {r.kind: unit_rows(np.frombuffer(b"".join(found[r.kind]), dtype).reshape(len(found[r.kind]), -1)).astype(np.float32)
            if found[r.kind] else np.empty((0, r.size // np.dtype(dtype).itemsize), np.float32) for r in hot}


def linked(classes: DataFrame, dtype: str, n: int) -> DataFrame:
    """Links (a, b) of classes that show which of them hang together."""
    spark = classes.sparkSession
    large = F.col("n") > F.least(F.lit(CELL), F.greatest(F.lit(1000), F.floor(F.lit(CELL_BYTES) / F.greatest(F.lit(1), F.col("size")))))
    kinds = (classes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
             .withColumn("kind", F.monotonically_increasing_id()).withColumn("hot", large))
    kinds, _ = bounded_broadcast(kinds)
    rows = classes.join(kinds, ["label", "size"]).select("kind", "n", "hot", "size", "id", "v")
    hot = kinds.filter("hot").select("kind", "n", "size").collect()  # each holds a cell at least
    samples = upper_samples(rows, hot, dtype) if hot else {}
    bins, found = max(1, math.ceil(n / CELL)), []
    for step in range(TREES if hot else 1):
        trees = {r.kind: Tree(samples[r.kind], r.n / max(1, len(samples[r.kind])), [r.size, step], cell_rows(r.size)) for r in hot}
        shared = spark.sparkContext.broadcast(trees)  # bounded by the sample
        dealt = (rows.filter("hot") if step else rows).select("kind", "n", "size", "id", "v").mapInArrow(
            lambda batches, shared=shared: deal(batches, shared.value, bins, dtype), DEALT)
        cells = dealt.repartition("size", "key", "cell").sortWithinPartitions("size", "key", "cell")
        links, _ = written(cells.mapInArrow(lambda batches, step=step: link_cells(batches, dtype, step), "a long, b long"), "vector-links")
        found.append(links)
        shared.unpersist()
    return functools.reduce(DataFrame.unionByName, found)


class Forest:
    """Trees for each vector length in the sample; other lengths share one leaf."""

    def __init__(self, sample: dict[int, np.ndarray], scale: float):
        self.trees: dict[int, list[Tree]] = {}
        for size, x in sample.items():
            first = Tree(x, scale, [size, 0], LEAF)
            self.trees[size] = [first, *(Tree(x, scale, [size, t], LEAF) for t in range(1, TREES if len(first.holds) > 1 else 1))]

    def assign(self, size: int, x: np.ndarray) -> list[list[int]]:
        """Forest-wide leaf numbers of each unit vector, ascending."""
        out: list[list[int]] = [[] for _ in x]
        base = 0
        for tree in self.trees.get(size, []):
            for rows, leaf in tree.leaves(x):
                for r in rows:
                    out[r].append(base + leaf)
            base += len(tree.holds)
        return [sorted(leaves) or [0] for leaves in out]


def fit_forest(rows: DataFrame, dtype: str, n: int) -> Forest:
    """Forest fitted on about ``SAMPLE`` of the classes."""
    raw = sampled(rows.select("id", "v"), n, SAMPLE).select("v").toArrow()
    found: dict[int, list[bytes]] = {}
    for v in raw.column("v").to_pylist():
        found.setdefault(len(v), []).append(v)
    return Forest({size: unit_rows(np.frombuffer(b"".join(vs), dtype).reshape(len(vs), -1)).astype(np.float32)
                   for size, vs in found.items()}, n / max(1, raw.num_rows))


def met_before(x: list, y: list) -> np.ndarray | None:
    """Which pairs share one of the leaves given for each; None if there are none."""
    known = {leaf: i for i, leaf in enumerate(sorted({n for s in x for n in s} & {n for s in y for n in s}))}
    if not known:
        return None
    marks = [np.zeros((len(seen), len(known)), np.float32) for seen in (x, y)]
    for mark, seen in zip(marks, (x, y), strict=True):
        for i, s in enumerate(seen):
            mark[i, [known[n] for n in s if n in known]] = 1
    return marks[0] @ marks[1].T > 0


def compare_block(vectors: Vectors, weights: np.ndarray, side: np.ndarray, leaves: list, leaf: int, square: bool) -> np.ndarray:
    """Links (weighted) of each class in a block pair whose pairs share no earlier leaf."""
    links = np.zeros(len(weights), np.int64)
    seen = [[n for n in s if n < leaf] for s in leaves]
    left = np.flatnonzero(side == 0)
    right = left if square else np.flatnonzero(side == 1)
    for at in range(0, len(left) if len(right) else 0, ROWS):
        one = left[at:at + ROWS]
        near = vectors.near(one, right)
        if square:
            near[np.arange(len(one)), at + np.arange(len(one))] = False
        if not near.any():
            continue
        before = met_before([seen[i] for i in one], [seen[i] for i in right])
        if before is not None:
            near &= ~before
        links[one] += link_sums(near, weights[right])
        if not square:
            links[right] += link_sums(near.T, weights[one])
    return links


def crowd_links(members: DataFrame, dtype: str, n: int) -> DataFrame:
    """id, component, w and links of the vectors of components past ``GROUP``."""
    members, _ = written(members, "crowds")
    shared = members.sparkSession.sparkContext.broadcast(fit_forest(members, dtype, n))  # bounded by SAMPLE

    def assign(batches):
        for table in gathered(batches):
            for size, part, raw in by_size(table):
                leaves = forest_of(shared).assign(size, Vectors(raw, dtype).unit)
                yield from part.append_column("leaves", pa.array(leaves, pa.list_(pa.int32()))).to_batches()

    schema = T.StructType([*members.schema.fields, T.StructField("leaves", T.ArrayType(T.IntegerType()))])
    indexed, _ = written(members.mapInArrow(assign, schema), "indexed-vectors")
    placed = indexed.withColumn("leaf", F.explode("leaves"))
    crowds = (placed.groupBy("component", "leaf").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
              .select("component", "leaf", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    crowds, _ = bounded_broadcast(crowds)
    placed = placed.join(crowds, ["component", "leaf"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    blocks = (placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("component", "leaf", "id", "w", "size", "v", "leaves", F.least("own", "other").alias("lo"),
                      F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).cast("int").alias("side")))

    def compare(table: pa.Table) -> pa.Table:
        leaf, lo, hi = (table.column(c)[0].as_py() for c in ("leaf", "lo", "hi"))
        (_, _, raw), = by_size(table)
        links = compare_block(Vectors(raw, dtype), table.column("w").to_numpy(), table.column("side").to_numpy(),
                              table.column("leaves").to_pylist(), leaf, lo == hi)
        return pa.table({"id": table.column("id").to_numpy()[links > 0], "links": links[links > 0]})

    found, _ = written(blocks.groupBy("component", "leaf", "lo", "hi").applyInArrow(compare, "id long, links long"), "crowd-links")
    return (members.select("id", "component", "w").join(found.groupBy("id").agg(F.sum("links").alias("links")), "id", "left")
            .select("id", "component", "w", F.coalesce("links", F.lit(0)).alias("links")))


def counted(classes: DataFrame, groups: DataFrame, dtype: str, size: int) -> DataFrame:
    """id, component, w and links of every class in ``groups`` (id, component)."""
    groups, _ = written(groups, "vector-groups")
    most = min(GROUP, max(1000, GROUP_BYTES // size))
    crowds, seen = written(groups.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most),
                           "crowds", F.sum("n").alias("n"))
    members = groups.join(F.broadcast(crowds), "component", "left_anti") if seen.get("n") else groups  # each holds GROUP ids
    columns = ["id", "component", "w", "size", "v"]
    found = (classes.join(members, "id").select(columns).repartition("component").sortWithinPartitions("component")
             .mapInArrow(lambda batches: count_links(batches, dtype), "id long, component long, w long, links long"))
    if not seen.get("n"):
        return found
    large = groups.join(F.broadcast(crowds.select("component")), "component")
    return found.unionByName(crowd_links(classes.join(large, "id").select(columns), dtype, seen["n"]))


def distinct_vectors(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> tuple[DataFrame, DataFrame, DataFrame | None, dict, str]:
    """All ids; the classes of equal vectors (label, size, id, w, v); each id of a class of several (None: no such class); measures; number type.

    Copies of the vectors made on the way are gone from the disk as soon as they have been read for the last time.
    """
    spark = vectors.sparkSession
    to = {name: shared_path(spark, name) for name in ("vector-ids", "vector-classes", "vector-twins")}
    with scratch(spark):
        place = shared_path(spark, "own-vectors")
        with scratch(spark):
            packed, dtype = read_vectors(vectors, vec_id, embedding, label)
            packed, _ = written(packed, "vectors")
            ids, _ = written(packed.select("vec_id"), "vector-ids", path=to["vector-ids"])
            usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
            own, _ = written(packed.filter(usable).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("x"))
                             .select("vec_id", "x.*"), "own-vectors", path=place)
        classes, seen = written(
            own.groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("w"))
            .select("label", F.octet_length("v").alias("size"), "id", "w", "v"),
            "vector-classes", F.count(F.lit(1)).alias("n"), F.max("size").alias("size"),
            F.count(F.when(F.col("w") > 1, 1)).alias("repeated"), path=to["vector-classes"])
        twins, mark = None, F.sha2("v", 256).alias("mark")
        if seen["repeated"]:
            several = classes.filter("w > 1").select("label", mark, "id")
            twins, _ = written(own.select("vec_id", "label", mark).join(several, ["label", "mark"]).select("vec_id", "id"),
                               "vector-twins", path=to["vector-twins"])
    return ids, classes, twins, seen, dtype


def vector_duplicates(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding",
                      label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    batches_of(vectors)
    with shuffles_freed(vectors.sparkSession):  # one step's shuffle is gone before the next one's
        ids, classes, twins, seen, dtype = distinct_vectors(vectors, vec_id, embedding, label)
        groups = components(linked(classes, dtype, seen["n"]))
        found, _ = written(counted(classes, groups, dtype, seen["size"] or 1), "linked-vectors")
    result = ["vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id")]
    per_id = found.withColumnRenamed("id", "vec_id").select(*result)
    if twins is not None:
        named = (classes.filter("w > 1").select("id", "w").join(found.drop("w"), "id", "left")
                 .select("id", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("links"), F.coalesce("component", "id").alias("component")))
        per_id = (found.filter("w = 1").withColumnRenamed("id", "vec_id").select(*result)
                  .unionByName(twins.join(named, "id").select(*result)))
    return (ids.join(per_id, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def forest_of(shared) -> Forest:
    """The broadcast forest."""
    return shared.value
