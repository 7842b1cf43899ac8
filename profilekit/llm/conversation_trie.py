"""Prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns. Peeling goes from the deepest
level up: the conversations that end at a level, one row per distinct
conversation, meet the nodes that survive from the level below with their last
turn stripped; equal sequences are grouped, and that one pass gives the level's
nodes with their members, children, leaves and saved tokens. What a node needs
from below is in the rows that carry it up, so no level is visited twice.

How it scales. Turns are numbered by a range-partitioned sort in which the
pieces of a conversation that lies in several partitions are joined by carries
(at most two rows a partition); a sequence is known by two 64-bit polynomial
sums over its turns' SHA-256 halves, which the same pass adds up. The first
``LEVELS`` levels, and any crowded level, are each a Spark aggregation, so that a
turn many conversations begin with is combined before the shuffle. Deeper
levels hold few rows: runs of levels with at most ``RUN_ROWS`` rows together are
peeled in one job, grouped by the sequence above the run.
Ids that end at a node are joined in chunks of ids; SHA-256 is sequential, so a
node's chunks pass through one task as a stream, one chunk in memory at a time.

Defined results: rows of null conv_id belong to no conversation; null role or
text is empty; turns are ordered by turn (null first), equal turn numbers by
the SHA-256 of role and text, repeated rows are repeated turns; a conversation
that has no rebuilt turns ends at the root; an empty table has no nodes.
Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilekit.llm.components import written
from profilekit.llm.text import claim, col, crc32_sql
from profilekit.operators.joins import checked_join

FAMILY = 100  # conversation c takes its opening from c - c % FAMILY
OPENING = 6  # ... the first crc32(c) % OPENING turns
LEVELS = 16
RUN_ROWS = 20_000
CHUNK_BITS = 16  # ids of one chunk are alike but for so many bits

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so that they have inverses modulo 2**64
_MASK = (1 << 64) - 1


def _powers(base: int, n: np.ndarray) -> np.ndarray:
    """base ** n modulo 2**64 (also of negative n)."""
    out, size = np.ones(len(n), np.uint64), np.abs(n).astype(np.uint64)
    for sign in (1, -1):
        mine = np.sign(n) == sign
        step, left = (base if sign > 0 else pow(base, -1, 1 << 64)), size * mine
        while left.any():
            out = np.where(left & np.uint64(1), out * np.uint64(step), out)
            left, step = left >> np.uint64(1), step * step & _MASK
    return out


def _runs(ids: np.ndarray) -> np.ndarray:
    """Start of every run of equal values."""
    return np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else np.empty(0, int)


def numbered_turns(df: DataFrame) -> DataFrame:
    """(conv_id, place from 0, length, a, b): a and b sum the conversation's turns up to this one. Written."""
    spark = df.sparkSession
    role, text = (F.coalesce(col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = df.select(
        col("conv_id").cast("long").alias("conv_id"), col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("code"),
        F.length(text).cast("long").alias("length")).filter("conv_id is not null")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.repartitionByRange(parts, "conv_id", "turn").sortWithinPartitions("conv_id", "turn", "code")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(__name__)
        part = TaskContext.get().partitionId()
        last, place, sums = None, 0, [0, 0]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64).reshape(-1, 4)
            starts = _runs(ids)
            sizes = np.diff(np.append(starts, len(ids)))
            at = np.arange(len(ids)) - np.repeat(starts, sizes)
            if ids[0] == last:  # the conversation goes on from the batch before
                at[:sizes[0]] += place
            else:
                sums = [0, 0]
            out = [batch.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(at.astype(np.int64)), batch.column(3)]
            ends = []
            for k, base in enumerate(_BASES):
                terms = codes[:, k] * _powers(base, at)
                total = np.cumsum(terms, dtype=np.uint64)
                before = np.where(starts > 0, total[starts - 1], np.uint64(0))
                before[:1] -= np.uint64(sums[k])
                here = total - np.repeat(before, sizes)
                ends.append(int(here[-1]))
                out.append(pa.array(here.view(np.int64)))
            last, place, sums = ids[-1], int(at[-1]) + 1, ends
            yield pa.RecordBatch.from_arrays(out, names=["conv_id", "part", "place", "length", "a", "b"])

    local, _ = written(dealt.mapInArrow(number, "conv_id long, part int, place long, length long, a long, b long"), "turns")
    # conversations in several partitions: each partition's last row of them tells what the next one carries on
    # (only a partition's first and last conversation can be one, so there are at most two rows a partition)
    per_part = local.groupBy("part").agg(F.min("conv_id").alias("x"), F.max("conv_id").alias("y"))
    edges = (per_part.select("part", F.explode(F.array_distinct(F.array("x", "y"))).alias("conv_id")))
    tails = (local.join(F.broadcast(edges), ["part", "conv_id"]).groupBy("conv_id", "part")
             .agg(F.max_by(F.struct("place", "a", "b"), "place").alias("e")))
    many = tails.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("conv_id")
    carries, state = [], {}
    for r in sorted(tails.join(F.broadcast(many), "conv_id", "left_semi").collect(), key=lambda r: (r.conv_id, r.part)):
        n, a, b = state.get(r.conv_id, (0, 0, 0))
        if n:
            carries.append((r.part, r.conv_id, n, _signed(a), _signed(b)))
        add = [pow(base, n, 1 << 64) * (v & _MASK) for base, v in zip(_BASES, (r.e.a, r.e.b), strict=True)]
        state[r.conv_id] = (n + r.e.place + 1, (a + add[0]) & _MASK, (b + add[1]) & _MASK)
    if not carries:
        return local.drop("part")
    side = F.broadcast(spark.createDataFrame(carries, "part int, conv_id long, n long, ca long, cb long"))

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ca, cb, a, b = (batch.column(i).to_numpy().view(np.uint64) for i in range(3, 8))
            sums = [c + _powers(base, n.astype(np.int64)) * v for base, c, v in zip(_BASES, (ca, cb), (a, b), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(batch.column(1).to_numpy() + n.view(np.int64)), batch.column(2),
                 *[pa.array(x.view(np.int64)) for x in sums]], names=["conv_id", "place", "length", "a", "b"])

    joined = local.join(side, ["part", "conv_id"], "left").select(
        "conv_id", "place", "length", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "ca", "cb")], "a", "b")
    return written(joined.mapInArrow(carry, "conv_id long, place long, length long, a long, b long"), "turns")[0]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def rebuilt_paths(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, length, a, b) of every rebuilt turn, and (conv_id, depth) of every rebuilt conversation; both written.

    A conversation's own turns keep their sums but for what the cut-off turns added and for the places they move up.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(OPENING))
    opening = F.struct(F.col("place").alias("p"), "length", "a", "b")
    heads = (turns.filter((F.col("place") < OPENING - 1) & (F.col("conv_id") % FAMILY == 0)).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(opening)).alias("head")).withColumnRenamed("conv_id", "base"))
    cut = F.when(F.col("place") == h - 1, F.struct("a", "b"))
    convs = (turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.max(cut).alias("cut"))
             .withColumn("h", h.cast("long")).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY))
    none = F.array().cast("array<struct<p:long,length:long,a:long,b:long>>")
    info = (checked_join(convs, heads, "base", "base", "left").select(
        "conv_id", "n", "h", "cut", F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), none).alias("head")))
    info, _ = written(info.withColumn("k", F.size("head").cast("long"))
                      .withColumn("depth", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "conversations")
    first = info.select("conv_id", F.explode("head").alias("e")).select(
        "conv_id", (F.col("e.p") + 1).alias("depth"), "e.length", "e.a", "e.b")
    zero = F.lit(0).cast("long")
    last = F.try_element_at("head", F.lit(-1))
    moved = info.filter("n > h").select(
        F.col("conv_id").alias("c"), "h", "k", *[F.coalesce(x, zero).alias(n) for n, x in
        (("xa", F.col("cut.a")), ("xb", F.col("cut.b")), ("ha", last["a"]), ("hb", last["b"]))])
    own = checked_join(turns, moved, "conv_id", "c").filter("place >= h").select(
        "conv_id", "place", "length", "a", "b", "h", "k", "xa", "xb", "ha", "hb")

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, h, k = (batch.column(i).to_numpy() for i in (1, 5, 6))
            a, b, xa, xb, ha, hb = (batch.column(i).to_numpy().view(np.uint64) for i in (3, 4, 7, 8, 9, 10))
            sums = [start + (v - x) * _powers(base, k - h)
                    for base, v, x, start in zip(_BASES, (a, b), (xa, xb), (ha, hb), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(place - h + k + 1), batch.column(2), *[pa.array(s.view(np.int64)) for s in sums]],
                names=["conv_id", "depth", "length", "a", "b"])

    rest = own.mapInArrow(shift, "conv_id long, depth long, length long, a long, b long")
    paths, _ = written(first.unionByName(rest), "paths")
    return paths, info.select("conv_id", "depth")


def _hashed(chunks: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): every node's chunks of ids, in order, through one running hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, out = None, None, []
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                key = (r["depth"], r["a"], r["b"])
                if key != now:
                    if now is not None:
                        out.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(r["ids"].encode())
                else:
                    digest.update(b"," + r["ids"].encode())
            yield _batch(out)
            out = []
        yield _batch(out if now is None else [*out, (*now, digest.hexdigest())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(4)],
                                          names=["depth", "a", "b", "ends_sha256"])

    dealt = chunks.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "chunk").select("depth", "a", "b", "ids")
    return dealt.mapInArrow(run, "depth long, a long, b long, ends_sha256 string")


def _ended(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct rebuilt conversation: depth, a, b, rep (its smallest id), n_convs, ends_sha256. Written."""
    ends = checked_join(paths.select("conv_id", "depth", "a", "b"),
                        convs.select(F.col("conv_id").alias("c"), F.col("depth").alias("end")), "conv_id", "c")
    zero = F.lit(0).cast("long")
    ends = ends.filter("depth = end").select("conv_id", "depth", "a", "b").unionByName(
        convs.filter("depth = 0").select("conv_id", "depth", zero.alias("a"), zero.alias("b")))
    chunks, _ = written(
        ends.groupBy("depth", "a", "b", F.shiftright("conv_id", CHUNK_BITS).alias("chunk"))
        .agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n_convs"),
             F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")),
        "chunks")
    sums = chunks.groupBy("depth", "a", "b").agg(F.min("rep").alias("rep"), F.sum("n_convs").alias("n_convs"))
    return written(sums.join(_hashed(chunks), ["depth", "a", "b"]), "ended")[0]


_EMPTY = hashlib.sha256(b"").hexdigest()
_STEP = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("depth", "length", "a", "b")]))
# what goes up from a level: one row per node, known by its smallest member
_UP = "rep long, n_convs long, n_leaves long, saved long"
_NODE = ("depth long, a long, b long, pa long, pb long, rep long, n_convs long, n_children long, n_leaves long, "
         "saved long, ends_sha256 string")


def _slices(paths: DataFrame, low: int, high: int) -> DataFrame:
    """Per conversation its steps at depths ``low`` to ``high`` (at most that many), in order."""
    return (paths.filter(F.col("depth").between(low, high)).groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("depth", "length", "a", "b"))).alias("path")))


def _peel_levels(up: DataFrame | None, ended: DataFrame, paths: DataFrame, low: int, high: int) -> tuple[list[DataFrame], DataFrame]:
    """Nodes of the levels ``high`` down to ``low + 1``, one aggregation each, and what goes up from the last."""
    zero = F.lit(0).cast("long")
    here = ended.filter(F.col("depth").between(low + 1, high)).select(
        "rep", "n_convs", "ends_sha256", "depth", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved"))
    if up is not None:
        here = here.unionByName(up.select(
            "rep", "n_convs", F.lit(None).cast("string").alias("ends_sha256"), F.lit(high).cast("long").alias("depth"),
            F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved"))
    steps = _slices(paths, low, high)
    start, _ = written(here.join(steps, here["rep"] == steps["conv_id"], "left").drop("conv_id"), "peel-start")
    nodes, rising = [], None
    for depth in range(high, low, -1):
        rows = start.filter(F.col("depth") == depth).drop("depth")
        if rising is not None:
            rows = rows.unionByName(rising)
        step, above = F.element_at("path", -1), F.try_element_at("path", F.lit(-2))
        keyed = rows.select("*", step["a"].alias("a"), step["b"].alias("b"))
        grouped = keyed.groupBy("a", "b").agg(
            F.min("rep").alias("rep"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("ends_sha256").alias("ends_sha256"),
            F.first("path").alias("path"))
        level, _ = written(grouped.select(
            F.lit(depth).cast("long").alias("depth"), "a", "b", F.coalesce(above["a"], zero).alias("pa"),
            F.coalesce(above["b"], zero).alias("pb"), "rep", "n_convs", "n_children",
            F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
            (F.col("saved") + (F.col("n_convs") - 1) * step["length"]).alias("saved"), "ends_sha256", "path"), f"level-{depth}")
        nodes.append(level.drop("path"))
        # strip the last turn
        rising = level.select("rep", "n_convs", F.lit(None).cast("string").alias("ends_sha256"), F.lit(1).cast("long").alias("n_children"),
                              "n_leaves", "saved", F.slice("path", F.lit(1), F.size("path") - 1).alias("path"))
    return nodes, rising.select("rep", "n_convs", "n_leaves", "saved")


def peel_run(rows: pd.DataFrame) -> list[tuple]:
    """Nodes (as ``_NODE``) of a run of levels from its rows: steps (kind 0), ended conversations (1), rising nodes (2).

    Rows share the sequence above the run; they are few (see ``RUN_ROWS``).
    """
    paths: dict[int, dict] = {}
    for r in rows[rows.kind == 0].itertuples(index=False):
        paths.setdefault(r.rep, {})[r.depth] = (r.a, r.b, r.length)
    waiting: dict[int, list] = {}
    for r in rows[rows.kind > 0].itertuples(index=False):
        waiting.setdefault(r.depth, []).append((r.rep, r.n_convs, int(r.kind == 2), r.n_leaves, r.saved,
                                                r.ends_sha256 if r.kind == 1 else None))
    out = []
    if not waiting:
        return out
    low = min(min(p) for p in paths.values())
    for depth in range(max(waiting), low, -1):
        level: dict[tuple, list] = {}
        for rep, n, kids, leaves, saved, ends in waiting.pop(depth, ()):
            node = level.setdefault(paths[rep][depth][:2], [rep, 0, 0, 0, 0, None])
            node[:] = [min(node[0], rep), node[1] + n, node[2] + kids, node[3] + leaves, node[4] + saved, ends or node[5]]
        for (a, b), (rep, n, kids, leaves, saved, ends) in level.items():
            above, leaves = paths[rep][depth - 1], max(leaves, 1)
            saved += (n - 1) * paths[rep][depth][2]
            out.append((depth, a, b, above[0], above[1], rep, n, kids, leaves, saved, ends))
            waiting.setdefault(depth - 1, []).append((rep, n, 1, leaves, saved, None))
    return out


def _peel_run(up: DataFrame | None, ended: DataFrame, paths: DataFrame, low: int, high: int) -> tuple[list[DataFrame], DataFrame]:
    """As ``_peel_levels``, for levels that hold few rows together: one job, grouped by the sequence at depth ``low``."""
    zero, no = F.lit(0).cast("long"), F.lit(None).cast("string").alias("ends_sha256")
    alive = ended.filter(F.col("depth").between(low + 1, high)).select(
        F.lit(1).alias("kind"), "rep", "depth", "n_convs", zero.alias("n_leaves"), zero.alias("saved"), "ends_sha256")
    if up is not None:
        alive = alive.unionByName(up.select(F.lit(2).alias("kind"), "rep", F.lit(high).cast("long").alias("depth"),
                                            "n_convs", "n_leaves", "saved", no))
    alive, _ = written(alive, "run")
    floor = paths.filter(F.col("depth") == low).select(F.col("conv_id").alias("rep"), F.col("a").alias("fa"), F.col("b").alias("fb"))
    heads = alive.select("rep").distinct().join(floor, "rep")
    steps = (heads.join(paths.filter(F.col("depth").between(low, high)).withColumnRenamed("conv_id", "rep"), "rep")
             .select("fa", "fb", F.lit(0).alias("kind"), "rep", "depth", zero.alias("n_convs"), zero.alias("n_leaves"),
                     zero.alias("saved"), no, "length", "a", "b"))
    rows = alive.join(heads, "rep").select("fa", "fb", "kind", "rep", "depth", "n_convs", "n_leaves", "saved", "ends_sha256",
                                           zero.alias("length"), zero.alias("a"), zero.alias("b")).unionByName(steps)
    names = [f.split()[0] for f in _NODE.split(", ")]

    def peel(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(peel_run(group), columns=names)

    nodes, _ = written(rows.groupBy("fa", "fb").applyInPandas(peel, _NODE), "run-nodes")
    return [nodes], nodes.filter(F.col("depth") == low + 1).select("rep", "n_convs", "n_leaves", "saved")


def runs_of(counts: dict[int, int], width: int, deepest: int, levels: int = LEVELS, most: int = RUN_ROWS) -> list[tuple[int, int, bool]]:
    """(low, high, few) from the deepest down to 0: ``few`` runs hold at most ``most`` rows, others at most ``levels`` levels.

    ``counts`` has the rows of each ``width`` levels beyond the first ``levels``.
    """
    out, high, rows = [], deepest, 0
    bins = list(range((max(deepest, levels) - levels + width - 1) // width))[::-1]
    for k in bins:
        low, n = levels + k * width, counts.get(k, 0)
        if n > most:
            if high > low + width:
                out.append((low + width, high, True))
            top = min(low + width, deepest)
            out += [(max(low, x - levels), x, False) for x in range(top, low, -levels)]
            high, rows = low, 0
        elif rows + n > most:
            out.append((low + width, high, True))
            high, rows = min(low + width, deepest), n
        else:
            rows += n
    if high > levels:
        out.append((levels, high, True))
    if deepest:
        out.append((0, min(levels, deepest), False))
    return out


def prefix_trie(conversations: DataFrame, levels: int = LEVELS, run_rows: int = RUN_ROWS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths, convs = rebuilt_paths(numbered_turns(conversations))
    ended = _ended(paths, convs)
    deepest = convs.agg(F.max("depth")).first()[0] or 0
    width = max(1, -(-(deepest - levels) // 1000))  # at most a thousand counts, however deep
    deep = paths.filter(F.col("depth") > levels).groupBy(F.floor((F.col("depth") - levels - 1) / width).alias("k"))
    counts = {r.k: r.n for r in deep.agg(F.count(F.lit(1)).alias("n")).collect()} if deepest > levels else {}
    up, levels_done = None, []
    for low, high, few in runs_of(counts, width, deepest, levels, run_rows):
        made, up = (_peel_run if few else _peel_levels)(up, ended, paths, low, high)
        levels_done += made
    zero = F.lit(0).cast("long")
    root = ended.filter("depth = 0").select("rep", "n_convs", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved"), "ends_sha256")
    if up is not None:
        root = root.unionByName(up.select("rep", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved",
                                          F.lit(None).cast("string").alias("ends_sha256")))
    root = (root.agg(F.min("rep").alias("rep"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
                     F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("ends_sha256").alias("ends_sha256"))
            .filter("rep is not null").select(
                zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("pa"), zero.alias("pb"), "rep", "n_convs", "n_children",
                F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), "saved", "ends_sha256"))
    for made in levels_done:
        root = root.unionByName(made)
    key = lambda depth, a, b: F.concat_ws(":", depth, a, b)
    nodes, _ = written(root.withColumn("above", F.when(F.col("depth") > 0, key(F.col("depth") - 1, F.col("pa"), F.col("pb")))), "nodes")
    parents = nodes.filter("n_children > 0").select(key(F.col("depth"), F.col("a"), F.col("b")).alias("node"), F.col("rep").alias("parent_conv_id"))
    return checked_join(nodes, parents, "above", "node", "left").select(
        F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))


def prefix_trie_sql() -> str:
    """DuckDB SQL of the trie: whole paths as keys; a node counts what its members own at its depth and below."""
    return f"""
WITH turns AS (SELECT conv_id, length(coalesce(text, '')) AS length,
    sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS code,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, code) AS place FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, {crc32_sql("conv_id::VARCHAR")} % {OPENING} AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (SELECT c.conv_id, 0 AS own, place, length, code FROM convs c JOIN turns t ON t.conv_id = c.base AND place <= h
    UNION ALL SELECT c.conv_id, 1, place, length, code FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND place > h),
steps AS (SELECT conv_id, length, row_number() OVER w AS depth, string_agg(code, '') OVER w AS path
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, place ROWS UNBOUNDED PRECEDING)
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
ends AS (SELECT conv_id, max(depth) AS last FROM steps GROUP BY conv_id),
nodes AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(length) AS length,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = last), '')) AS ends_sha256
    FROM steps JOIN ends USING (conv_id) GROUP BY depth, path),
kids AS (SELECT depth - 1 AS depth, substr(path, 1, 64 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
owned AS (SELECT n.conv_id, n.depth, (n_convs - 1) * length AS saved, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf
    FROM nodes n LEFT JOIN kids USING (depth, path)),
below AS (SELECT s.depth, s.path, sum(saved) AS saved, sum(leaf) AS leaves FROM steps s JOIN owned o ON o.conv_id = s.conv_id AND o.depth >= s.depth
    GROUP BY s.depth, s.path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves,
    saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below USING (depth, path) LEFT JOIN kids USING (depth, path)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = substr(n.path, 1, 64 * (n.depth - 1))"""
