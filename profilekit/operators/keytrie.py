"""Key lists beyond one worker's memory: compact tries in shard files that workers map.

A shard is a byte trie over a bounded part of the keys, held in flat arrays:
nodes are numbered level by level, so that a node's children lie side by side
and one integer per node (``first``) finds them. A task builds a shard and
writes it to the shared folder under a name of its own; only the names in the
Spark-written manifest count, so a lost or repeated task leaves nothing behind
that is read. On a mounted folder a worker maps the files, and workers of one
machine share their pages; from another store a few shards are kept in memory.

A batch of texts is walked as a whole: every position goes down the trie at
once, and a position is dropped as soon as nothing below it can be better than
what its text has already. Substring matches on UTF-8 bytes are the matches on
characters.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame

# Key text of one shard: about 13 bytes of arrays per node, at most one node per byte.
SHARD_BYTES = 16 * 1024 * 1024
# Positions walked at once; bounds memory, never results.
WALK = 1 << 20
NONE = np.iinfo(np.int32).max
# Shards kept in memory where the folder cannot be mapped.
OPEN_SHARDS = 4

_MANIFEST = "path string, nodes long, forks long, keys long, key_bytes long"


class KeyTrie:
    """The arrays of a shard.

    ``first[s] .. first[s + 1]`` are the children of node ``s`` (0 is the root),
    ``label`` the byte that leads to a node, ``rank`` the key that ends there
    and ``low`` the best key at or below it (ranks count in order of priority,
    then key). ``fork_edge`` / ``fork_node`` list the edges of nodes with several children.
    """

    KINDS = (("fork_edge", np.int64), ("offsets", np.int64), ("priority", np.int64), ("first", np.int32),
             ("rank", np.int32), ("low", np.int32), ("fork_node", np.int32), ("label", np.uint8), ("text", np.uint8))

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)
        self.roots = np.zeros(256, np.int32)  # child of the root by byte, 0 for none
        top = np.arange(self.first[0], self.first[1], dtype=np.int32)
        self.roots[self.label[top]] = top

    @staticmethod
    def _sizes(nodes: int, forks: int, keys: int, key_bytes: int) -> dict[str, int]:
        return {"fork_edge": forks, "offsets": keys + 1, "priority": keys, "first": nodes + 1, "rank": nodes,
                "low": nodes, "fork_node": forks, "label": nodes, "text": key_bytes}

    def measures(self) -> tuple[int, int, int, int]:
        return len(self.rank), len(self.fork_node), len(self.priority), len(self.text)

    def tobytes(self) -> Iterator[bytes]:
        for name, kind in self.KINDS:
            yield np.ascontiguousarray(getattr(self, name), kind).tobytes()

    @classmethod
    def over(cls, buffer, *measures: int) -> KeyTrie:
        arrays, at = {}, 0
        sizes = cls._sizes(*measures)
        for name, kind in cls.KINDS:
            arrays[name] = np.frombuffer(buffer, kind, sizes[name], at)
            at += sizes[name] * np.dtype(kind).itemsize
        return cls(arrays)

    @classmethod
    def build(cls, pairs: list[tuple[bytes, int]]) -> KeyTrie:
        """The trie of distinct non-empty ``(key, priority)`` pairs."""
        by_rank = sorted(pairs, key=lambda p: (p[1], p[0]))
        order = sorted(range(len(by_rank)), key=lambda i: by_rank[i][0])
        keys = [by_rank[i][0] for i in order]
        rank_of = np.array(order, np.int32)
        size = np.array([len(k) for k in keys], np.int64)
        start = np.concatenate(([0], np.cumsum(size)))[:-1]
        data = np.frombuffer(b"".join(keys), np.uint8)
        labels, parents, ranks, nodes = [np.zeros(1, np.uint8)], [], [np.full(1, NONE, np.int32)], 1
        alive, node = np.arange(len(keys)), np.zeros(len(keys), np.int64)
        depth = 0
        while len(alive):  # one level of all keys at a time; sorted keys keep siblings together
            byte, parent = data[start[alive] + depth], node[alive]
            new = np.ones(len(alive), bool)
            new[1:] = (byte[1:] != byte[:-1]) | (parent[1:] != parent[:-1])
            here = nodes + np.cumsum(new) - 1
            node[alive] = here
            labels.append(byte[new])
            parents.append(parent[new])
            level = np.full(int(new.sum()), NONE, np.int32)
            ends = size[alive] == depth + 1
            level[here[ends] - nodes] = rank_of[alive[ends]]
            ranks.append(level)
            nodes += len(level)
            alive, depth = alive[~ends], depth + 1
        parent = np.concatenate(parents) if parents else np.empty(0, np.int64)
        label, rank = np.concatenate(labels), np.concatenate(ranks)
        first = np.searchsorted(parent, np.arange(nodes + 1)).astype(np.int32) + 1
        low = rank.copy()
        for level in reversed(parents):  # levels end where the next begins: children report to parents bottom up
            at = nodes - len(level)
            np.minimum.at(low, level, low[at:nodes])
            nodes = at
        forks = np.flatnonzero(np.diff(first)[parent] > 1) + 1 if len(parent) else np.empty(0, np.int64)
        text = b"".join(k for k, _ in by_rank)
        return cls({"fork_edge": parent[forks - 1] * 256 + label[forks], "fork_node": forks.astype(np.int32),
                    "offsets": np.concatenate(([0], np.cumsum([len(k) for k, _ in by_rank]))).astype(np.int64),
                    "priority": np.array([p for _, p in by_rank], np.int64), "first": first, "rank": rank, "low": low,
                    "label": label, "text": np.frombuffer(text, np.uint8)})

    def key(self, rank: int) -> str:
        return self.text[self.offsets[rank]:self.offsets[rank + 1]].tobytes().decode()

    def _children(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The node behind each (node, byte), 0 for none."""
        at = self.first[state]
        width = self.first[state + 1] - at
        out = np.zeros(len(state), np.int32)
        one = np.flatnonzero(width == 1)
        out[one] = np.where(self.label[at[one]] == byte[one], at[one], 0)
        many = np.flatnonzero(width > 1)
        if len(many):
            edge = state[many].astype(np.int64) * 256 + byte[many]
            place = np.minimum(np.searchsorted(self.fork_edge, edge), len(self.fork_edge) - 1)
            out[many] = np.where(self.fork_edge[place] == edge, self.fork_node[place], 0)
        return out

    def best(self, data: np.ndarray, ends: np.ndarray, begin: int = 0) -> np.ndarray:
        """Smallest rank of a key in each text (``NONE`` without one); text ``i`` lies in ``data`` up to ``ends[i]``."""
        best = np.full(len(ends), NONE, np.int32)
        last = int(ends[-1]) if len(ends) else begin
        for at in range(begin, last, WALK):
            pos = np.arange(at, min(at + WALK, last))
            text = np.searchsorted(ends, pos, side="right")
            state = self.roots[data[pos]]
            while True:
                live = np.flatnonzero((state > 0) & (self.low[state] < best[text]))
                pos, text, state = pos[live], text[live], state[live]
                if not len(pos):
                    break
                found = self.rank[state]
                hit = np.flatnonzero(found != NONE)
                if len(hit):
                    np.minimum.at(best, text[hit], found[hit])
                pos = pos + 1
                inside = np.flatnonzero(pos < ends[text])
                pos, text, state = pos[inside], text[inside], state[inside]
                state = self._children(state, data[pos])
        return best


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a Hadoop-style path and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return (pafs.LocalFileSystem(), path) if "://" not in path else pafs.FileSystem.from_uri(path)


def write_shards(keys: DataFrame, shards: int, folder: str) -> DataFrame:
    """Build ``shards`` tries over ``(key, priority)`` into ``folder``; the manifest, one row per shard file."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = [(k.encode(), p) for b in batches for k, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        if not pairs:
            return
        trie = KeyTrie.build(pairs)
        store, place = _store(folder)
        store.create_dir(place, recursive=True)
        name = f"{uuid.uuid4().hex}.trie"
        with store.open_output_stream(f"{place}/{name}") as out:
            for part in trie.tobytes():
                out.write(part)
        values = (f"{folder}/{name}", *trie.measures())
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["path", "nodes", "forks", "keys", "key_bytes"])

    return keys.select("key", "priority").repartition(shards, "key").mapInArrow(build, _MANIFEST)


@lru_cache(maxsize=256)
def _mapped(path: str, *measures: int) -> KeyTrie:
    return KeyTrie.over(pa.memory_map(path).read_buffer(), *measures)


@lru_cache(maxsize=OPEN_SHARDS)
def _read(path: str, *measures: int) -> KeyTrie:
    store, place = _store(path)
    with store.open_input_file(place) as f:
        return KeyTrie.over(f.read_buffer(), *measures)


def open_shard(path: str, *measures: int) -> KeyTrie:
    """A shard file by its manifest row: mapped where the folder is mounted, else read."""
    store, place = _store(path)
    return _mapped(place, *measures) if isinstance(store, pafs.LocalFileSystem) else _read(path, *measures)


def scan_texts(texts: DataFrame, manifest: list[tuple]) -> DataFrame:
    """``(text, key, priority)`` of the best key over all shards for every row of ``texts`` that holds one."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0).drop_null().cast(pa.large_binary())
            n = len(column)
            if not n:
                continue
            offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, 8 * column.offset)
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
            best: list[tuple | None] = [None] * n
            for shard in manifest:
                trie = open_shard(*shard)
                ranks = trie.best(data, offsets[1:], int(offsets[0]))
                for i in np.flatnonzero(ranks != NONE):
                    found = int(trie.priority[ranks[i]]), trie.key(ranks[i])
                    if best[i] is None or found < best[i]:
                        best[i] = found
            hits = [i for i, b in enumerate(best) if b is not None]
            yield pa.RecordBatch.from_arrays(
                [column.take(pa.array(hits, pa.int64())).cast(pa.large_string()).cast(pa.string()),
                 pa.array([best[i][1] for i in hits], pa.string()), pa.array([best[i][0] for i in hits], pa.int64())],
                names=["text", "key", "priority"])

    return texts.select("text").mapInArrow(scan, "text string, key string, priority long")
