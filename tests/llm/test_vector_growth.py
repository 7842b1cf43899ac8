"""Operator 8 at sizes past a cell, an exact comparison and a group: the same results, and work that grows with the rows."""

import numpy as np
import pyarrow as pa
import pytest

from profilekit.llm import vector_duplicates
from tests.llm.test_similar import brute_vectors, near_vectors


def table_of(spark, rng, vectors, labels=2):
    rows = [(int(i), [float(np.float32(x)) for x in v], int(i % labels)) for i, v in zip(rng.permutation(len(vectors)), vectors, strict=True)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


def awkward(rng):
    vectors = near_vectors(rng, 260, 32, 0.05) + near_vectors(rng, 90, 32, 0.12) + rng.standard_normal((300, 32)).tolist()
    for v in rng.standard_normal((60, 32)):
        vectors += (v + 0.02 * rng.standard_normal((2, 32))).tolist()
    return vectors + [vectors[0]] * 30 + [[3 * x for x in vectors[1]]] * 2 + rng.standard_normal((40, 5)).tolist()


@pytest.mark.parametrize("bounds", [{"CELL": 100}, {"GROUP": 25, "BLOCK": 40}])
def test_labels_past_a_cell_and_components_past_a_group(spark, monkeypatch, bounds):
    for name, value in bounds.items():  # both are read by the driver
        monkeypatch.setattr(vector_duplicates, name, value)
    rng = np.random.default_rng(5)
    rows, df = table_of(spark, rng, awkward(rng))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_duplicates.vector_duplicates(df).collect()}
    assert got == brute_vectors(rows)


@pytest.mark.parametrize("bounds", [
    {}, {"EXACT": 50, "LEAF": 40}, {"FEW": 10, "ROWS": 16}, {"PRODUCT": 900}, {"SMALL": 20, "ROWS": 16, "CELL_BYTES": 9_000},
    {"CELL": 100, "LEAF": 40}, {"CELL": 15, "LEAST_SAMPLE": 4, "LEAF": 10, "CELL_BYTES": 20_000}])
def test_cells_of_any_size_show_what_hangs_together(monkeypatch, bounds):
    """All steps of all cells, without Spark (its workers would not see the bounds)."""
    for name, value in bounds.items():
        monkeypatch.setattr(vector_duplicates, name, value)
    rng = np.random.default_rng(7)
    rows = {tuple(np.float32(v).tolist()): (i, i % 2) for i, v in enumerate(awkward(rng))}  # equal vectors: one class
    ids, labels = (np.asarray(x) for x in zip(*rows.values(), strict=True))
    sizes = np.asarray([4 * len(v) for v in rows])
    kinds = labels + 10 * (sizes == 20)
    n = np.asarray([(kinds == k).sum() for k in kinds])
    table = pa.table({"kind": kinds, "n": n, "size": pa.array(sizes, pa.int32()), "id": ids,
                      "v": pa.array([np.float32(v).tobytes() for v in rows], pa.binary())})
    hot = [int(k) for k in np.unique(kinds) if (kinds == k).sum() > vector_duplicates.CELL]
    units = {k: vector_duplicates.unit_rows(np.asarray([v for v, own in zip(rows, kinds, strict=True) if own == k])).astype(np.float32) for k in hot}
    low = np.arange(ids.max() + 1)
    for step in range(vector_duplicates.TREES if hot else 1):
        trees = {k: vector_duplicates.Tree(units[k], 1.0, [128, step], vector_duplicates.CELL) for k in hot}
        some = table.filter(pa.array(np.isin(kinds, hot))) if step else table
        dealt = pa.Table.from_batches(vector_duplicates.deal(iter(some.to_batches(max_chunksize=70)), trees, 3, "<f4"))
        dealt = dealt.sort_by([("size", "ascending"), ("key", "ascending"), ("cell", "ascending")])
        for links in vector_duplicates.link_cells(iter(dealt.to_batches(max_chunksize=5)), "<f4", step):
            vector_duplicates.unite(low, links.column(0).to_numpy(), links.column(1).to_numpy())
    want = brute_vectors([(int(i), list(v), int(k)) for v, i, k in zip(rows, ids, kinds, strict=True)])
    assert {i: int(low[i]) for i in want} == {i: component for i, (_, component, _) in want.items()}


def compared(monkeypatch, x, step=0):
    """(pairs compared, links) of one cell that holds part of a label."""
    done, near = [0], vector_duplicates.Vectors.near

    def count(self, a, b, unit=None):
        done[0] += len(a) * len(b)
        return near(self, a, b, unit)
    monkeypatch.setattr(vector_duplicates.Vectors, "near", count)
    raw = np.ascontiguousarray(x, np.float32).view(np.uint8)
    a, _ = vector_duplicates.cell_links(np.zeros(len(x), np.int64), np.arange(len(x)), raw, "<f4", 0, step)
    monkeypatch.setattr(vector_duplicates.Vectors, "near", near)
    return done[0], len(a)


def test_pairs_compared_grow_with_the_rows(monkeypatch):
    """Leaves once held a fixed share of all vectors, and near copies were all compared with each other in every tree."""
    rng = np.random.default_rng(1)
    monkeypatch.setattr(vector_duplicates, "LEAF", 50)
    x = rng.standard_normal((16_000, 32))
    small, large = (compared(monkeypatch, x[:n])[0] for n in (2_000, 16_000))
    assert large < 16 * small < 16_000 ** 2 / 10
    centre = rng.standard_normal(32)
    copies = centre + 0.01 * rng.standard_normal((6_000, 32))
    pairs, links = compared(monkeypatch, copies)
    assert links == 5_999 and pairs < 20 * 6_000


def test_a_crowded_cell_takes_little_memory_at_once(monkeypatch):
    """Members of a crowd meet all other vectors of the cell a few rows at a time."""
    rng, most, near = np.random.default_rng(3), [0], vector_duplicates.Vectors.near
    monkeypatch.setattr(vector_duplicates, "PRODUCT", 20_000)

    def watch(self, a, b, unit=None):
        most[0] = max(most[0], len(a) * len(b))
        return near(self, a, b, unit)
    monkeypatch.setattr(vector_duplicates.Vectors, "near", watch)
    x = np.concatenate((np.ones((4_000, 32)), np.ones((400, 32)) + 0.2 * rng.standard_normal((400, 32)))).astype(np.float32)
    a, _ = vector_duplicates.hanging(vector_duplicates.Vectors(x.view(np.uint8), "<f4"), np.arange(len(x)))
    assert len(a) >= 3_999 and most[0] <= 20_000


def test_upper_trees_leave_no_leaf_far_past_a_cell(monkeypatch):
    """Also where the sample is a small part of the table; a crowd that nothing parts is dealt as pairs of parts."""
    rng = np.random.default_rng(2)
    sample = rng.standard_normal((4_000, 32)).astype(np.float32)
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    tree = vector_duplicates.Tree(sample, 1000, [128, 0], 60_000)
    assert len(tree.holds) > 60 and max(tree.holds) <= 60_000
    crowd = vector_duplicates.Tree(np.repeat(sample[:1], 100, axis=0), 10_000, [128, 0], 60_000)
    ids, seen = np.arange(4_000), {}
    for rows, cells in vector_duplicates.cells_of(crowd, np.repeat(sample[:1], 4_000, axis=0), ids, 60_000):
        for r, c in zip(rows.tolist(), cells.tolist(), strict=True):
            seen.setdefault(c, set()).add(r)
    assert len(crowd.holds) == 1 and len(seen) > 10 and max(map(len, seen.values())) < 2_000
    where = {}
    for c, members in seen.items():
        for r in members:
            where.setdefault(r, set()).add(c)
    assert all(where[a] & where[b] for a, b in rng.integers(0, 4_000, (2_000, 2)).tolist())


def test_components_cut_by_batches_are_counted_whole(monkeypatch):
    monkeypatch.setattr(vector_duplicates, "CELL_BYTES", 100)
    base = np.ones(4, np.float32)
    v = [base.tobytes()] * 10 + [(-base).tobytes()] * 3 + [base.tobytes()]
    table = pa.table({"id": np.arange(14), "component": [0] * 10 + [5] * 3 + [9], "w": [1] * 13 + [4],
                      "size": pa.array([16] * 14, pa.int32()), "v": pa.array(v, pa.binary())})
    got = pa.Table.from_batches(vector_duplicates.count_links(iter(table.to_batches(max_chunksize=3)), "<f4")).to_pylist()
    assert [r["links"] for r in got] == [9] * 10 + [2] * 3 + [0] and [r["id"] for r in got] == list(range(14))
