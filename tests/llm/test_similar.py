"""Operators 3 and 8 against brute force."""

import re

import numpy as np
import pytest

from profilekit.llm import components, near_duplicates, queries, vector_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def groups(ids, links):
    low = {i: i for i in ids}

    def top(i):
        while low[i] != i:
            i = low[i]
        return i
    for a, b in links:
        a, b = top(a), top(b)
        low[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def brute_documents(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    top = groups(ids, links)
    return {i: (len(sets[i]), top[i], i == top[i]) for i in ids}


def test_documents_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op3_near_duplicates(spark, sf).collect()}
    assert got == brute_documents(rows)


def test_chains_and_hot_groups_of_copies(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):  # a drifting chain: neighbours are near, ends are not
        rows.append((i, " ".join(words)))
        words[rng.integers(0, 400)] = f"x{i}"
    rows += [(200 + i, "same text in very many rows of this table") for i in range(300)]
    rows += [(600 + i, " ".join(f"v{int(j)}" for j in rng.integers(0, 50, 30))) for i in range(60)]
    rng.shuffle(rows)
    got = near_duplicates.near_duplicates(spark.createDataFrame([(int(i), t) for i, t in rows], "doc_id long, text string"))
    want = brute_documents([(int(i), t) for i, t in rows])
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got.collect()} == want


def test_loose_members_of_a_crowd(spark, monkeypatch):
    """Copies with one to four changed words: many are near some others only, none of them the base."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(260):
        words = list(base)
        for _ in range(1 + i % 4):
            words[rng.integers(0, 150)] = f"x{rng.integers(0, 40)}"
        if i % 7 == 0:
            del words[rng.integers(0, 150)]
        rows.append((i, " ".join(words)))
    want = brute_documents(rows)
    assert len({c for _, c, _ in want.values()}) > 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for crowd in (4, 1000):
        monkeypatch.setattr(near_duplicates, "CROWD", crowd)
        got = near_duplicates.near_duplicates(docs).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want


def test_awkward_documents(spark, nasty, no_docs):
    got = near_duplicates.near_duplicates(nasty).collect()
    found = {r.doc_id: (r.component_id, r.kept) for r in got}
    assert len(got) == nasty.count() and found[None] == (None, True)
    assert found[1] == (1, True) and found[2] == (2, True) and found[3] == (3, True)
    assert found[7] == (6, False) and found[9] == (5, False) and found[12] == (11, False)
    assert [r.n_shingles for r in got if r.doc_id in (1, 2, 3)] == [0, 0, 0]
    assert near_duplicates.near_duplicates(no_docs).count() == 0


def test_signatures_estimate_similarity_with_less_spread_than_independent_hashes():
    rng = np.random.default_rng(0)
    a, b = [], []
    for _ in range(300):
        common = rng.integers(0, 2**63, 160, dtype=np.uint64)
        a.append(np.concatenate([common, rng.integers(0, 2**63, 40, dtype=np.uint64)]))
        b.append(np.concatenate([common, rng.integers(0, 2**63, 40, dtype=np.uint64)]))
    equal = (near_duplicates.super_min_hash(a, 144) == near_duplicates.super_min_hash(b, 144)).mean(axis=1)
    true = 160 / 240
    assert abs(equal.mean() - true) < 0.006 and equal.std() < 0.95 * (true * (1 - true) / 144) ** 0.5


def test_early_stop_changes_no_signature():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1, 2, 5, 300)]
    together = near_duplicates.super_min_hash(sets, 16)
    for s, row in zip(sets, together, strict=True):
        # element by element: every rank of every element's permutation, no stop
        full = np.full((1, 16), np.iinfo(np.uint64).max, np.uint64)
        for e in s:
            full = np.minimum(full, near_duplicates.super_min_hash([np.asarray([e])], 16))
        assert (full[0] == row).all()


def brute_vectors(rows):
    usable = {}
    for i, v, label in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        if label is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.asarray(v, np.float32).astype(float)
        usable.setdefault(i, (label, x / np.linalg.norm(x)))
    ids = sorted(usable)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k]
             if usable[a][0] == usable[b][0] and len(usable[a][1]) == len(usable[b][1])
             and usable[a][1] @ usable[b][1] >= 0.98]
    top = groups(ids, links)
    counts = dict.fromkeys(ids, 0)
    for pair in links:
        for i in pair:
            counts[i] += 1
    return {i: (counts.get(i, 0), top.get(i, i), top.get(i, i) == i) for i, _, _ in rows if i is not None}


def near_vectors(rng, n, dim, spread):
    centre = rng.standard_normal(dim)
    return [(centre + spread * np.linalg.norm(centre) / dim**0.5 * rng.standard_normal(dim)).tolist() for _ in range(n)]


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_duplicates, "BLOCK", 40)  # several blocks for the hot group
    monkeypatch.setattr(vector_duplicates, "LEAF", 60)
    rng = np.random.default_rng(5)
    vectors = near_vectors(rng, 300, 32, 0.05) + near_vectors(rng, 100, 32, 0.12) + rng.standard_normal((500, 32)).tolist()
    vectors += [vectors[0]] * 30 + [[3 * x for x in vectors[1]]] * 2
    rows = [(int(i), [float(np.float32(x)) for x in v], int(i % 2)) for i, v in zip(rng.permutation(len(vectors)), vectors, strict=True)]
    got = vector_duplicates.vector_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute_vectors(rows)


def test_vectors_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.op8_vector_duplicates(spark, sf).collect()}
    assert got == brute_vectors(rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, nan], 0), (5, [inf, 1.0], 0), (6, [1.0, None], 0),
            (7, [1.0, 2.0], None), (8, [1.0, 2.0], 0), (9, [2.0, 4.0], 0), (9, [2.0, 4.0], 0), (10, [1.0, 2.0], 1),
            (11, [1.0, 2.0, 0.0], 0), (None, [1.0, 2.0], 0), (12, [-1.0, -2.0], 0), (13, [1e-30, 2e-30], 0)]
    df = spark.createDataFrame([(*r, 5, "z") for r in rows],
                               "vec_id long, embedding array<float>, label int, n_links int, id string")
    got = vector_duplicates.vector_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == brute_vectors(rows)
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]
    assert vector_duplicates.vector_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 150, (110, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    links += [(2000, 2000 + i) for i in range(50)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = groups({i for p in links for i in p}, links)
    assert got == {i: c for i, c in want.items() if any(i in p and p[0] != p[1] for p in links)}


def test_marks_are_written_out_only_for_other_components(spark):
    rows = [(i, 1, [10 + i, 20], [0, 3], 0) for i in range(1, 6)] + [(9, 1, [20, 30], [0, 3], 3), (11, 11, [40], [0], 0)]
    deltas = spark.createDataFrame([(*r, 5, [0] * 8, 0) for r in rows], "id long, pivot long, marks array<long>, "
                                   "others array<byte>, bin byte, f long, bits array<long>, twice long")
    placed = spark.createDataFrame([(i, 50, 1) for i in range(1, 6)] + [(9, 50, 9), (11, 50, 11)], "id long, n long, g long")
    got = near_duplicates.open_marks(deltas, placed)
    assert got.columns == ["key", "id", "n", "g", "f", "bits", "twice"]
    assert sorted((r.id, r.key) for r in got.collect()) == [(i, 20) for i in range(1, 6)] + [(9, 20)]
