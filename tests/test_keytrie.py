"""Key shards as mapped tries: against brute force, many shards, shared prefixes, plans without grams."""

import random

import numpy as np
import pyarrow as pa
import pytest

from profilekit.operators import keytrie, substring
from profilekit.operators.substring import first_key_match
from tests.conftest import plan_text


def want(texts, keys):
    out = {}
    for t in texts:
        hits = [(p, k) for k, p in keys if k in t] if t else []
        if hits:
            out[t] = min(hits)
    return out


def walk(trie, texts):
    col = pa.array(texts, pa.large_string()).cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1)
    ranks = trie.best(np.frombuffer(col.buffers()[2] or b"", np.uint8), offsets[1:], int(offsets[0]))
    return {t: (int(trie.priority[r]), trie.key(r)) for t, r in zip(texts, ranks, strict=True) if r != keytrie.NONE}


@pytest.mark.parametrize("seed", range(6))
def test_trie_equals_brute_force(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(keytrie, "WALK", rng.choice((7, 1000)))
    letters = rng.choice(("ab", "abcé中𐍈", "xyz "))
    keys = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))): rng.randrange(0, 40) for _ in range(rng.choice((1, 5, 300)))}
    texts = list({"".join(rng.choice(letters + "q") for _ in range(rng.choice((0, 3, 30, 400)))) for _ in range(80)})
    trie = keytrie.KeyTrie.build([(k.encode(), p) for k, p in keys.items()])
    assert walk(trie, texts) == want(texts, keys.items())


def test_shard_file_mapped_or_read_gives_the_same_trie(tmp_path):
    trie = keytrie.KeyTrie.build([(b"alpha", 3), (b"alphabet", 1), (b"beta", 2), ("é".encode(), 9)])
    f = tmp_path / "x.trie"
    f.write_bytes(b"".join(trie.tobytes()))
    texts = ["an alphabet", "beta alpha", "né", "", "none"]
    for opened in (keytrie.open_shard(f"file:{f}", *trie.measures()), keytrie._read(str(f), *trie.measures())):
        assert walk(opened, texts) == walk(trie, texts) == {"an alphabet": (1, "alphabet"), "beta alpha": (2, "beta"), "né": (9, "é")}


def test_many_shards_with_a_skewed_prefix(spark, monkeypatch):
    """Two thirds of the keys and most texts begin alike: shards stay even and no text is multiplied."""
    rng = random.Random(9)
    keys = {("the same long beginning " if i % 3 else "") + f"title {rng.randrange(10**6)}": i for i in range(2000)}
    listed = list(keys)
    texts = [f"{rng.choice(listed)} and {rng.choice(listed)} the same long beginning" for _ in range(300)] + ["nothing", "", None]
    texts += [texts[0]] * 50 + ["x" * 50_000 + listed[77]]
    monkeypatch.setattr(substring, "MAX_KEYS", 10)
    monkeypatch.setattr(keytrie, "SHARD_BYTES", 4_000)
    made = []
    monkeypatch.setattr(keytrie, "scan_texts", lambda t, m, old=keytrie.scan_texts: (made.append(m), old(t, m))[1])
    tdf = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    kdf = spark.createDataFrame(list(keys.items()), "k string, p long")
    df = first_key_match(tdf, "t", kdf, "k", "p")
    got = [(r["text"], (r["priority"], r["key"])) for r in df.collect()]
    assert len(got) == len(dict(got)) and dict(got) == want(texts, keys.items())
    sizes = [m[4] for m in made[0]]  # key bytes of each shard
    assert len(sizes) > 10 and max(sizes) < 3 * sum(sizes) / len(sizes)
    plan = plan_text(df)
    assert "Generate" not in plan and "Join" not in plan and plan.count("Exchange") <= 2 * plan.count("HashAggregate")


def test_keys_and_rows_at_the_edges(spark, monkeypatch):
    monkeypatch.setattr(substring, "MAX_KEYS", 0)
    tdf = spark.createDataFrame([("a",), ("é",), ("",), (None,), ("zza",)], "t string")
    kdf = spark.createDataFrame([("a", 5), ("a", 2), ("", 0), (None, 1), ("zzzz", 1), ("\u0000", 3)], "k string, p long")
    got = {r["text"]: (r["key"], r["priority"]) for r in first_key_match(tdf, "t", kdf, "k", "p").collect()}
    assert got == {"a": ("a", 2), "zza": ("a", 2)}
    assert first_key_match(tdf.limit(0), "t", kdf, "k", "p").count() == 0
