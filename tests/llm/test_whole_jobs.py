"""Cases the operators once did only in part: each test is of one of them."""

import numpy as np

from profilekit.llm import decontamination, near_duplicates, stages
from tests.llm.test_similar import groups, shingles

SF = "/root/testdata/sf0.01"


def kept_at(rows, percent):
    """Ids of the documents brute force keeps when links share so many per cent of their shingles."""
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if b < a
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sorted(i for i, low in groups(sorted(sets), links).items() if i == low)


def test_stage_drops_near_duplicates_from_four_fifths_on(spark):
    """The stage's rule is a similarity of 0.8, the query's 0.85; also for loose members of a crowd."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(60):
        base, m = [f"d{k}w{i}" for i in range(124)], 8 + k % 9  # 120 shingles, the last m of them changed
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:124 - m] + [f"d{k}x{i}" for i in range(m)]))]
    base = [f"w{i}" for i in range(150)]
    for i in range(120):
        words = list(base)
        for _ in range(2 + i % 4):
            words[rng.integers(0, 150)] = f"x{rng.integers(0, 40)}"
        rows.append((1000 + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    at_stage, at_query = kept_at(rows, 80), kept_at(rows, 85)
    assert 0 < len(at_stage) < len(at_query)
    assert sorted(r.doc_id for r in stages.one_of_each_group(spark, docs, SF).collect()) == at_stage
    assert sorted(r.doc_id for r in near_duplicates.near_duplicates(docs).filter("kept").collect()) == at_query


def test_bands_miss_hardly_any_pair_at_the_threshold():
    assert near_duplicates.banding(85) == (24, 6)
    for percent in (50, 80, 85, 99, 100):
        bands, ranks = near_duplicates.banding(percent)
        assert bands >= 1 and (1 - (percent / 100) ** ranks) ** bands <= near_duplicates.MISS


def leaks(spark, docs, items):
    found = decontamination.find(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string"))
    return {(r.doc_id, r.item_id) for r in found.collect()}


def test_copies_with_other_names_at_sentence_starts_or_one_other_word(spark):
    item = "Tom has 5 apples. Mary has 7 apples. How many apples do they have together?"
    other = "Our river runs past eleven old mills before it meets the cold sea near the port."
    docs = [(1, "Well then. Bob has 8 apples. Sue has 9 apples. How many apples do they have together? Yes."),
            (2, "Here. " + item.replace("many", "numerous")),
            (3, "Bob has 8 apples. " * 20), (4, "How many apples do they have together? I do not know at all."),
            (5, other.replace("meets", "joins")), (6, other.replace("cold", "warm").replace("mills", "towns").replace("past", "by")),
            (7, "Tom Bell has 5 apples. Mary has 7 apples. How many apples do they have together?")]
    assert leaks(spark, docs, [(1, item), (2, other)]) == {(1, 1), (2, 1), (5, 2), (7, 1)}


def test_short_and_slot_dense_items_are_found_word_for_word_anywhere(spark):
    items = [(1, "What is 12 + 7?"), (2, "Ann 5 Bob 7 Carl 9 won 3 Dan 4"), (3, "ok then"), (4, "5 6 7 8 9 10"),
             (5, "Tom has 5 apples. Mary has 7 apples. How many apples do they have together?")]
    docs = [(1, "Here it goes on and on: what is 12 + 7? Nobody knows."), (2, "x " * 3000 + items[1][1] + " y"),
            (3, "what is 13 + 7?  And 12 + 7 is what is"), (4, "Ok. Then."), (5, "ok or then"), (6, items[4][1].lower()),
            (7, "5 6 7 8 9 10"), (8, "12 + 7 = 19, what is")]
    assert leaks(spark, docs, items) == {(1, 1), (2, 2), (4, 3), (6, 5)}


def test_rows_of_one_id_with_different_texts_are_documents_of_their_own(spark):
    """Also when one of them is a copy of another document, or both are of one group."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    rows = [(1, a), (5, a + " z"), (5, b), (5, b), (7, c), (7, c + " y"), (9, None), (9, ""), (9, None), (None, a), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in stages.one_of_each_group(spark, docs, SF).collect()), key=str)
    assert [k for k in kept if k[0] == 7] in ([(7, c)], [(7, c + " y")])
    assert [k for k in kept if k[0] != 7] == sorted([(1, a), (5, b), (9, None), (9, ""), (None, a), (None, a)], key=str)
    got = sorted(tuple(r) for r in near_duplicates.near_duplicates(docs.filter("doc_id < 9")).select("doc_id", "component_id").collect())
    assert got == [(1, 1), (5, 1), (5, 5), (5, 5), (7, 7), (7, 7)]


def test_null_ids_are_not_held_out(spark):
    from profilekit.llm import language_id, lm_scoring, toxicity
    one = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    for module in (language_id, lm_scoring, toxicity):
        assert one.select(module.held_out()).first()[0] is False


def test_every_language_is_learnt(spark):
    """A language of few documents among many languages can be predicted too."""
    import random
    from profilekit.llm import language_id
    rng = random.Random(2)
    rows = []
    for k in range(230):
        letters = chr(0x4E00 + 20 * k)  # a script of its own
        for j in range(2 if k else 30):
            rows.append((len(rows), " ".join(chr(ord(letters) + rng.randrange(15)) * 2 for _ in range(25)), f"l{k:03d}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.predict(docs, language_id.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)
    assert len({r.lang_pred for r in got}) > 210
