"""The corpus pipeline against a plain-Python version, and its stages on awkward tables."""

import math

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from profilekit.llm import stages, toxicity
from tests.llm.conftest import NASTY
from tests.llm.test_similar import brute_documents

SF = "/root/testdata/sf0.01"


def plain_toxic(model, text):
    """Score of a text with every entry tried at every word."""
    folded = toxicity.fold(text)
    free = [toxicity.fold(e)[:-1] for e in model["exceptions"]]
    total, at = 0.0, 0
    while at < len(folded) - 1:
        found = [(w, t) for t, w in model["weights"].items() if folded.startswith(t, at)]
        spans = [(k, k + len(e)) for e in free for k in range(max(0, at - len(e)), at + 1) if folded.startswith(e, k)]
        if found:
            w, t = max(found)
            if not any(a <= at and at + len(t) <= b + 2 for a, b in spans):
                total += w
        at = folded.index(" ", at + 1)
    n = folded.count(" ") - 1
    x = (math.log1p(total), math.log1p(1000 * total / max(n, 1)), 1.0)
    z = sum(c * f for c, f in zip(model["curve"], x, strict=True))
    return 1 / (1 + math.exp(-max(-30, min(30, z)))) >= toxicity.THRESHOLD


def test_run_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id: r for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    model = toxicity.learn(docs.filter(F.col("doc_id").isin(list(kept))), spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {i: r for i, r in kept.items() if not plain_toxic(model, r.text)}
    groups = brute_documents([(i, r.text) for i, r in kept.items()], stages.SIMILAR)
    kept = {i: r for i, r in kept.items() if groups[i][2]}
    kept = {i: r for i, r in kept.items() if not any(x in r.text for x in items)}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = corpus_pipeline.run(spark, SF).collect()
    assert len(kept) < docs.count()
    assert {r.doc_id: list(r.ids) for r in got} == {i: library.encode(r.text) for i, r in kept.items()}
    assert all(r.n_tokens == len(r.ids) and r.round_trip and r.lang == kept[r.doc_id].lang for r in got)


def test_stages_are_the_five_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "toxicity", "near_duplicates", "decontamination", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


def test_stages_on_awkward_documents(spark, nasty, no_docs):
    letters = sorted((i for i, t in NASTY if any(c.isalpha() for c in t or "")), key=str)
    got = stages.known_language(spark, nasty, SF)
    assert got.columns == nasty.columns and ids(got) == letters
    unlabelled = stages.known_language(spark, nasty.withColumn("lang", F.lit(None).cast("string")), SF)
    assert unlabelled.columns == nasty.columns and ids(unlabelled) == letters

    got = stages.not_toxic(spark, nasty, SF)
    assert got.columns == nasty.columns and ids(got) == sorted((i for i, _ in NASTY), key=str)

    got = stages.one_of_each_group(spark, nasty, SF)
    assert got.columns == nasty.columns and ids(got) == sorted([1, 2, 3, 4, 5, 6, 8, None, 10, 11], key=str)
    twice = nasty.filter("doc_id = 9")
    assert twice.count() == 2 and ids(stages.one_of_each_group(spark, twice, SF)) == [9]

    got = stages.free_of_benchmarks(spark, nasty, SF)
    assert got.columns == nasty.columns and ids(got) == sorted((i for i, _ in NASTY), key=str)

    got = stages.encoded(spark, nasty, SF)
    assert got.columns[:3] == ["doc_id", "lang", "source"] and got.count() == len(NASTY)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, no_docs, SF)
        assert out.count() == 0
