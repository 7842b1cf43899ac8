"""Operators 5, 6 and 7 against their libraries."""

import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from profilekit.llm import queries, sentencepieces, token_counts, token_files
from tests.llm.conftest import NASTY

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = st.lists(st.sampled_from(list("aaeiotnsr  \n\t'sdvmlre.,!é中𐍈 \x85\x1c0123-_<|>ABΣİ▁") + [
    "<|endoftext|>", "'re", "the", "ing ", "   "]), max_size=30).map("".join)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_every_prefix_count_is_the_library_s(text):
    library = Tokenizer.from_file(BYTE)
    counter = token_counts.counter(open(BYTE, "rb").read())
    got = np.cumsum(counter.table(text), dtype=int).tolist()
    assert got == [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(1, len(text) + 1)]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_word_encoder_is_the_library(texts):
    library, own = Tokenizer.from_file(WORD), token_files.encoder(open(WORD, "rb").read())
    got = [np.frombuffer(x, own.dtype).tolist() for x in own.encode([t.encode() for t in texts])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_pieces_are_the_library_s_and_decode(texts):
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECE), sentencepieces.pieces(open(PIECE, "rb").read())
    ids, same = own.encode(texts)
    assert [x.tolist() for x in ids] == [library.encode(t) for t in texts]
    assert [own.decode(x).decode() for x in ids] == [t.replace("▁", " ") for t in texts]
    assert all(same)


def _texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def test_counts_query_whole_table_and_awkward_texts(spark, sf, nasty, no_docs):
    library = Tokenizer.from_file(BYTE)
    want = {i: len(library.encode(t, add_special_tokens=False).ids)
            for i, t in _texts(spark.read.parquet(f"{sf}/documents.parquet"))}
    rows = queries.op5_token_counts(spark, sf).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)
    got = token_counts.prefix_tables(nasty).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, len(r.prefix_deltas)) for r in got) == sorted(
        (str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids), len(t or ""))
        for i, t in NASTY)
    assert token_counts.prefix_tables(no_docs).count() == 0


def test_budget_cut_needs_no_second_encoding(spark, nasty):
    library = Tokenizer.from_file(BYTE)
    tables = token_counts.prefix_tables(nasty.filter("doc_id in (2, 5, 10)"), keep=["doc_id", "text"])
    for r in token_counts.cut_to_budget(tables, 3).collect():
        counts = [len(library.encode(r.text[:k], add_special_tokens=False).ids) for k in range(1, len(r.text) + 1)]
        longest = max([k + 1 for k, n in enumerate(counts) if n <= 3], default=0)
        assert (r.cut_chars, r.cut_tokens) == (longest, counts[longest - 1] if longest else 0)


def _want_files(texts, end=2):
    library, at, out = Tokenizer.from_file(WORD), 0, []
    for i, t in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = library.encode(t, add_special_tokens=False).ids + [end]
        out.append((i, at, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files_round_trip(spark, sf, nasty, no_docs):
    got = [tuple(r) for r in queries.op6_token_files(spark, sf).orderBy("doc_id").collect()]
    assert got == _want_files(_texts(spark.read.parquet(f"{sf}/documents.parquet")))
    back = token_files.read_token_files(token_files.write_token_files(nasty), with_ids=True)
    rows = sorted(back.collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows] == _want_files([(i, t or "") for i, t in NASTY])
    assert all(r.ids[-1] == 2 and len(r.ids) == r.n_tokens for r in rows)
    assert token_files.read_token_files(token_files.write_token_files(no_docs)).count() == 0


def test_pieces_query_and_awkward_texts(spark, sf, nasty, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = {i: zlib.crc32(np.asarray(library.encode(t), "<u4").tobytes())
            for i, t in _texts(spark.read.parquet(f"{sf}/documents.parquet"))}
    rows = queries.op7_sentencepiece(spark, sf).collect()
    assert {r.doc_id: r.ids_crc32 for r in rows} == want
    assert all(r.parity and r.round_trip for r in rows)
    got = sentencepieces.encode_pieces(nasty.filter(F.length("text") < 1000)).collect()
    assert all(list(r.ids) == library.encode({i: t for i, t in NASTY}[r.doc_id]) for r in got)
    assert sentencepieces.encode_pieces(nasty).filter("not round_trip or not parity").count() == 0
    assert sentencepieces.encode_pieces(no_docs).count() == 0


def test_model_file_is_read_field_by_field():
    model = sentencepieces.Model(open(PIECE, "rb").read())
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    assert [p for p, _, _ in model.pieces] == [library.id_to_piece(i) for i in range(library.get_piece_size())]
    assert model.kind == sentencepieces.BPE and model.byte_fallback and model.dummy_prefix


def test_ids_are_the_backends(spark, monkeypatch):
    """With a backend that answers otherwise the result changes and parity says so: the library does not stand in for it."""
    own = sentencepieces.Pieces(open(PIECE, "rb").read())
    ids, same = own.encode(["some words here", ""])
    assert all(same) and len(ids[0])

    class Broken:
        def encode_batch_fast(self, segments, **_):
            class One:
                ids = [5]
            return [One() for _ in segments]
    own.backend, own._known = Broken(), {}
    ids, same = own.encode(["some words here", ""])
    assert ids[0].tolist() == [5, 5, 5] and same == [False, True]


def test_shards_are_read_by_as_many_tasks(spark, sf):
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('word', id, ' of text') as text").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so small a table is one shard
    try:
        manifest = token_files.write_token_files(docs)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    shards = manifest.count()
    got = token_files.read_token_files(manifest)
    assert shards > 1 and got.select(F.spark_partition_id().alias("p")).distinct().count() == shards
    assert got.count() == 2000
