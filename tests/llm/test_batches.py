"""Where Spark cuts a column of texts into Arrow batches changes no result."""

import pytest

from profilekit.llm import near_duplicates, sentencepieces, text

BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture()
def docs(spark):
    rows = [(i, " ".join(f"w{(i // 3 * 7 + j) % 101}" for j in range(40)) + (" tail" if i % 3 == 2 else "")) for i in range(60)]
    rows += [(60, ""), (61, None), (62, "one"), (62, "one"), (None, "no id at all"), (63, "long " * 50_000)]
    yield spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    text.batches_of(spark.range(0))


def _batches(docs):
    def count(batches):
        for b in batches:
            yield b.select(["doc_id"]).slice(0, 1)
    return docs.mapInArrow(count, "doc_id long").count()


def test_the_bound_is_set_and_holds(spark, docs):
    sentencepieces.encode_pieces(docs)
    assert spark.conf.get(BOUND).rstrip("b") == str(text.BATCH_BYTES)
    assert _batches(docs) == 1
    text.batches_of(docs, 1)
    assert _batches(docs) == docs.count()


@pytest.mark.parametrize("operator", [
    lambda d: sentencepieces.encode_pieces(d),
    lambda d: near_duplicates.grouped(d, threshold=80),
], ids=["sentencepieces", "near_duplicates"])
def test_one_row_a_batch_gives_the_same(docs, operator, monkeypatch):
    def rows():
        return sorted(map(repr, operator(docs).collect()))
    usual = rows()
    assert len(usual) >= 64
    of = text.batches_of
    monkeypatch.setattr(text, "batches_of", lambda df: of(df, 1))
    assert rows() == usual
