"""Small awkward tables every operator must take."""

import pytest

LONG = " ".join(f"word{i % 5000} of{i % 7} the{i}" for i in range(60_000))
NASTY = [
    (1, None), (2, ""), (3, " \n\t \x0b "), (4, "a"), (5, "One two THREE four"), (6, LONG), (7, LONG),
    (8, "!!! 123 ??? 45."), (9, "One two three four"), (9, "One two three four"), (None, "an id is missing here today"),
    (10, "Straße déjà ñandú 中文 𐍈 <|endoftext|> ▁x  \r\n y "), (11, "one two three four five six seven eight nine ten"),
    (12, "one two three four five six seven eight nine ten"),
]


@pytest.fixture(scope="session")
def nasty(spark):
    """doc_id, text, lang, source and extra columns whose names clash with results and helpers."""
    rows = [(i, t, "en" if i and i % 2 else None, "s", 1.5, True, 7, "x", 3) for i, t in NASTY]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, score double, held_out boolean, n_tokens long, "
              "`a.b c` string, id int")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def sf(spark):
    return "/root/testdata/sf0.001"
