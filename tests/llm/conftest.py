"""Small frames that hold what every operator must take: nulls in all columns, empty and long texts, repeated rows, clashing names."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string"
PROSE = "the river ran past the old mill and nobody in the village could say when it had last turned its wheel for grain"


@pytest.fixture(scope="session")
def odd_rows():
    long = " ".join(f"word{i % 977} of{i % 13}" for i in range(60_000))
    texts = [None, "", " \n\t", "one", "One two", PROSE, PROSE, PROSE.upper(), long, "\x1c\x85\xa0 é 漢字 😀 a\x00b", "a " * 300, "x" * 40_000, "no-break space   line"]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", None, 0.5, "s") for i, t in enumerate(texts)]
    return rows + [(5, PROSE, "en", None, 1, None, None), (None, PROSE, None, None, None, None, None), (None, None, None, None, None, None, None), rows[3], rows[3]]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
