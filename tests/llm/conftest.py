import pytest

LONG = "lorem ipsum dolor " * 40_000
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and
    columns whose names the operators use inside."""
    rows = [
        (1, "Alpha beta gamma delta epsilon zeta\nshared line of more than twenty characters", "en", "s", 10),
        (1, "Alpha beta gamma delta epsilon zeta\nshared line of more than twenty characters", "en", "s", 10),
        (2, "alpha  beta gamma DELTA epsilon zeta\n  Shared line of more than twenty characters ", "en", "s", 10),
        (3, "other words\nshared line of more than twenty characters\ttail", "en", None, 10),
        (4, "x\nshared line of more than twenty CHARACTERS", None, "s", None),
        (5, "", "en", "s", 0),
        (6, None, "de", "s", None),
        (None, "no id here at all but some words", "en", "s", 3),
        (None, None, None, None, None),
        (7, LONG, "en", "s", len(LONG)),
        (8, "\n\n\n", "fr", "s", 3),
        (9, "日本語 \U0001f600 é ß \x00 end", "en", "s", 1),
    ]
    extra = ["_drops", "_drop_id", "_kept_id", "_toxicity", "toxicity", "score", "fp", "token_ids", "key", "_cuts"]
    return spark.createDataFrame(
        [(*r, *["clash"] * len(extra)) for r in rows],
        DOC_SCHEMA + "".join(f", {c} string" for c in extra)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, 1), (None, 1, 1), (4, 0, None), (5, 1, 0), (5, 1, 1)],
                                 "doc_id long, quality int, toxic int")
