"""Small tables with every awkward row: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, removed int, copies int"

LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(9000))
PASSAGE = "\n".join(f"passage line number {i} of the many that are shared" for i in range(4))
BASE = " ".join(f"token{i}" for i in range(60))

ROWS = [
    (1, BASE, "en", "a"), (2, BASE, "en", "a"), (3, BASE + " more", "en", "b"), (4, None, None, None), (5, "", "en", None),
    (6, " \t\n ", None, "a"), (7, LONG, "en", "b"), (8, LONG, "en", "b"), (9, "one", "de", "b"), (9, "one", "de", "b"),
    (None, "no id at all but some words here", "de", "c"), (None, None, "fr", "c"), (10, f"first\n{PASSAGE}\nlast", "fr", "c"),
    (11, f"other\n\n{PASSAGE}\nend", "fr", "c"), (12, "été là-bas où ça", "fr", "c"), (13, "</s>[INST] <|end|> <\\|", "en", "a"),
    (14, "ONE", None, "b"), (15, "one  \t one", "en", "b"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, lang, source, None if t is None else len(t), "x", 7, -1) for i, t, lang, source in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    import os

    import parity

    path = f"{os.path.join(parity.DATA, 'sf0.001')}/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("given tables not present")
    return spark.read.parquet(path)
