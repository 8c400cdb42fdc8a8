import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, tag string, digest string, score string"


@pytest.fixture(scope="session")
def odd_docs():
    """Rows with nulls, empty and very long texts, copies, repeated rows, and columns that clash with names used inside."""
    rng = random.Random(7)
    words = ["alpha", "beta", "Gamma", "delta.", "été", "日本", "zeta,", "eta", "theta\n", "iota"]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "x", "yz"]) for _ in range(n))
    shared, long = prose(60), prose(30_000)
    lines = "\n".join(prose(8).replace("\n", " ") for _ in range(30))
    texts = [None, "", " ", "a", prose(3), shared, shared, prose(40) + shared + prose(30), long, long + " end", "Er " * 400, lines, "head line\n" + lines, lines, "\n\n\n", prose(200), shared.upper()]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, shared), (15, texts[15]), (None, shared), (None, None), (None, lines), (40, prose(5))]
    return [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t), 1, "t", "d", "s") for i, t in rows]


@pytest.fixture(scope="session")
def docs(spark, odd_docs):
    return spark.createDataFrame(odd_docs, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
