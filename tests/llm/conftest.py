import os

import pytest

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return DIR


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, repeated rows, ties, a long text and extra columns with clashing names."""
    long = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, base, "en", "a", len(base), "x", 1), (1, base, "en", "a", len(base), "x", 1), (2, base, None, None, None, None, 2),
            (3, None, None, "b", 0, "y", 3), (4, "", "de", "b", 0, "y", 4), (5, " \n\t\n", "de", "b", 4, "y", 5),
            (6, long, "en", "a", len(long), "z", 6), (7, long + " tail", "en", "a", len(long) + 5, "z", 7),
            (8, "Grüße ▁ \U0001f389 \u0000 end", "de", "c", 16, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, items string, n_hit int")
