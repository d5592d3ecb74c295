import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

LONG = "one two three four five six seven eight nine ten " * 40
# NULLs, empty and very long texts, ties, repeated rows, clashing column names
ROWS = [
    (0, "Alpha beta gamma.\nDelta epsilon zeta, eta theta iota kappa lambda mu.", "en", "a", 1, 10),
    (1, None, None, None, 2, 20),
    (2, "", "en", "a", 3, 30),
    (3, LONG, "en", "b", 4, 40),
    (4, "prefix words " + LONG, "fr", "b", 5, 50),
    (5, "été à la plage, où êtes-vous donc passés ce matin là ? " * 30, "fr", "c", 6, 60),
    (6, "été à la plage, où êtes-vous donc passés ce matin là ? " * 30, "fr", "c", 7, 70),
    (6, "été à la plage, où êtes-vous donc passés ce matin là ? " * 30, "fr", "c", 7, 70),
    (None, "no id but words " + LONG[:300], "en", "a", 8, 80),
    (8, "aaaa" * 500, "en", None, 9, 90),
    (9, " \t\n ", "en", "a", 10, 100),
    (10, "x" * 5000 + " " + "y z " * 20000, "en", "c", 11, 110),
]
SCHEMA = "doc_id long, text string, lang string, source string, chunk int, n_words int"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
