import pytest

from bourse.llm.common import table
from tests.conftest import SF001, SF0001


@pytest.fixture(scope="session")
def docs(spark):
    return table(spark, SF001, "documents")


@pytest.fixture(scope="session")
def few(spark):
    return table(spark, SF0001, "documents")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, a very long text, repeated rows, and
    extra columns whose names the operators use themselves."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    long = " ".join(f"{w}{k}" for k in range(20_000) for w in ("lang", "wort"))
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, words), (4, words), (5, words.upper()), (None, words),
            (None, None), (6, long), (7, "x"), (8, "çé ß wide space"), (9, long + " end")]
    return spark.createDataFrame([(i, t, "a", 0, 1, 2) for i, t in rows],
                                 "doc_id long, text string, node string, length int, block int, rid long")
