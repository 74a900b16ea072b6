import pytest

from starmill.llm.common import importable

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def _workers(spark):
    importable(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows of (doc_id, text) with more columns, some named like those that operators use inside."""

    def make(rows):
        full = [(i, t, "en", "s", len(t) if t is not None else None, b"x", 1, [2]) for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, key binary, mark long, ids array<int>"
        )

    return make


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{TABLES}/{name}.parquet")


LONG = "lorem ipsum dolor " * 20_000
EDGES = [(1, None), (2, ""), (3, "   \n\t"), (4, "one"), (5, LONG), (5, LONG), (None, "a row without an id"), (None, None), (7, "é 中 😀 \x1c\x85 x")]


@pytest.fixture(scope="session")
def edges():
    return EDGES
