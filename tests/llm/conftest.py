import os

import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables here")
    return SF_DIR


@pytest.fixture(scope="session")
def rows_of(sf_dir):
    """Rows of a given table as tuples."""

    def read(table, columns="*"):
        return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{table}.parquet'").fetchall()

    return read


# Column names that operators use inside, to show that they do not clash.
EXTRA = "id string, text_key string, class string, pair string, spans string, k1 string, start string"


@pytest.fixture
def docs_of(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang)``, with clashing columns."""

    def make(rows):
        full = [(*r, *(None,) * (3 - len(r)), *("x",) * 7) for r in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, {EXTRA}")

    return make


@pytest.fixture
def prose():
    """Invented words, the same for the same seed."""
    import random

    def make(n, seed):
        pick = random.Random(seed)
        return " ".join(
            "".join(pick.choice("bdfgklmnprst") + pick.choice("aeiou") for _ in range(pick.randint(1, 4)))
            for _ in range(n)
        )

    return make
