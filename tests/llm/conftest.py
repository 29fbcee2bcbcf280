import os

import duckdb
import pytest

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds documents from texts, with awkward extra columns; ids count from 0 unless given."""
    def make(texts, ids=None, sources=None):
        rows = [
            (k if ids is None else ids[k], t, "en", "a" if sources is None else sources[k], len(t or ""), "x", 1, [2], "y")
            for k, t in enumerate(texts)
        ]
        extra = ", label string, `_base` int, block array<int>, `_salt` string"
        return spark.createDataFrame(rows, DOCS + extra).repartition(3)

    return make


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for file in os.listdir(DIRECTORY):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{DIRECTORY}/{file}'")
    yield con
    con.close()
