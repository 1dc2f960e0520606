import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def docs():
    """The rows of the small table: [(doc_id, text, lang, source)]."""
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()
