from __future__ import annotations

import pyarrow.parquet as pq
import pytest

from tests.conftest import SF_DIR


@pytest.fixture(scope="session")
def rows():
    """``rows("documents")``: the rows of a test table as dicts."""
    return lambda name: pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(frame):
    """``docs([(doc_id, text, source), ...])``"""
    return lambda given: frame(DOCS, [(i, t, None, s, None) for i, t, s in given])
