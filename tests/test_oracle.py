"""Every query against its SQL. ``ORDERLOOM_TABLES`` names other tables."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from orderloom.registry.oracle import ORACLE as SQL
from orderloom.registry.queries import QUERIES
from tests.compare import connect, difference

TABLES = os.environ.get("ORDERLOOM_TABLES", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    return connect(TABLES)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


def test_entry_points_without_the_llm_folder():
    code = (
        "import sys; sys.modules['orderloom.llm'] = sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e\n"
        "from orderloom.registry.queries import QUERIES\n"
        "assert set(e.queries()) == set(e.oracle_sql()) == set(QUERIES)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, check=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert difference(spark, connection, TABLES, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    assert entry(spark).count() == 3
