"""The registered queries on the given tables."""

import pytest

from __spark_entry__ import queries
from orderloom.llm.queries import QUERIES
from orderloom.llm.sql import ORACLE
from tests.compare import connect, difference

TABLES = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(queries()) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    assert difference(spark, connect(TABLES), TABLES, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_a_row_for_every_row(spark, name):
    found = QUERIES[name](spark, TABLES)
    keys = {
        "op6_hnsw": ("query_id", "embeddings"),
        "op8_crf_extraction": ("page_id", "pages"),
        "op13_structure_repair": ("conv_id", "conversations"),
    }
    key = keys.get(name, ("doc_id", "documents"))
    given = spark.read.parquet(f"{TABLES}/{key[1]}.parquet")
    if name == "op6_hnsw":
        given = given.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    ids = {r[0] for r in given.select(key[0]).collect()}
    assert {r[0] for r in found.select(key[0]).collect()} == ids
