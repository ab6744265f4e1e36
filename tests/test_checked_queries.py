"""Every checked query against its SQL, on the given and on skewed tables."""

import duckdb
import pytest

from __spark_entry__ import entry
from checks.catalog import all_queries as queries
from checks.oracle import all_sql as oracle_sql
from checks.compare import differences, duck

GIVEN = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """One part with a third of all line items, a third of the part rows and
    one category of most foods."""
    folder = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    connection.execute(f"""
        COPY (
          SELECT * FROM '{GIVEN}/lineitem.parquet'
          UNION ALL
          SELECT * REPLACE (43 AS l_partkey) FROM '{GIVEN}/lineitem.parquet' WHERE l_orderkey % 2 = 0
        ) TO '{folder}/lineitem.parquet'""")
    connection.execute(f"""
        COPY (
          SELECT * REPLACE (CASE WHEN p_partkey % 4 > 0 THEN 'ECONOMY' ELSE p_type END AS p_type)
          FROM '{GIVEN}/part.parquet'
          UNION ALL
          SELECT p.* FROM '{GIVEN}/part.parquet' p, range(100) WHERE p_partkey = 43
        ) TO '{folder}/part.parquet'""")
    return str(folder)


@pytest.mark.parametrize("key", sorted(oracle_sql()))
@pytest.mark.parametrize("tables", ["given", "skewed"])
def test_equal_to_sql(spark, skewed, tables, key):
    folder = GIVEN if tables == "given" else skewed
    assert differences(queries()[key](spark, folder), duck(folder), oracle_sql()[key]) == []


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_arrays_stay_bounded_for_a_hot_part(spark, skewed):
    from checks.food_tables import KINDS, SLOTS

    sizes = queries()["scan_raw"](spark, skewed)
    assert sizes.where("fdcId = 43").count() == 202
    assert sizes.agg({"n_nutrients": "max"}).first()[0] <= SLOTS * KINDS
