"""Every registered query of the ledger against its SQL, at the smallest scale; and what plans must not hold."""

import os

import duckdb
import pandas as pd
import pytest

from sparkledger import catalog_sheets as catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or value != value:
        return None
    if isinstance(value, float):
        return str(int(value)) if value == int(value) else repr(round(value, 9))
    return str(value)[:10] if hasattr(value, "year") else str(value)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    got, expected = catalog.QUERIES[name](spark, SF).toPandas(), duck.execute(catalog.ORACLES[name]).df()
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns
    rows = lambda df: sorted((tuple(map(plain, r)) for r in df[columns].astype(object).values.tolist()), key=str)
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("name", ["match_exact_key", "group_count_match", "monthly_totals_diff", "registry_merge", "unique_amounts"])
def test_no_nested_loops(spark, name, capsys):
    catalog.QUERIES[name](spark, SF).explain("formatted")
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_columns_and_filters_reach_the_scan(spark, capsys):
    catalog.QUERIES["monthly_matrix"](spark, SF).explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters" in plan and "o_orderpriority" not in plan
