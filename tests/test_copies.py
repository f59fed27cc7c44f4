"""Queries against their SQL over tables in which rows stand several times with other keys, so that many compete."""

import duckdb
import pytest

from sparkledger import catalog_sheets as catalog
from tests.test_catalog import SF, plain


@pytest.fixture(scope="module")
def copies(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("copies"))
    con = duckdb.connect()
    con.execute(f"COPY (SELECT o.* REPLACE (o_orderkey + k * 1505 AS o_orderkey, o_custkey + k * 1000 AS o_custkey) FROM '{SF}/orders.parquet' o, range(4) r(k)) TO '{folder}/orders.parquet'")
    con.execute(f"COPY (SELECT c.* REPLACE (c_custkey + k * 1000 AS c_custkey) FROM '{SF}/customer.parquet' c, range(4) r(k)) TO '{folder}/customer.parquet'")
    for name in ("orders", "customer"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return folder, con


@pytest.mark.parametrize("name", ["match_stats", "match_two_pass", "unmatched_in", "unmatched_out", "reverse_split_all", "reverse_split", "split_match", "match_contended", "split_match_all"])
def test_copies_give_the_rows_of_sql(spark, copies, name):
    folder, con = copies
    got, expected = catalog.QUERIES[name](spark, folder).toPandas(), con.execute(catalog.ORACLES[name]).df()
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns and len(expected)
    rows = lambda df: sorted((tuple(map(plain, r)) for r in df[columns].astype(object).values.tolist()), key=str)
    assert rows(got) == rows(expected)
