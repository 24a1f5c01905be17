"""Registered queries of the library itself against their DuckDB oracles, by value: those of this round's operators, or all
of them with LY_ALL_ORACLES=1 (as ``tools/check_oracles.py`` does)."""

import os
import sys

import duckdb
import pytest

from listing_yield.plans import registry
from listing_yield.session import ship_package

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracles import digest  # noqa: E402

SF = os.environ.get("LY_ORACLE_SF", "/root/testdata/sf0.01")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages"]
RECENT = ["detail_enrich", "stream_keep_first", "area_dictionary", "html_nested_cards", "spearman_price_area",
          "payload_fields"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()) if os.environ.get("LY_ALL_ORACLES") else RECENT)
def test_oracle(spark, con, name):
    ship_package(spark)
    df = registry.all_queries()[name](spark, SF)
    res = con.execute(registry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    got, want = digest(df.columns, map(tuple, df.collect())), digest(cols, res.fetchall())
    assert got[0] == want[0], sorted(set(got[1]) ^ set(want[1]))[:6]
