"""Driver contract: entry runs, every oracle has a query, a sample of oracles agrees at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["barrio", "n_alq", "n_vta", "alq_usd", "venta_usd", "rent_bruta_pct"]
    df.collect()


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", ["yield_by_area", "rule_tally", "dedup_cascade", "parse_prices",
                                  "keyword_flags", "area_model_oof", "stream_dedup"])
def test_oracle_sample(spark, name):
    con = duckdb.connect()
    for t in ["nation", "supplier", "part", "lineitem", "documents", "events", "orders", "customer", "pages"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    plain = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    rows = sorted(tuple(map(plain, r)) for r in df.select(*sorted(df.columns)).collect())
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    orows = sorted(tuple(plain(r[i]) for i in order) for r in res.fetchall())
    assert sorted(cols) == sorted(df.columns)
    assert rows == orows
