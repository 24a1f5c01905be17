"""Registered queries against their DuckDB oracles, and the pipeline stage by stage on a small table."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "labels")


def clean(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", ["op2_url_filters", "op3_exact_search", "op4_quality_rules", "op5_secret_scans",
                                  "op6_line_dedup", "op7_near_dedup", "op9_mixing", "op11_warc_bundles",
                                  "op13_hard_negatives"])
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    got = sorted(tuple(map(clean, r)) for r in df.select(*sorted(df.columns)).collect())
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    assert [cols[i] for i in order] == sorted(df.columns)
    assert got == sorted(tuple(clean(r[i]) for i in order) for r in res.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P
    from listing_yield.llm import quality_rules
    from test_groups import brute_groups, brute_lines

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, tables = docs.columns, {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        assert glob.glob(str(tmp_path / name / "*.parquet"))
        docs = spark.read.parquet(str(tmp_path / name))
        tables[name] = docs
        if name != "packing":
            assert docs.columns == columns
    rows = lambda n: {r.doc_id: r.text for r in tables[n].collect()}
    start = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    judged = {i: quality_rules.judge(t) for i, t in start.items()}
    quality = rows("quality_rules")
    assert quality == {i: j[-1] for i, j in judged.items() if j[-2]}
    gone = brute_lines(sorted(quality.items()))
    lines = rows("line_dedup")
    left = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in quality.items()}
    lost = {i for i, _ in gone}
    assert lines == {i: t for i, t in left.items() if i not in lost or t.strip(" \t\n\r\x0b\x0c")}
    parts = brute_groups(sorted(lines.items()), 5, 80)
    near = rows("near_dedup")
    assert set(near) == {i for i, (_, c) in parts.items() if i == c}
    mixed = rows("mixing")
    assert set(mixed) <= set(near) and len(mixed) > 0.5 * len(near)
    pieces = tables["packing"].collect()
    assert {r.doc_id for r in pieces} == set(mixed)
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())


def test_every_query_is_registered():
    names = E.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert set(E.oracle_sql()) <= set(names)
