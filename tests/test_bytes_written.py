"""Bytes that round trips, merges and dictionaries write and shuffle."""

import glob
import gzip
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_yield.operators import areas, dedup
from listing_yield.plans import queries_more
from listing_yield.sources import files


def test_compressed_csv_is_bounded_and_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ROWS_PER_FILE", 40)
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("t", T.StringType())])
    df = spark.range(0, 100, 1, 1).select(F.col("id").alias("a"), F.concat(F.lit('x, "y"\n'), "id").alias("t"))
    files.write_csv(df, str(tmp_path / "csv"), compressed=True)
    parts = sorted(glob.glob(str(tmp_path / "csv" / "part-*.csv.gz")))
    assert len(parts) == 3 and gzip.open(parts[0]).read(3) == b"a,t"
    assert sorted(files.read_csv(spark, str(tmp_path / "csv"), schema).collect()) == sorted(df.collect())
    assert files.csv_header(spark, parts[0]) == ("a", "t")
    assert sorted(files.read_snapshots(spark, str(tmp_path / "csv"), schema).collect()) == sorted(df.collect())


def test_pages_of_payload_fields_are_compressed(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, 3 * i, i, i % 7, 100.0 + i, float(i)) for i in range(200)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_extendedprice double, "
                          "l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    at = str(tmp_path / "pages")
    monkeypatch.setattr(queries_more, "_scratch", lambda spark, label: at)
    rows = queries_more.q_payload_fields(spark, str(tmp_path)).count()
    assert rows == sum(i % 8 != 7 for i in range(200))
    assert glob.glob(at + "/part-*.gz") and not glob.glob(at + "/part-*.txt")


def test_keys_are_not_carried_beside_themselves(spark):
    rows = [(f"r{i}", datetime(2026, 1, 1 + i % 3), "p" + "ab"[i % 2], str(i % 4), None if i % 5 == 0 else f"u{i % 6}")
            for i in range(30)]
    df = spark.createDataFrame(rows, "row_id string, fecha_scraping timestamp, portal string, id_aviso string, url string")
    one = dedup.survivors(df, ["portal", "id_aviso"])
    assert one.columns == df.columns
    best = {}
    for r in rows:
        best[r[2:4]] = max(best.get(r[2:4], r), r, key=lambda x: (x[1], x[0]))
    assert sorted(map(tuple, one.collect()), key=str) == sorted(best.values(), key=str)
    plan = one._jdf.queryExecution().analyzed().toString()
    assert "max(struct(" in plan and "portal" not in plan.split("max(struct(")[1].split(")")[0]
    merged = dedup.snapshot_merge(df)
    plan = merged._jdf.queryExecution().analyzed().toString()
    assert "portal" not in plan.split("max(struct(")[1].split(")")[0]  # the second step needs no more than the row
    last = {}
    for r in best.values():
        last[r[4]] = max(last.get(r[4], r), r, key=lambda x: (x[1], x[0]))
    assert sorted(map(tuple, merged.select(df.columns).collect()), key=str) == sorted(last.values(), key=str)


def test_ngrams_go_with_a_short_key(spark):
    names = spark.createDataFrame([("plaza uno", "u", 1, 0), ("calle dos", "d", 0, 0)],
                                  "name string, target string, class int, place long")
    df = spark.createDataFrame([("en Plaza Uno, calle dos",), ("plaza uno",), ("plaza uno",), ("",), (None,)], "t string")
    got = areas.match_dictionary(df, "t", names, "hit")
    assert sorted((r.t or "", r.hit or "") for r in got.collect()) == [
        ("", ""), ("", ""), ("en Plaza Uno, calle dos", "d"), ("plaza uno", "u"), ("plaza uno", "u")]
    assert "substring(unhex(sha2" in got._jdf.queryExecution().analyzed().toString() and areas.KEY_BYTES == 16
