"""Listings are stored as the table columns they are made of; the cleaning over them equals the one over listings."""

from datetime import date

from pyspark.sql import functions as F

from listing_yield.operators import dedup
from listing_yield.plans import cleaning
from listing_yield.sources import adapter


def tables(spark, folder):
    line = [(k, k % 3 + 1, k % 4, n, float(k % 9 + 1), 9e4 + k, 0.05, 0.02 * (k % 2), "ARN"[k % 3], "OF"[k % 2],
             date(1996, 1, 1 + k % 5)) for k in range(1, 90) for n in (1, 1, 2)]  # each order's first line stands twice
    made = {"lineitem": (line, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, "
                               "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                               "l_linestatus string, l_shipdate date"),
            "part": ([(i, f"name {i}", t, i * 7) for i, t in ((1, "ECONOMY"), (2, "LARGE"), (3, "PROMO"))],
                     "p_partkey long, p_name string, p_type string, p_size long"),
            "supplier": ([(i, i % 2) for i in range(4)], "s_suppkey long, s_nationkey long"),
            "nation": ([(0, "PERU", 1), (1, None, 2)], "n_nationkey long, n_name string, n_regionkey long")}
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_cleaning_over_stored_rows(spark, tmp_path):
    rows = adapter.base(spark, tables(spark, tmp_path)).withColumn(dedup.COPY, F.monotonically_increasing_id())
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    assert "row_id" not in rows.columns and "url" not in rows.columns  # made by each reader
    lists = adapter.view(rows.drop(dedup.COPY))
    got, want = cleaning.tag_until(rows, 5, view=adapter.view), cleaning.tag_until(lists, 5)
    assert set(got.columns) == set(want.columns)
    found = got.select(*want.columns).collect()
    assert sorted(map(str, found)) == sorted(map(str, want.collect()))
    alive = [r.row_id for r in found if r.motivo_exclusion is None]
    assert len(alive) == len(set(alive)) > 0 and any(r.motivo_exclusion == "duplicado_url" for r in found)


def test_levels_shuffle_no_row_twice(spark, tmp_path):
    """Survivors are not written, and both readers of a level share its shuffle."""
    rows = adapter.base(spark, tables(spark, tmp_path)).withColumn(dedup.COPY, F.monotonically_increasing_id())
    rows.write.parquet(str(tmp_path / "rows"))
    view = adapter.view(spark.read.parquet(str(tmp_path / "rows")))
    levels = dedup.cascade_levels(view)
    assert levels.columns == [dedup.COPY, dedup.LEVEL]
    levels.collect()
    plan = levels._jdf.queryExecution().executedPlan().toString()
    assert "dedup-s1" not in plan and "ReusedExchange" in plan
