"""Repeated rows, rejects, quantiles, streaming state and the session's shared folder."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_yield.functions import text as X
from listing_yield.operators import dedup, quantiles
from listing_yield.plans import cleaning
from listing_yield.sources import files, payloads
from listing_yield.streaming import ingest

ROWS = "portal string, id_aviso string, url string, fecha_scraping int, precio_valor double"


def test_identical_rows_collapse(spark):
    a, b = ("p", "1", "u1", 1, 5.0), ("p", "2", "u2", 1, 6.0)
    df = spark.createDataFrame([a, a, b, a], ROWS)
    assert dedup.snapshot_merge(df).count() == 2
    assert dedup.first_seen(df).count() == 2
    older = spark.createDataFrame([("p", "1", "u1", 0, 4.0), a, a], ROWS)
    assert [r.precio_valor for r in dedup.snapshot_merge(older).collect()] == [5.0]


def test_cascade_keeps_one_copy(spark):
    schema = T.StructType([f for f in files.LISTING_SCHEMA.fields])
    row = {"portal": "p", "id_aviso": "1", "url": "u", "tipo_propiedad": "ph", "operacion": "venta",
           "precio_valor": 100_000.0, "precio_moneda": "USD", "sup_total_m2": 50.0}
    other = {**row, "id_aviso": "2", "url": "v"}
    df = spark.createDataFrame([row, row, other], schema)
    out = cleaning.tag_until(df, 3).groupBy("motivo_exclusion").count().collect()
    assert {r[0]: r[1] for r in out} == {None: 2, "duplicado_url": 1}


def test_snapshots_to_clean(spark, tmp_path):
    df = spark.createDataFrame([{"portal": "p", "id_aviso": str(i % 3), "url": f"u{i % 3}", "tipo_propiedad": "casa",
                                 "operacion": "venta", "precio_valor": 1000.0 * (i % 3 + 1), "precio_moneda": "USD",
                                 "sup_total_m2": 50.0} for i in range(6)], files.LISTING_SCHEMA)
    files.write_csv(df, str(tmp_path / "x"))
    df.coalesce(1).write.parquet(str(tmp_path / "y"))
    land = tmp_path / "land"
    land.mkdir()
    for i, p in enumerate([*(tmp_path / "x").glob("*.csv"), *(tmp_path / "y").glob("*.parquet")]):
        (land / f"s{i}{p.suffix}").write_bytes(p.read_bytes())
    (land / "bad.parquet").write_bytes(b"PAR1 nothing")
    back = files.read_snapshots(spark, str(land))
    assert back.count() == 12
    assert [r.archivo for r in files.unreadable_snapshots(spark, str(land)).collect()] == ["bad.parquet"]
    kept, excluded = cleaning.clean(dedup.snapshot_merge(back))
    assert kept.count() == 3 and excluded.count() == 0
    assert files.read_snapshots(spark, str(tmp_path / "absent")).count() == 0


def test_pages_and_items_are_counted(spark):
    pages = ['[{"id":"","internalId":"77","slug":"","price":"145000"}, 5, {"id":"1"}]', '{"data":{"data":[{"id":"2"}',
             '{"x":1}', None, '{"content":[{"id":"3","location":{"coordinates":["-58", null]}}]}', "[]"]
    df = spark.createDataFrame([(p,) for p in pages], "value string")
    items = payloads.items_from_pages(df).select("it.id", "it.internalId", "it.price").collect()
    assert {(r.id, r.internalId, r.price) for r in items} == {("", "77", "145000"), ("1", None, None), ("3", None, None)}
    got = {r[0]: r[1] for r in payloads.rejects_from_pages(df).groupBy("motivo").count().collect()}
    assert got == {"json_invalido": 2, "sin_lista": 1, "item_invalido": 1}


def test_strip_accents_is_nfkd(ev):
    import unicodedata
    texts = ["…", "㎡", "ﬁﬂ", "й", "Ñandú ½ ﷺ", "한글", "plain", "", "𝐀ｂ①", "é"]
    want = ["".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]
    assert ev(X.strip_accents, texts) == want


def test_price_text(spark):
    df = spark.createDataFrame([("USD", 85_000_000.0), ("ARS", 0.0), (None, 12.5), ("USD", None), ("USD", 1234567.25)],
                               "m string, v double")
    assert [r[0] for r in df.select(X.price_text("m", "v")).collect()] == [
        "USD 85000000.0", "ARS", "12.5", "USD", "USD 1234567.25"]


@pytest.mark.parametrize("n", [0, 1, 2, 9, 30_000])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    v = np.round(rng.normal(size=n) * 1000, 1)
    g = rng.integers(0, 3, n)
    rows = [(int(a) if a else None, float(b)) for a, b in zip(g, v)] + [(7, None)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = quantiles.exact_quantiles(df, "v", probs, names=list("abcdef")).collect()
    assert len(got) == (n > 0)
    if n:
        assert got[0].n == n and np.allclose([got[0][c] for c in "abcdef"], np.quantile(v, probs), rtol=1e-12)
    by = {r.g: r for r in quantiles.exact_quantiles(df, "v", [0.5], ["g"], ["m"]).collect()}
    assert set(by) == {int(a) if a else None for a in g}
    for k, r in by.items():
        assert np.isclose(r.m, np.median(v[g == (k or 0)]), rtol=1e-12)


def test_master_is_idempotent(spark, tmp_path):
    rows = [[("p", "1", "u", 1, 5.0), ("p", "2", "v", 1, 6.0)], [("p", "1", "u", 2, 7.0), ("p", "3", "v", 3, 8.0)]]
    land = str(tmp_path / "land")
    for i, part in enumerate(rows):
        spark.createDataFrame(part, ROWS).coalesce(1).write.mode("append").parquet(land)
    schema = spark.read.parquet(land).schema
    args = [str(tmp_path / x) for x in ("state", "master", "metrics")]
    for again in (1, 2):  # a second run without the checkpoint replays the batches over the same folders
        s = ingest.landed_stream(spark, land, schema, max_files=1)
        m = ingest.master_stream(s, *args, checkpoint=str(tmp_path / f"ck{again}"))
        assert {(r.id_aviso, r.url, r.precio_valor) for r in m.collect()} == {("1", "u", 7.0), ("3", "v", 8.0)}
    counts = spark.read.parquet(args[2]).agg(F.sum("n_rows"), F.sum("n_bad")).first()
    assert tuple(counts) == (4, 0)


def test_bad_csv_records_in_a_stream(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.csv").write_text("p,1,u,1,5.0\np,2,v,uno,6.0\n")
    schema = T.StructType.fromDDL(ROWS)
    s = ingest.landed_stream(spark, str(land), schema, "csv", bad_records=True)
    m = ingest.master_stream(s, *[str(tmp_path / x) for x in ("state", "master", "metrics", "ck")])
    assert [r.id_aviso for r in m.collect()] == ["1"]
    assert tuple(spark.read.parquet(str(tmp_path / "metrics")).select("n_rows", "n_bad").first()) == (2, 1)


def test_a_cluster_needs_a_shared_folder():
    code = ("from listing_yield.session import ensure_checkpoint_dir\n"
            "from types import SimpleNamespace as N\n"
            "s = N(conf=N(get=lambda k, d: None), sparkContext=N(getCheckpointDir=lambda: None, master='yarn'))\n"
            "ensure_checkpoint_dir(s)\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    got = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert got.returncode and "spark.checkpoint.dir" in got.stderr


def test_snapshot_states(spark, tmp_path):
    rows = spark.createDataFrame([{"portal": "p", "id_aviso": str(i), "titulo": f"título, {i}"} for i in range(4000)],
                                 files.LISTING_SCHEMA)
    rows.coalesce(1).write.parquet(str(tmp_path / "y"))
    whole = next((tmp_path / "y").glob("*.parquet")).read_bytes()
    rows.limit(0).coalesce(1).write.parquet(str(tmp_path / "z"))
    land = tmp_path / "land"
    land.mkdir()
    (land / "whole.parquet").write_bytes(whole)
    (land / "cut.parquet").write_bytes(whole[: len(whole) // 2])
    (land / "empty.parquet").write_bytes(next((tmp_path / "z").glob("*.parquet")).read_bytes())
    (land / "pages.parquet").write_bytes(whole[:4] + bytes(b ^ 255 for b in whole[4:2000]) + whole[2000:])
    (land / "order.csv").write_text('\ufeffurl,extra,id_aviso,precio_valor,url\n"u,1",x,7,12.5,y\n', encoding="utf-8")
    (land / "latin.csv").write_text("id_aviso,titulo\n1,Núñez\n2,plain\n", encoding="latin-1")
    (land / "bad.csv").write_text("id_aviso,precio_valor\n1,a lot\n2,3.5\n")
    (land / "other.csv").write_text("a,b\n1,2\n")
    (land / "none.csv").write_text("")
    (land / "head.csv").write_text("id_aviso,titulo\n")
    (land / "_checkpoint.csv").write_text("id_aviso\n1\n")
    got = {r.archivo: r for r in files.snapshot_status(spark, str(land)).collect()}
    assert {k: (r.estado, r.filas, r.filas_malas) for k, r in got.items()} == {
        "whole.parquet": ("ok", 4000, 0), "cut.parquet": ("danado", 0, 0), "empty.parquet": ("vacio", 0, 0),
        "pages.parquet": ("danado", 0, 0), "order.csv": ("ok", 1, 0), "latin.csv": ("codificacion", 2, 0),
        "bad.csv": ("registros", 2, 1), "other.csv": ("cabecera", 0, 0), "none.csv": ("vacio", 0, 0),
        "head.csv": ("vacio", 0, 0)}
    assert got["cut.parquet"].error and got["pages.parquet"].error and got["whole.parquet"].filas_esperadas == 4000
    back = files.read_snapshots(spark, str(land))
    assert back.schema.simpleString() == files.LISTING_SCHEMA.simpleString()
    assert len(back.select("id_aviso", "portal", "titulo").collect()) == 4000 + 1 + 2 + 2
    assert [(r.url, r.precio_valor) for r in back.where("id_aviso = '7' and portal is null").collect()] == [("u,1", 12.5)]
    assert files.snapshot_status(spark, str(tmp_path / "absent")).count() == 0
