"""Registered queries: repeated rows, rejects, range filters, sinks, accents, payload fields, details, resume, and the
scoring chain driven by the area-only model (every step of it can be restated in SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import text as X
from ..functions import html as H
from ..operators import areas, dedup, lookups, model, profile, quantiles, rules, scenario, yields
from ..session import materialize, read_table, spread
from ..sources import adapter, files, payloads
from ..streaming import ingest
from . import cleaning
from . import oracles as O
from .queries import _kept, _listings, _numbered, register
from .queries_model import (_rentals_sql, area_model, kept_for_model, net_yield_by_band, ridge_bundle, what_if_input,
                            yield_summary)
from .queries_stream import _scratch, fs_copy
from .queries_text import RID, RID_SQL, _area_sql, _flags_sql

# --------------------------------------------------------------------------- W1-W3 on repeated rows

REPEAT = "CAST(split_part(id_aviso, '-', 1) AS BIGINT) % 5 = 0"


@register("dedup_repeated_rows", O.with_clean(f"""
SELECT 'cascada' AS paso, row_id, CASE WHEN {REPEAT} THEN 2 ELSE 1 END AS filas,
       CASE WHEN motivo_exclusion IS NULL THEN 1 ELSE 0 END AS quedan FROM tagged
UNION ALL
SELECT 'union', row_id, CASE WHEN {REPEAT} THEN 2 ELSE 1 END, 1 FROM (
  SELECT * FROM (SELECT * FROM listings QUALIFY row_number() OVER (PARTITION BY portal, id_aviso
                 ORDER BY fecha_scraping DESC NULLS LAST, row_id DESC) = 1)
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY fecha_scraping DESC NULLS LAST, row_id DESC) = 1)
UNION ALL
SELECT 'primera', row_id, CASE WHEN {REPEAT} THEN 2 ELSE 1 END, 1 FROM (
  SELECT * FROM listings WHERE coalesce(url, id_aviso) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY coalesce(url, id_aviso)
                             ORDER BY fecha_scraping ASC NULLS LAST, row_id ASC) = 1)""", until=3))
def q_dedup_repeated_rows(spark, sf_dir):
    """Every fifth order's rows stand twice: how many copies there are, and how many stay."""
    rows, number = _numbered(spark, sf_dir), F.col(dedup.COPY) * 2
    again = rows.filter(REPEAT.replace("id_aviso", "concat_ws('-', l_orderkey, l_linenumber)"))
    rows = rows.withColumn(dedup.COPY, number).unionByName(again.withColumn(dedup.COPY, number + 1))
    twice = adapter.view(rows.drop(dedup.COPY))
    tagged = cleaning.tag_until(rows, 3, view=adapter.view)
    copies = twice.groupBy("row_id").agg(F.count(F.lit(1)).alias("filas"))
    out = tagged.groupBy("row_id").agg(F.count(F.lit(1)).alias("filas"),
                                       F.count(F.when(rules.alive(), 1)).alias("quedan"))
    out = out.select(F.lit("cascada").alias("paso"), "row_id", "filas", "quedan")
    for name, op in (("union", dedup.snapshot_merge), ("primera", dedup.first_seen)):
        kept = op(twice).groupBy("row_id").agg(F.count(F.lit(1)).alias("quedan"))
        out = out.unionByName(kept.join(copies, "row_id").select(F.lit(name).alias("paso"), "row_id", "filas", "quedan"))
    return out


# --------------------------------------------------------------------------- T5: rejects of pages and CSV files

@register("payload_rejects", """
WITH p AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT 'leidos' AS motivo, sum(n)::BIGINT AS n FROM p WHERE l_orderkey % 7 <> 0 AND l_orderkey % 11 <> 0
UNION ALL SELECT 'json_invalido', count(*) FROM p WHERE l_orderkey % 7 = 0
UNION ALL SELECT 'sin_lista', count(*) FROM p WHERE l_orderkey % 7 <> 0 AND l_orderkey % 11 = 0
UNION ALL SELECT 'item_invalido', count(*) FROM p
  WHERE l_orderkey % 7 <> 0 AND l_orderkey % 11 <> 0 AND l_orderkey % 5 = 0""")
def q_payload_rejects(spark, sf_dir):
    """One page per order: every 7th is cut, every 11th has no list, every 5th holds an item that is no object."""
    li = spread(read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))
    item = F.to_json(F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id")))
    page = li.groupBy("l_orderkey").agg(F.array_join(F.collect_list(item), ",").alias("items"))  # an order's lines
    k = F.col("l_orderkey")
    text = F.concat(F.lit('{"data":{"data":['), F.col("items"),
                    F.when(k % 5 == 0, F.lit(',"suelto"')).otherwise(F.lit("")), F.lit("]}}"))
    value = (F.when(k % 7 == 0, F.expr("substring(text, 1, length(text) - 9)"))
             .when(k % 11 == 0, F.lit('{"data":{"total":1}}')).otherwise(F.col("text")))
    path = _scratch(spark, "pages")
    page.withColumn("text", text).select(value.alias("value")).write.mode("overwrite").text(path)
    pages = spark.read.text(path)
    rejects = payloads.rejects_from_pages(pages).groupBy("motivo").agg(F.count(F.lit(1)).alias("n"))
    return payloads.items_from_pages(pages).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("leidos").alias("motivo"), "n").unionByName(rejects)


@register("csv_rejects", """
SELECT CASE WHEN l_orderkey % 9 = 0 THEN 'malo' ELSE 'bueno' END AS registro, count(*) AS n,
       sum(CASE WHEN l_orderkey % 9 <> 0 THEN l_quantity END) AS suma
FROM lineitem GROUP BY 1""")
def q_csv_rejects(spark, sf_dir):
    li = spread(read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity"))
    path = _scratch(spark, "csv")
    bad = F.when(F.col("l_orderkey") % 9 == 0, F.lit("sin dato")).otherwise(F.col("l_quantity").cast("string"))
    li.select("l_orderkey", bad.alias("precio")).write.mode("overwrite").option("header", True).csv(path)
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("precio", T.DoubleType())])
    back = files.read_csv(spark, path, schema, multi_line=False, bad_records=True)
    kind = F.when(F.col(files.BAD_RECORD).isNotNull(), F.lit("malo")).otherwise(F.lit("bueno"))
    return back.groupBy(kind.alias("registro")).agg(F.count(F.lit(1)).alias("n"), F.sum("precio").alias("suma"))


# --------------------------------------------------------------------------- F16, O5, A24 (filtered mean)

@register("range_filter", O.with_listings("""
SELECT row_id FROM listings WHERE sup_total_m2 BETWEEN 40 AND 80 AND precio_moneda = 'USD'
  AND contains(lower(tipo_propiedad), 'departamento')"""))
def q_range_filter(spark, sf_dir):
    return rules.range_filter(_listings(spark, sf_dir), {"sup_total_m2": (40, 80)}, {"precio_moneda": "USD"},
                              {"tipo_propiedad": "Departamento"}).select("row_id")


@register("head", O.with_listings("SELECT row_id, operacion FROM listings ORDER BY row_id LIMIT 5"))
def q_head(spark, sf_dir):
    return profile.head(_listings(spark, sf_dir), 5, ["row_id"]).select("row_id", "operacion")


@register("usd_rent_mean", O.with_clean(f"""
SELECT {O.sround('avg(precio_m2)', 4)} AS media, count(precio_m2) AS n FROM {O.KEPT} k
WHERE operacion = 'alquiler' AND precio_moneda = 'USD'"""))
def q_usd_rent_mean(spark, sf_dir):
    """Mean price per m2 of the rentals priced in dollars."""
    rows = rules.range_filter(_kept(spark, sf_dir), equals={"operacion": "alquiler", "precio_moneda": "USD"})
    return rows.agg(F.round(F.avg("precio_m2"), 4).alias("media"), F.count("precio_m2").alias("n"))


# --------------------------------------------------------------------------- S8-S11, S15, F13

@register("snapshot_roundtrip", O.with_listings("""
SELECT f.formato, f.captura_ts, operacion, count(*) AS n, count(precio_valor) AS n_precio,
       sum(CASE WHEN f.formato = 'tsv' THEN 0 ELSE balcon END)::BIGINT AS balcones
FROM listings, (VALUES ('parquet', '20260101'), ('parquet', '20260102'), ('tsv', '')) f(formato, captura_ts)
GROUP BY ALL"""))
def q_snapshot_roundtrip(spark, sf_dir):
    """Two captures land as Parquet versions and one as TSV (without portal and flags: F13, S15)."""
    lst = _listings(spark, sf_dir)
    root = _scratch(spark, "versions")
    for ts in ("20260101", "20260102"):
        files.write_snapshot(lst, root, ts)
    back = spark.read.option("basePath", root).parquet(root).select(
        F.lit("parquet").alias("formato"), F.col("captura_ts").cast("string").alias("captura_ts"), "operacion",
        "precio_valor", "balcon")
    path = _scratch(spark, "tsv")
    narrow = rules.drop_columns(lst, ["portal", "balcon"]).select("row_id", "operacion", "precio_valor")
    files.write_csv(narrow, path, sep="\t")
    tsv = files.with_default_flags(spark.read.schema("row_id string, operacion string, precio_valor double")
                                   .options(header=True, sep="\t").csv(path), ["balcon"])
    rows = back.unionByName(tsv.select(F.lit("tsv").alias("formato"), F.lit("").alias("captura_ts"), "operacion",
                                       "precio_valor", "balcon"))
    return rows.groupBy("formato", "captura_ts", "operacion").agg(
        F.count(F.lit(1)).alias("n"), F.count("precio_valor").alias("n_precio"), F.sum("balcon").alias("balcones"))


@register("excluded_sink", O.with_clean("""
SELECT motivo_exclusion, count(*) AS n, count(DISTINCT row_id) AS ids FROM tagged
WHERE motivo_exclusion IS NOT NULL GROUP BY 1"""))
def q_excluded_sink(spark, sf_dir):
    kept, excluded = cleaning.clean(_numbered(spark, sf_dir), view=adapter.view)
    path = _scratch(spark, "excluded")
    files.write_excluded(excluded, path)
    return spark.read.parquet(path).groupBy("motivo_exclusion").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("row_id").alias("ids"))


# --------------------------------------------------------------------------- H2, H3, H14, H37

@register("accents", f"""
SELECT {RID_SQL}, 'nunez ... m2 fi ca' || chr(1080) || ' ha ' || l_linenumber AS clave FROM lineitem""")
def q_accents(spark, sf_dir):
    li = spread(read_table(spark, sf_dir, "lineitem"))
    text = F.concat(F.lit("Núñez … ㎡ ﬁ  ÇÁЙ ｈａ "), F.col("l_linenumber").cast("string"))
    return li.withColumn("t", text).selectExpr(RID, "t").select("rid", X.norm_key("t").alias("clave"))


@register("age_year_built", f"""
SELECT {RID_SQL},
  CAST(CASE WHEN l_orderkey % 4 = 0 THEN 2026 - (1900 + l_partkey % 130) WHEN l_orderkey % 4 = 1 THEN l_partkey % 201 END
       AS INTEGER) AS anios,
  CASE WHEN l_orderkey % 4 = 0 THEN (2026 - (1900 + l_partkey % 130) <= 0)::INT
       WHEN l_orderkey % 4 = 1 THEN (l_partkey % 201 <= 0)::INT END AS a_estrenar
FROM lineitem""")
def q_age_year_built(spark, sf_dir):
    li = spread(read_table(spark, sf_dir, "lineitem"))
    k = F.col("l_orderkey") % 4
    built = (F.when(k == 0, (F.lit(1900) + F.col("l_partkey") % 130).cast("string"))
             .when(k == 1, (F.col("l_partkey") % 201).cast("string")).when(k == 2, F.lit("500")).otherwise(F.lit("n/d")))
    d = li.withColumn("y", built).selectExpr(RID, "y").withColumn("a", X.age_from_year_built("y", 2026))
    return d.select("rid", F.col("a.anios").alias("anios"), F.col("a.a_estrenar").alias("a_estrenar"))


# --------------------------------------------------------------------------- H18, J4, J5: every keyword, alias and name occurs

KEYWORDS = [w.strip() for words in K.FLAG_KEYWORDS.values() for w in words]
PLACES = [*K.AREA_ALIASES, *K.AREA_DISTRICT, "centro cultural once", "bocacalle", "flores y once", "nada"]


def _rendered(words: list[str]) -> str:
    """Each row's text names the word of its turn, in capitals in every second row."""
    turn = " ".join(f"WHEN {i} THEN {O.q(w)}" for i, w in enumerate(words))
    word = f"CASE l_partkey % {len(words)} {turn} END"
    return (f"concat('Depto, ', CASE WHEN l_linenumber % 2 = 0 THEN upper({word}) ELSE {word} END, "
            "' , Capital Federal ', l_suppkey)")


def _rendered_sql(words: list[str]) -> str:
    return f"(SELECT {RID_SQL}, {_rendered(words)} AS text FROM lineitem)"


@register("flag_lexicon", _flags_sql(_rendered_sql(KEYWORDS), "rid"))
def q_flag_lexicon(spark, sf_dir):
    d = spread(read_table(spark, sf_dir, "lineitem")).selectExpr(RID, f"{_rendered(KEYWORDS)} AS text")
    d = d.withColumn("_n", X.norm_key("text"))
    return d.select("rid", *[c.alias(n) for n, c in X.keyword_flags("text", norm=F.col("_n")).items()])


@register("area_lexicon", _area_sql(_rendered_sql(PLACES), "rid"))
def q_area_lexicon(spark, sf_dir):
    d = spread(read_table(spark, sf_dir, "lineitem")).selectExpr(RID, f"{_rendered(PLACES)} AS text")
    return areas.match_areas(d, "text").select("rid", "barrio", "comuna")


@register("area_lexicon_join", _area_sql(_rendered_sql(PLACES), "rid"))
def q_area_lexicon_join(spark, sf_dir):
    """The same match as a join with the lists as a table."""
    d = spread(read_table(spark, sf_dir, "lineitem")).selectExpr(RID, f"{_rendered(PLACES)} AS text")
    found = areas.match_dictionary(d, "text", areas.fixed_dictionary(spark))
    return found.select("rid", "barrio", areas.district_of("barrio").alias("comuna"))


@register("area_dictionary", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'alias-' || o_orderkey
    WHEN l_linenumber IS NOT NULL THEN 'lote-' || o_orderkey || '-' || l_linenumber
    ELSE 'plaza-' || o_custkey END AS lugar
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
  ON l_orderkey = o_orderkey AND l_linenumber = o_orderkey % 7 + 1""")
def q_area_dictionary(spark, sf_dir):
    """A dictionary that grows with the tables: every lot of a street, every customer's square, and aliases of every
    fifth street. A text names a street and lot and a square; an alias wins, then the longer name."""
    o = spread(read_table(spark, sf_dir, "orders")).select("o_orderkey", "o_custkey")
    lots = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    name = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    ok, ln, ck = F.col("l_orderkey"), F.col("l_linenumber"), F.col("o_custkey")
    zero = F.lit(0).cast("long").alias("place")
    names = lots.select(name("Calle Número ", ok, " lote ", ln).alias("name"), name("lote-", ok, "-", ln).alias("target"),
                        F.lit(1).alias("class"), zero)
    names = names.unionByName(o.select(name("plaza ", ck).alias("name"), name("plaza-", ck).alias("target"),
                                       F.lit(1).alias("class"), zero).distinct())
    names = names.unionByName(o.filter("o_orderkey % 5 = 0").select(
        name("calle  numero ", F.col("o_orderkey")).alias("name"), name("alias-", F.col("o_orderkey")).alias("target"),
        F.lit(0).alias("class"), zero))
    text = name("Depto frente a PLAZA ", ck, ", calle número ", F.col("o_orderkey"), " lote ",
                F.col("o_orderkey") % 7 + 1, ".")
    return areas.match_dictionary(o.withColumn("text", text), "text", names, "lugar").select("o_orderkey", "lugar")


# --------------------------------------------------------------------------- S4, F8-F11, H24, H25, H37 with every fallback

PRICE = "CASE WHEN l_orderkey % 5 = 0 THEN 0.0 WHEN l_orderkey % 5 = 1 THEN NULL ELSE l_extendedprice * 100 END"


@register("payload_fields", f"""
SELECT id_aviso, url, precio_valor, precio_moneda, precio_texto, latitud, longitud, sup_total_m2, barrio FROM (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rid,
    CASE WHEN l_orderkey % 6 = 5 THEN '' WHEN l_orderkey % 6 = 4 THEN 'i' || rid ELSE rid END AS id_aviso,
    'https://listings.invalid/' || CASE WHEN l_orderkey % 6 = 4 THEN 'i' || rid WHEN l_orderkey % 6 = 3 THEN rid
      ELSE 's' || rid END AS url,
    {PRICE} AS precio_valor,
    CASE l_linenumber % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'ARS' END AS precio_moneda,
    trim(concat_ws(' ', CASE l_linenumber % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'ARS' ELSE '' END,
      CASE WHEN l_orderkey % 5 < 2 THEN '' ELSE
        CASE WHEN l_extendedprice * 100 = floor(l_extendedprice * 100)
             THEN CAST(CAST(l_extendedprice * 100 AS BIGINT) AS VARCHAR) || '.0'
             ELSE regexp_replace(CAST(CAST(CAST(l_extendedprice * 100 AS VARCHAR) AS DECIMAL(38, 12)) AS VARCHAR), '0+$', '')
        END END)) AS precio_texto,
    CASE l_suppkey % 3 WHEN 0 THEN -34.6 END AS latitud,
    CASE l_suppkey % 3 WHEN 1 THEN NULL ELSE -58.4 END AS longitud,
    CASE WHEN l_partkey % 2 = 0 THEN l_quantity ELSE l_quantity + 1000 END AS sup_total_m2,
    CASE l_partkey % 3 WHEN 0 THEN 'palermo' WHEN 1 THEN 'balvanera' END AS barrio
  FROM (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rid FROM lineitem)
  WHERE l_orderkey % 8 <> 7)""")
def q_payload_fields(spark, sf_dir):
    """One item per row: ids under either key or only in the slug, prices as numbers and as text, zero and missing
    prices, coordinates outside the band or without latitude, land area where no total is given, other cities."""
    li = spread(read_table(spark, sf_dir, "lineitem"))
    rid = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
    k = "pmod(l_orderkey, 6)"
    price = PRICE.replace("l_orderkey % 5", "pmod(l_orderkey, 5)")
    item = f"""named_struct(
      'id', CASE WHEN {k} IN (4, 5) THEN '' ELSE {rid} END,
      'internalId', CASE WHEN {k} = 4 THEN concat('i', {rid}) WHEN {k} = 5 THEN '' END,
      'slug', CASE WHEN {k} IN (3, 4) THEN '' ELSE concat('s', {rid}) END,
      'operation', named_struct('value', 'Sale'),
      'addressInfo', concat(CASE pmod(l_partkey, 3) WHEN 0 THEN 'Palermo Soho' WHEN 1 THEN 'Zona' ELSE 'Otra' END, ', ',
                            CASE WHEN pmod(l_orderkey, 8) = 7 THEN 'Córdoba' ELSE 'Capital  Federal' END),
      'displayAddress', CASE pmod(l_partkey, 3) WHEN 1 THEN 'Once 100' ELSE 'Calle 1' END,
      'currency', named_struct('value', CASE pmod(l_linenumber, 3) WHEN 0 THEN 'Dólar' WHEN 1 THEN 'ARS' ELSE 'x' END),
      'location', named_struct('coordinates', CASE pmod(l_suppkey, 3) WHEN 0 THEN array(-58.4D, -34.6D)
                               WHEN 1 THEN array(-58.4D, -30D) ELSE array(-58.4D, NULL) END),
      'dimensionTotalBuilt', CASE WHEN pmod(l_partkey, 2) = 0 THEN l_quantity ELSE 0D END,
      'dimensionLand', l_quantity + 1000, 'price', {price})"""
    # every second price is sent as text
    text = f"to_json({item})"
    quoted = f"""regexp_replace({text}, '"price":([-0-9.Ee]+)', '"price":"$1"')"""
    pages = li.selectExpr(f"concat('[', CASE WHEN pmod(l_linenumber, 2) = 0 THEN {quoted} ELSE {text} END, ']') AS value")
    path = _scratch(spark, "pages")
    # compressed files can't be split, so each is bounded
    pages.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", files.ROWS_PER_FILE).text(path)
    out = payloads.SOURCES["api_sale"](payloads.read_listing_pages(spark, path))
    return out.select("id_aviso", "url", "precio_valor", "precio_moneda", "precio_texto", "latitud", "longitud",
                      "sup_total_m2", "barrio")


# --------------------------------------------------------------------------- S5, J6, H18-H20, H25, H26, H36: details and enrichment

@register("detail_enrich", f"""
WITH o AS (SELECT *, o_orderkey % 4 AS k FROM orders)
SELECT o_orderkey, CASE WHEN k = 0 THEN CAST(o_custkey % 5 AS INTEGER) END AS dormitorios,
  CAST(CASE WHEN k = 0 THEN o_custkey % 3 WHEN k = 1 THEN 1 END AS INTEGER) AS cocheras,
  CASE WHEN k = 0 THEN 26 END AS antiguedad_anios,
  CASE WHEN k = 0 THEN 'Pileta y balcón' ELSE '' END AS descripcion,
  CASE WHEN k = 0 THEN 'parrilla es-gym x' ELSE '' END AS detalles,
  (k = 0)::INT AS pileta, (k = 0)::INT AS balcon, (k = 0)::INT AS parrilla, (k = 0)::INT AS gimnasio,
  (k = 1)::INT AS cochera_txt,
  CASE k WHEN 0 THEN 'retiro' WHEN 1 THEN 'palermo' WHEN 2 THEN 'la boca' ELSE 'boedo' END AS barrio,
  CASE k WHEN 0 THEN 1 WHEN 1 THEN 14 WHEN 2 THEN 4 ELSE 5 END AS comuna,
  CAST({O.sround('o_totalprice / 50', 2)} AS DOUBLE) AS precio_m2, TIMESTAMP '2026-01-01 00:00:00' AS fecha_scraping
FROM o""")
def q_detail_enrich(spark, sf_dir):
    o = spread(read_table(spark, sf_dir, "orders")).select("o_orderkey", "o_custkey", "o_totalprice")
    k = F.col("o_orderkey") % 4
    empty = F.lit("")
    listing = o.select(
        "o_orderkey", F.concat(F.lit("https://listings.invalid/x/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.lit(None).cast("int").alias("dormitorios"), F.lit(None).cast("int").alias("cocheras"),
        F.lit(None).cast("int").alias("antiguedad_anios"), F.lit(None).cast("int").alias("es_a_estrenar"),
        F.when(k == 1, F.lit("Con COCHERA fija")).otherwise(empty).alias("titulo"), empty.alias("descripcion"),
        empty.alias("detalles"), F.when(k == 2, F.lit("Av. Boca 12")).otherwise(empty).alias("direccion"),
        F.when(k == 1, F.lit("Palermo Viejo")).otherwise(empty).alias("barrio_raw"),
        F.when(k == 3, F.lit("boedo")).alias("barrio"), F.col("o_totalprice").alias("precio_valor"),
        F.lit(50.0).alias("sup_total_m2")).withColumn("slug", payloads.slug_of(F.col("url")))
    feature = lambda v, lang: F.struct(F.lit(v).cast("string").alias("value"), F.lit(lang).alias("lang"))
    record = F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("slug"),
        F.struct((F.col("o_custkey") % 5).alias("bedrooms"), (F.col("o_custkey") % 3).cast("string").alias("parkingSpaces"),
                 F.lit(2000).alias("yearBuilt"), F.lit("Pileta  y balcón").alias("description"),
                 F.array(feature("parrilla", "es"), feature(None, "es-gym"), feature("", "x"),
                         feature(None, "")).alias("features"),
                 F.struct(F.lit("Retiro").alias("citie")).alias("geo")).alias("data")))
    path = _scratch(spark, "details")
    # every third record comes twice, the older one with another number of rooms
    twice = o.filter(k == 0).select("o_orderkey", record.alias("value")).withColumn("again", F.explode(
        F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    older = F.regexp_replace("value", '"yearBuilt":2000', '"yearBuilt":1900')
    twice.select(F.when(F.col("again") == 1, older).otherwise(F.col("value")).alias("value")).write.mode(
        "overwrite").text(path)
    parsed = spark.read.text(path).select(F.from_json("value", payloads.DETAIL_SCHEMA).alias("d")).select("d.*")
    details = materialize(payloads.parse_details(parsed, 2026), "details")
    out = payloads.enrich(lookups.detail_join(listing, details), captured_at="2026-01-01 00:00:00")
    return out.select("o_orderkey", "dormitorios", "cocheras", "antiguedad_anios", "descripcion", "detalles", "pileta",
                      "balcon", "parrilla", "gimnasio", "cochera_txt", "barrio", "comuna", "precio_m2",
                      F.col("fecha_scraping").cast("timestamp_ntz").alias("fecha_scraping"))


# --------------------------------------------------------------------------- T3, T5: a stream that is stopped and taken up again

@register("stream_resume", "SELECT DISTINCT user_id, event_type FROM events")
def q_stream_resume(spark, sf_dir):
    """Half of the events land and the stream is drained; the rest lands and the same checkpoint goes on."""
    ev = read_table(spark, sf_dir, "events")
    land, out, ckpt = (_scratch(spark, x) for x in ("landing", "resumed", "resume-ckpt"))
    for i in (0, 1):
        part = _scratch(spark, "part")
        ev.filter(F.pmod(F.xxhash64("user_id", "ts"), F.lit(2)) == i).write.parquet(part)
        fs_copy(spark, part, land, ".parquet", f"p{i}")
        got = ingest.keep_first_stream(ingest.landed_stream(spark, land, ev.schema, max_files=2),
                                       ["user_id", "event_type"], ["ts", "event_id"], out, ckpt, buckets=8)
    return got.select("user_id", "event_type")


# --------------------------------------------------------------------------- M8-M9, H33, H34, J2, J3, A2, A17, A24 by value

OOF_COLS = ["y", "pred_log", "err_rel", "segmento"]


def area_scores(spark, sf_dir):
    """Sales scored by the area-only model fitted on all rentals, with smearing, coverage, band errors and yields."""
    kept = kept_for_model(spark, sf_dir)
    _, oof = area_model(kept)
    oof = materialize(oof.select(*OOF_COLS), "area-oof")
    rentals = model.rentals_for_model(kept)
    fit = rentals.agg(F.regr_slope("y", "log_sup").alias("b"), F.regr_intercept("y", "log_sup").alias("a"))
    fit = materialize(fit, "area-fit")
    smear = model.smearing(oof)
    band = materialize(model.band_errors(oof), "area-band")
    d = model.sales_for_model(kept)
    line = fit.select("a").scalar() + fit.select("b").scalar() * F.col("log_sup")
    d = d.withColumn("alquiler_est_usd_mes", F.round(F.exp(line) * smear, 2))
    d = lookups.with_coverage(d, lookups.rental_coverage(kept))
    d = lookups.with_band_error(yields.yield_kpis(d), band.select("segmento", "error_segmento"))
    return yields.yield_band(d)


def _scores_sql() -> str:
    gross = O.sround("est_r * 12 / nullif(venta_usd, 0) * 100", 2)
    net = O.sround(f"bruta * {1 - K.VACANCY_PCT / 100!r} * {1 - K.OWNER_COSTS_PCT / 100!r}", 2)
    return _rentals_sql() + f""",
sm AS (SELECT avg(exp(y - pred)) AS s FROM o),
full_fit AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM r),
be AS (SELECT segmento, median(err) AS e FROM o WHERE segmento IS NOT NULL GROUP BY segmento),
cv AS (SELECT barrio, count(*) AS c FROM {O.KEPT} k WHERE operacion = 'alquiler' AND barrio IS NOT NULL GROUP BY barrio),
sa AS (SELECT k.*, {O.sround('exp(a + b * CASE WHEN sup_total_m2 > 0 THEN ln(sup_total_m2) END) * s', 2)} AS est_r,
       {O.bins_sql('sup_total_m2', K.SIZE_BINS, K.SIZE_LABELS)} AS segmento
  FROM {O.KEPT} k, full_fit, sm WHERE operacion = 'venta' AND venta_usd IS NOT NULL AND sup_total_m2 IS NOT NULL
    AND barrio IS NOT NULL),
sb AS (SELECT sa.*, {gross} AS bruta, coalesce(cv.c, 0) AS n_alq_barrio,
       coalesce(be.e, (SELECT median(e) FROM be)) AS error_estimacion
  FROM sa LEFT JOIN cv ON sa.barrio = cv.barrio LEFT JOIN be ON sa.segmento = be.segmento),
scored AS (SELECT *, {net} AS neta, {O.sround('venta_usd / nullif(est_r, 0)', 0)} AS meses,
       {O.sround('bruta * (1 - error_estimacion)', 2)} AS bruta_min,
       {O.sround('bruta * (1 + error_estimacion)', 2)} AS bruta_max FROM sb)"""


def _with_scores(select: str) -> str:
    return O.with_clean((_scores_sql() + "\n" + select).replace("\n, r AS", ", r AS", 1))


@register("area_scores", _with_scores("""
SELECT row_id, est_r AS alquiler_est, n_alq_barrio, (n_alq_barrio >= 10)::INT AS confiable, bruta AS rent_bruta_pct,
       neta AS rent_neta_pct, meses AS meses_repago, bruta_min AS rent_bruta_min, bruta_max AS rent_bruta_max FROM scored"""))
def q_area_scores(spark, sf_dir):
    return area_scores(spark, sf_dir).select(
        "row_id", F.col("alquiler_est_usd_mes").alias("alquiler_est"), "n_alq_barrio",
        F.col("estimacion_confiable").alias("confiable"), "rent_bruta_pct", "rent_neta_pct", "meses_repago",
        "rent_bruta_min", "rent_bruta_max")


@register("area_ranking", _with_scores(f"""
SELECT barrio, count(*) AS n_ventas, median(venta_usd) AS venta_med, median(venta_m2_usd) AS venta_m2,
       median(est_r) AS alq_est, median(bruta) AS rent_bruta, median(neta) AS rent_neta
FROM scored WHERE n_alq_barrio >= {K.MIN_RENTALS_PER_AREA} GROUP BY barrio HAVING count(*) >= {K.RANKING_MIN_SALES}"""))
def q_area_ranking(spark, sf_dir):
    return yields.area_ranking(area_scores(spark, sf_dir))


@register("area_yield_summary", _with_scores(f"""
SELECT count(*) FILTER (n_alq_barrio >= {K.MIN_RENTALS_PER_AREA}) AS n_confiables,
  median(bruta) FILTER (n_alq_barrio >= {K.MIN_RENTALS_PER_AREA}) AS rent_bruta_mediana,
  quantile_cont(bruta, 0.25) FILTER (n_alq_barrio >= {K.MIN_RENTALS_PER_AREA}) AS rent_bruta_p25,
  quantile_cont(bruta, 0.75) FILTER (n_alq_barrio >= {K.MIN_RENTALS_PER_AREA}) AS rent_bruta_p75,
  median(neta) FILTER (n_alq_barrio >= {K.MIN_RENTALS_PER_AREA}) AS rent_neta_mediana,
  median(meses) FILTER (n_alq_barrio >= {K.MIN_RENTALS_PER_AREA}) AS meses_repago_mediana,
  {O.sround('avg(error_estimacion) * 100', 4)} AS error_ponderado_pct FROM scored"""))
def q_area_yield_summary(spark, sf_dir):
    s = materialize(area_scores(spark, sf_dir).select("rent_bruta_pct", "rent_neta_pct", "meses_repago",
                                                      "estimacion_confiable", "error_estimacion"), "area-scored")
    err = s.agg(F.avg("error_estimacion")).scalar()
    return yield_summary(s.filter(F.col("estimacion_confiable") == 1)).withColumn(
        "error_ponderado_pct", F.round(err * 100, 4))


@register("area_yield_by_band", _with_scores("""
SELECT segmento, count(*) AS n, median(neta) AS rent_neta_mediana FROM scored WHERE segmento IS NOT NULL
GROUP BY segmento"""))
def q_area_yield_by_band(spark, sf_dir):
    return net_yield_by_band(area_scores(spark, sf_dir))


@register("score_report", _with_scores(f"""
SELECT count(*) AS n, {O.sround(f'avg((n_alq_barrio >= {K.MIN_RENTALS_PER_AREA})::INT) * 100', 4)} AS pct_confiables,
  median(est_r) AS mediana, quantile_cont(est_r, 0.05) AS p5, quantile_cont(est_r, 0.95) AS p95 FROM scored"""))
def q_score_report(spark, sf_dir):
    """Estimated rents: number, share with enough rentals in the area, median and tails."""
    s = materialize(area_scores(spark, sf_dir).select("alquiler_est_usd_mes", "estimacion_confiable"), "area-report")
    q = quantiles.exact_quantiles(s, "alquiler_est_usd_mes", [0.05, 0.5, 0.95], names=["p5", "mediana", "p95"])
    share = profile.share(s, F.col("estimacion_confiable") == 1).select("pct").scalar()
    return q.select("n", share.alias("pct_confiables"), "mediana", "p5", "p95")


# --------------------------------------------------------------------------- S13: score from stored tables

@register("bundle_roundtrip")
def q_bundle_roundtrip(spark, sf_dir):
    """The ridge model written as tables, read back, and every sale scored by both."""
    b = ridge_bundle(spark, sf_dir)
    path = _scratch(spark, "bundle")
    tables = model.bundle_tables(spark, b["layout"], b["fits"], b["smear"], b["band"], b["coverage"], b["med_m2"])
    files.save_bundle(spark, path, tables)
    stored = model.bundle_from_tables(files.load_bundle(spark, path, list(tables)))
    props = what_if_input(b["kept"])
    here = scenario.what_if(props, b, market_median=K.MARKET_MEDIAN_GROSS_YIELD)
    there = scenario.what_if(props, stored, market_median=K.MARKET_MEDIAN_GROSS_YIELD)
    return here.select("row_id", F.col("alquiler").alias("en_memoria"), "veredicto").join(
        there.select("row_id", F.col("alquiler").alias("leido"), F.col("veredicto").alias("veredicto_leido")), "row_id")


@register("bundle_equal", O.with_clean(f"""
SELECT row_id, true AS iguales FROM {O.KEPT} k WHERE operacion = 'venta' AND venta_usd IS NOT NULL
  AND sup_total_m2 IS NOT NULL AND barrio IS NOT NULL"""))
def q_bundle_equal(spark, sf_dir):
    """For every sale, whether the stored model scores it exactly like the one in memory."""
    d = q_bundle_roundtrip(spark, sf_dir)
    same = F.col("en_memoria").eqNullSafe(F.col("leido")) & F.col("veredicto").eqNullSafe(F.col("veredicto_leido"))
    return d.select("row_id", same.alias("iguales"))


def area_bundle(spark, sf_dir) -> dict:
    """The area-only model as a bundle: what ``scenario.what_if`` takes."""
    kept = kept_for_model(spark, sf_dir)
    oof = materialize(area_model(kept)[1].select(*OOF_COLS), "area-oof")
    rentals = model.rentals_for_model(kept)
    a, b = rentals.agg(F.regr_intercept("y", "log_sup"), F.regr_slope("y", "log_sup")).first()
    layout = model.Layout({"barrio": model.category_layout(rentals).categories["barrio"], "tipo_familia": []})
    beta = [0.0] * layout.p
    beta[layout.index()["1"]], beta[layout.index()["x:log_sup"]] = float(a or 0.0), float(b or 0.0)
    smear = oof.agg(F.avg(F.exp(F.col("y") - F.col("pred_log")))).first()[0]
    return dict(layout=layout, fits={model.FULL: model.StoredFit(beta, 0.0)}, smear=float(smear or 1.0),
                band=materialize(model.band_errors(oof), "area-band"), coverage=lookups.rental_coverage(kept),
                med_m2=lookups.area_median(rentals, "alquiler_m2_usd_mes"))


_MARKET = K.MARKET_MEDIAN_GROSS_YIELD


@register("what_if_area", _with_scores(f"""
, q AS (SELECT row_id, barrio, sup_total_m2 AS m2, venta_usd AS venta, segmento, n_alq_barrio, error_estimacion AS e,
    exp(a + b * ln(sup_total_m2)) * s AS alq FROM scored, full_fit, sm),
md AS (SELECT barrio, median(alquiler_m2_usd_mes) AS m FROM r GROUP BY barrio),
z AS (SELECT q.*, md.barrio IS NOT NULL AS known, md.m, CASE WHEN venta > 0 THEN alq * 12 / venta * 100 END AS rb
  FROM q LEFT JOIN md ON q.barrio = md.barrio)
SELECT row_id, segmento, n_alq_barrio, (n_alq_barrio >= {K.MIN_RENTALS_PER_AREA})::INT AS confiable,
  CASE WHEN known THEN {O.sround('alq', 4)} END AS alquiler, CASE WHEN known THEN {O.sround('alq * (1 - e)', 4)} END AS minimo,
  CASE WHEN known THEN {O.sround('alq * (1 + e)', 4)} END AS maximo,
  CASE WHEN m <> 0 THEN {O.sround('m * m2', 4)} END AS referencia_barrio,
  CASE WHEN known AND m <> 0 THEN {O.sround('(alq / (m * m2) - 1) * 100', 4)} END AS dif_referencia_pct,
  CASE WHEN known THEN {O.sround('rb', 4)} END AS rent_bruta_pct,
  CASE WHEN known THEN {O.sround(f'rb * {1 - K.VACANCY_PCT / 100!r} * {1 - K.OWNER_COSTS_PCT / 100!r}', 4)} END AS rent_neta_pct,
  CASE WHEN known THEN {O.sround('venta / alq', 4)} END AS meses_repago,
  CASE WHEN NOT known THEN NULL WHEN rb > {_MARKET * (1 + K.WHATIF_VERDICT_BAND)!r} THEN 'por_encima'
    WHEN rb < {_MARKET * (1 - K.WHATIF_VERDICT_BAND)!r} THEN 'por_debajo' ELSE 'en_linea' END AS veredicto,
  CASE WHEN NOT known THEN 'barrio_desconocido' END AS motivo_rechazo
FROM z"""))
def q_what_if_area(spark, sf_dir):
    """M10 by value: every sale as a what-if input of the area-only model."""
    out = scenario.what_if(what_if_input(kept_for_model(spark, sf_dir)), area_bundle(spark, sf_dir), market_median=_MARKET)
    r4 = lambda c, name=None: F.round(c, 4).alias(name or c)
    return out.select("row_id", "segmento", "n_alq_barrio", "confiable", r4("alquiler"), r4("min", "minimo"),
                      r4("max", "maximo"), r4("referencia_barrio"), r4("dif_referencia_pct"), r4("rent_bruta_pct"),
                      r4("rent_neta_pct"), r4("meses_repago"), "veredicto", "motivo_rechazo")


# --------------------------------------------------------------------------- S6: listing cards

@register("html_cards", f"""
SELECT {RID_SQL}, CAST(floor(l_extendedprice) AS DOUBLE) AS valor,
  CASE WHEN l_orderkey % 2 = 0 THEN 'USD' ELSE 'ARS' END AS moneda,
  CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE CAST(l_partkey % 900 + 100 AS DOUBLE) END AS expensas,
  'Calle ' || l_partkey AS calle, CAST(l_suppkey % 90 + 1 AS VARCHAR) AS altura,
  CAST(l_partkey % 18 + 1 AS INTEGER) AS ambientes, CAST(l_quantity * 10 AS DOUBLE) AS superficie FROM lineitem""")
def q_html_cards(spark, sf_dir):
    """One page per order with a card per line; the price stands in an attribute or in the text."""
    li = spread(read_table(spark, sf_dir, "lineitem"))
    price = "concat(CASE WHEN pmod(l_orderkey, 2) = 0 THEN 'U$S ' ELSE '$ ' END, " \
            "translate(format_number(floor(l_extendedprice), 0), ',', '.'))"
    card = f"""concat('<article id="', rid, '"><h2>Calle ', l_partkey, ' ', pmod(l_suppkey, 90) + 1, '</h2>',
      CASE WHEN pmod(l_linenumber, 2) = 0 THEN concat('<div data-price="', {price}, '">ver</div>')
           ELSE concat('<span class="card price">', {price}, '</span>') END,
      CASE WHEN pmod(l_orderkey, 3) = 0 THEN '' ELSE
        concat('<p class="expenses">+ $ ', pmod(l_partkey, 900) + 100, ' expensas</p>') END,
      '<ul class="features"><li>', pmod(l_partkey, 18) + 1, ' amb.</li><li>', cast(l_quantity * 10 as int),
      ' m&sup2;</li></ul></article>')""".replace("m&sup2;", "m²")
    page = (li.selectExpr("l_orderkey", RID, "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity")
            .selectExpr("l_orderkey", f"{card} AS card").groupBy("l_orderkey")
            .agg(F.array_join(F.collect_list("card"), "\n").alias("html")))  # an order's lines
    return card_rows(page)


def card_rows(page):
    """Each card of the pages with its id and parsed fields."""
    one = page.select(F.explode(H.cards("html")).alias("card"))
    d = one.select(H.attribute(F.col("card")[0], "id").alias("rid"), *[c.alias(n) for n, c in H.card_fields("card").items()])
    for name in H.CARD_FIELDS:
        d = X.with_text_keys(d, name, f"_{name}_")
    c, n, cn = ({x: F.col(f"_{x}_{kind}") for x in H.CARD_FIELDS} for kind in ("c", "n", "cn"))
    d = d.withColumn("_a", X.parse_address("direccion", clean=c["direccion"]))
    p, a = X.parse_price("precio", clean=c["precio"], clean_norm=cn["precio"]), F.col("_a")
    return d.select("rid", p["valor"].alias("valor"), p["moneda"].alias("moneda"),
                    X.parse_expensas("expensas", clean=c["expensas"], clean_norm=cn["expensas"]).alias("expensas"),
                    a["calle"].alias("calle"), a["altura"].alias("altura"),
                    X.parse_ambientes("detalles", norm=n["detalles"]).alias("ambientes"),
                    X.parse_superficie("detalles", clean=c["detalles"]).alias("superficie"))


@register("html_nested_cards", f"""
SELECT {RID_SQL}, CAST(floor(l_extendedprice) AS DOUBLE) AS valor,
  CASE WHEN l_orderkey % 2 = 0 THEN 'USD' ELSE 'ARS' END AS moneda,
  CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE CAST(l_partkey % 900 + 100 AS DOUBLE) END AS expensas,
  'Calle Ñ' || l_partkey AS calle, CAST(l_suppkey % 90 + 1 AS VARCHAR) AS altura,
  CAST(l_partkey % 18 + 1 AS INTEGER) AS ambientes, CAST(l_quantity * 10 AS DOUBLE) AS superficie FROM lineitem""")
def q_html_nested_cards(spark, sf_dir):
    """Cards whose fields hold elements of their own name and others, with attributes in either order and quoted either
    way, entities by number, a comment, an unclosed tag and a card within a card."""
    li = spread(read_table(spark, sf_dir, "lineitem"))
    price = "concat(CASE WHEN pmod(l_orderkey, 2) = 0 THEN 'U$S ' ELSE '$ ' END, " \
            "translate(format_number(floor(l_extendedprice), 0), ',', '.'))"
    card = f"""concat('<article class="c" id=', CASE WHEN pmod(l_suppkey, 2) = 0 THEN concat('"', rid, '"')
        ELSE concat('\\'', rid, '\\'') END, '><!-- <span class="price">$ 1</span> --><br>',
      CASE WHEN pmod(l_linenumber, 2) = 0 THEN concat('<div title="a > b" data-price="', {price}, '"/>')
           ELSE concat('<span id="x" class="card price"><span>', {price}, '</span><b></b></span>') END,
      '<div class=address><div>Calle&#160;&#xD1;', l_partkey, '</div> <div><i>', pmod(l_suppkey, 90) + 1, '</i></div></div>',
      CASE WHEN pmod(l_orderkey, 3) = 0 THEN '' ELSE
        concat('<p data-x="1" class="expenses"><b>+ $ ', pmod(l_partkey, 900) + 100, '</b> expensas</p>') END,
      '<ul class="features"><li><ul><li>', pmod(l_partkey, 18) + 1, ' amb.</li></ul><li>', cast(l_quantity * 10 as int),
      ' m&#178;</ul><article class="ad"><h2>other</h2></article></article>')"""
    page = (li.selectExpr("l_orderkey", RID, "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity")
            .selectExpr("l_orderkey", f"{card} AS card").groupBy("l_orderkey")
            .agg(F.array_join(F.collect_list("card"), "\n").alias("html")))  # an order's lines
    return card_rows(page)
