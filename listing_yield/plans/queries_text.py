"""Registered queries: text extraction, flags, area matching, HTML and JSON fields, detail join.

The parse queries are inverse tests: Spark renders numbers of every lineitem
row as listing-style text, parses the text back with the H-expressions, and
the oracle returns the original numbers.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import html as H
from ..functions import text as T
from ..operators import areas, lookups
from ..session import read_table, spread
from . import oracles as O
from .queries import register

RID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, date_format(l_shipdate, 'yyyyMMdd')) AS rid"
RID_SQL = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS rid"


def _ar(expr: str, d: int) -> str:
    """Argentine rendering: 1.234.567,89."""
    return f"translate(format_number({expr}, {d}), ',.', '.,')"


def _lineitem(spark, sf_dir):
    return spread(read_table(spark, sf_dir, "lineitem"))


# --------------------------------------------------------------------------- H5

@register("parse_numbers", f"""
SELECT {RID_SQL}, l_extendedprice AS v_ar, l_quantity AS v_int, l_extendedprice AS v_us, l_discount + 0.0 AS v_dec
FROM lineitem""")
def q_parse_numbers(spark, sf_dir):
    li = _lineitem(spark, sf_dir).selectExpr(
        RID, f"{_ar('l_extendedprice', 2)} AS t_ar", f"{_ar('l_quantity', 0)} AS t_int",
        "format_number(l_extendedprice, 2) AS t_us", f"{_ar('l_discount', 2)} AS t_dec")
    return li.select("rid", *[T.parse_number_ar(c).alias("v" + c[1:]) for c in ("t_ar", "t_int", "t_us", "t_dec")])


# --------------------------------------------------------------------------- H6, H7

@register("parse_prices", f"""
SELECT {RID_SQL},
  CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE l_extendedprice END AS valor,
  CASE WHEN l_orderkey % 19 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 'ARS' ELSE 'USD' END AS moneda,
  CASE WHEN l_orderkey % 19 <> 0 AND l_returnflag = 'A' THEN {O.sround('abs(l_tax * 1000000.0)', 2)} END AS expensas
FROM lineitem""")
def q_parse_prices(spark, sf_dir):
    txt = (f"CASE WHEN pmod(l_orderkey, 19) = 0 THEN 'Consultar precio' "
           f"WHEN l_returnflag = 'R' THEN concat('$ ', {_ar('l_extendedprice', 2)}) "
           f"WHEN l_returnflag = 'A' THEN concat('USD ', {_ar('l_extendedprice', 2)}, ' + $ ', "
           f"{_ar('l_tax * 1000000.0D', 2)}, ' expensas') "
           f"ELSE concat('U$S ', {_ar('l_extendedprice', 2)}) END AS txt")
    li = T.with_text_keys(_lineitem(spark, sf_dir).selectExpr(RID, txt), "txt")
    c, cn = F.col("_c"), F.col("_cn")
    p = T.parse_price("txt", clean=c, clean_norm=cn)
    return li.select("rid", p["valor"].alias("valor"), p["moneda"].alias("moneda"),
                     T.parse_expensas("txt", clean=c, clean_norm=cn).alias("expensas"))


# --------------------------------------------------------------------------- H8-H13

COUNT_TXT = (
    "concat(pmod(l_partkey, 18) + 1, ' ambientes, ', pmod(l_partkey, 14), ' dormitorios, ', "
    "pmod(l_suppkey, 3) + 1, ' baños, ', "
    "CASE WHEN pmod(l_orderkey, 3) = 0 THEN 'sin cochera' ELSE concat(pmod(l_orderkey, 3), ' cocheras') END, ', ', "
    "CASE WHEN pmod(l_orderkey, 7) = 0 THEN 'a estrenar' ELSE concat(pmod(l_partkey * 7 + l_suppkey, 171), ' años') END, "
    "', ', format_number(l_quantity * 4, 0), ' m²') AS txt")


@register("parse_counts", f"""
SELECT {RID_SQL},
  CAST(l_partkey % 18 + 1 AS INTEGER) AS ambientes, CAST(l_partkey % 14 AS INTEGER) AS dormitorios,
  CAST(l_suppkey % 3 + 1 AS INTEGER) AS banos, CAST(l_orderkey % 3 AS INTEGER) AS cocheras,
  CAST(CASE WHEN l_orderkey % 7 = 0 THEN 0 ELSE (l_partkey * 7 + l_suppkey) % 171 END AS INTEGER) AS antiguedad,
  CASE WHEN l_orderkey % 7 = 0 OR (l_partkey * 7 + l_suppkey) % 171 = 0 THEN 1 ELSE 0 END AS a_estrenar,
  CASE WHEN l_quantity * 4 >= {K.AREA_PARSE_MIN} THEN l_quantity * 4 END AS superficie
FROM lineitem""")
def q_parse_counts(spark, sf_dir):
    li = T.with_text_keys(_lineitem(spark, sf_dir).selectExpr(RID, COUNT_TXT), "txt")
    n = F.col("_n")
    li, age = li.withColumn("_age", T.parse_antiguedad("txt", 2026, norm=n)), F.col("_age")
    return li.select("rid", T.parse_ambientes("txt", norm=n).alias("ambientes"),
                     T.parse_dormitorios("txt", norm=n).alias("dormitorios"),
                     T.parse_banos("txt", norm=n).alias("banos"), T.parse_cocheras("txt", norm=n).alias("cocheras"),
                     age["anios"].alias("antiguedad"), age["a_estrenar"].alias("a_estrenar"),
                     T.parse_superficie("txt", clean=F.col("_c")).alias("superficie"))


# --------------------------------------------------------------------------- H15, H16

ADDRESS_TXT = (
    "concat('Calle ', l_partkey, CASE WHEN l_linenumber = 3 THEN ' al ' ELSE ' ' END, "
    "pmod(l_partkey, 40) * 100 + 100, "
    "CASE WHEN l_linenumber = 1 THEN ', PB' WHEN l_linenumber = 2 THEN '' "
    "ELSE concat(', Piso ', l_linenumber) END) AS txt")


@register("parse_address", f"""
SELECT {RID_SQL}, 'Calle ' || l_partkey AS calle, CAST((l_partkey % 40) * 100 + 100 AS VARCHAR) AS altura,
  CASE WHEN l_linenumber = 1 THEN '0' WHEN l_linenumber = 2 THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS piso
FROM lineitem""")
def q_parse_address(spark, sf_dir):
    li = _lineitem(spark, sf_dir).selectExpr(RID, ADDRESS_TXT).withColumn("_c", T.clean_text("txt"))
    li, a = li.withColumn("_a", T.parse_address("txt", clean=F.col("_c"))), F.col("_a")
    return li.select("rid", a["calle"].alias("calle"), a["altura"].alias("altura"), a["piso"].alias("piso"))


# --------------------------------------------------------------------------- H1-H3, H18 over documents

WS_SQL = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def norm_sql(x: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents(coalesce({x}, ''))), '{WS_SQL}', ' ', 'g'))"


@register("clean_text", f"""
SELECT doc_id, md5(trim(regexp_replace(replace(text, chr(8203), ''), '{WS_SQL}', ' ', 'g'))) AS h_clean,
       md5({norm_sql('text')}) AS h_norm
FROM documents""")
def q_clean_text(spark, sf_dir):
    d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.md5(T.clean_text("text")).alias("h_clean"), F.md5(T.norm_key("text")).alias("h_norm"))


def _flags_sql(source: str = "documents", key: str = "doc_id"):
    t = f"(' ' || {norm_sql('text')} || ' ')"
    cols = []
    for flag, kws in K.FLAG_KEYWORDS.items():
        cond = " OR ".join(f"contains({t}, {O.q(k)})" for k in kws)
        cols.append(f"CASE WHEN {cond} THEN 1 ELSE 0 END AS {flag}")
    return f"SELECT {key}, {', '.join(cols)} FROM {source}"


@register("keyword_flags", _flags_sql())
def q_keyword_flags(spark, sf_dir):
    d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("_n", T.norm_key("text"))
    return d.select("doc_id", *[c.alias(n) for n, c in T.keyword_flags("text", norm=F.col("_n")).items()])


# --------------------------------------------------------------------------- J4, J5

def _area_sql(source: str = "documents", key: str = "doc_id"):
    t = norm_sql("text")
    for noise in K.AREA_NOISE:
        t = f"replace({t}, {O.q(noise)}, ' ')"
    # aliases before names, longer before shorter, then in listed order
    listed = [(0, -len(a), i, a, n) for i, (a, n) in enumerate(K.AREA_ALIASES.items())]
    listed += [(1, -len(n), i, n, n) for i, n in enumerate(K.AREA_DISTRICT)]
    whens = " ".join(
        f"WHEN contains(t, {O.q(p)}) AND regexp_matches(t, {O.q('(^|[^\\pL\\pN_])' + re.escape(p) + '([^\\pL\\pN_]|$)')}) "
        f"THEN {O.q(target)}" for _, _, _, p, target in sorted(listed))
    dist = " ".join(f"WHEN {O.q(k)} THEN {v}" for k, v in K.AREA_DISTRICT.items())
    return f"""
SELECT {key}, barrio, CAST(CASE barrio {dist} END AS INTEGER) AS comuna FROM (
  SELECT {key}, CASE WHEN text IS NULL OR text = '' THEN NULL ELSE (CASE {whens} END) END AS barrio
  FROM (SELECT {key}, text, {t} AS t FROM {source}))"""


@register("area_match", _area_sql())
def q_area_match(spark, sf_dir):
    d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return areas.match_areas(d, "text").select("doc_id", "barrio", "comuna")


# --------------------------------------------------------------------------- H22, F20 over pages

def _html_sql():
    def clean(x):
        s = f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"
        for ent, rep in H.ENTITIES:
            s = f"replace({s}, {O.q(ent)}, {O.q(rep)})"
        return f"trim(regexp_replace({s}, '{WS_SQL}', ' ', 'g'))"

    def first(patterns):
        parts = [f"nullif({clean(f'regexp_extract(html, {O.q(p)}, 1)')}, '')" for p in patterns]
        return f"coalesce({', '.join(parts)}, '')"
    return f"""
SELECT page_id, {first(H.TITLE_PATTERNS)} AS titulo, {first(H.BODY_PATTERNS)} AS cuerpo,
       coalesce(nullif(regexp_extract(html, {O.q(H.LANG_PATTERN)}, 1), ''), '') AS idioma,
       CAST((length(html) - length(replace(lower(html), '<a ', ''))) / 3 AS BIGINT) AS n_enlaces
FROM pages"""


@register("html_fields", _html_sql())
def q_html_fields(spark, sf_dir):
    p = spread(read_table(spark, sf_dir, "pages").select("page_id", "html"))
    return p.select("page_id", H.first_text("html", H.TITLE_PATTERNS).alias("titulo"),
                    H.first_text("html", H.BODY_PATTERNS).alias("cuerpo"),
                    F.coalesce(F.nullif(F.regexp_extract("html", H.LANG_PATTERN, 1), F.lit("")), F.lit("")).alias("idioma"),
                    H.count_tag("html", "a").alias("n_enlaces"))


@register("payload_gate", f"""
WITH p AS (SELECT page_id, repeat(chr(1), (page_id % 1500)::INT) || html AS h FROM pages),
b AS (SELECT page_id, regexp_extract_all(substr(hex(encode(h)), 1, {2 * K.BINARY_SAMPLE_BYTES}), '..') AS b FROM p)
SELECT page_id, len(b) > 0 AND len(list_filter(b, lambda x: NOT (x BETWEEN '09' AND '0D' OR x BETWEEN '20' AND '7E')))
  / len(b) > {K.BINARY_SHARE} AS parece_binario FROM b""")
def q_payload_gate(spark, sf_dir):
    """Pages behind 0 to 1,499 control characters: those with too many of them can't be read."""
    p = spread(read_table(spark, sf_dir, "pages").select("page_id", "html"))
    h = F.expr("concat(repeat(char(1), cast(page_id % 1500 as int)), html)")
    return p.select("page_id", H.looks_binary(F.encode(h, "UTF-8")).alias("parece_binario"))


# --------------------------------------------------------------------------- H23 over events

@register("json_fields", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       CASE WHEN json_extract(props, '$.k') IS NULL THEN 0 ELSE 1 END AS tiene_k
FROM events""")
def q_json_fields(spark, sf_dir):
    e = spread(read_table(spark, sf_dir, "events").select("event_id", "event_type", "props"))
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", "event_type", (k).try_cast("int").alias("k"),
                    F.when(k.isNull(), 0).otherwise(1).alias("tiene_k"))


# --------------------------------------------------------------------------- J6, H24 over orders x customer

@register("detail_join", """
WITH l AS (
  SELECT o_orderkey, o_custkey AS slug, CAST(o_orderkey % 5 AS INTEGER) AS dormitorios,
         CAST(o_orderkey % 3 AS INTEGER) AS cocheras, o_orderpriority AS descripcion,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS barrio
  FROM orders),
d AS (
  SELECT c_custkey AS slug, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_nationkey % 4 AS INTEGER) END AS dormitorios,
         CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS descripcion, c_mktsegment AS barrio
  FROM customer)
SELECT l.o_orderkey,
  CASE WHEN d.slug IS NOT NULL THEN d.dormitorios ELSE l.dormitorios END AS dormitorios,
  l.cocheras,
  CASE WHEN d.slug IS NOT NULL AND d.descripcion IS NOT NULL AND d.descripcion <> '' THEN d.descripcion
       ELSE l.descripcion END AS descripcion,
  CASE WHEN d.slug IS NOT NULL AND (l.barrio IS NULL OR l.barrio = '') THEN d.barrio ELSE l.barrio END AS barrio
FROM l LEFT JOIN d ON l.slug = d.slug""")
def q_detail_join(spark, sf_dir):
    o = spread(read_table(spark, sf_dir, "orders")).selectExpr(
        "o_orderkey", "o_custkey AS slug", "CAST(pmod(o_orderkey, 5) AS INT) AS dormitorios",
        "CAST(pmod(o_orderkey, 3) AS INT) AS cocheras", "o_orderpriority AS descripcion",
        "CASE WHEN pmod(o_orderkey, 3) = 0 THEN NULL ELSE o_orderstatus END AS barrio")
    c = read_table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS slug", "CASE WHEN pmod(c_custkey, 7) = 0 THEN NULL ELSE CAST(pmod(c_nationkey, 4) AS INT) END AS dormitorios",
        "CASE WHEN pmod(c_custkey, 5) = 0 THEN '' ELSE c_name END AS descripcion", "c_mktsegment AS barrio")
    out = lookups.detail_join(o, c, "slug")
    return out.select("o_orderkey", "dormitorios", "cocheras", "descripcion", "barrio")
