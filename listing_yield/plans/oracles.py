"""DuckDB SQL oracles for the registered queries.

Each oracle restates the query's semantics in plain SQL over the raw test
tables (views ``lineitem``, ``part``, ``supplier``, ``nation``, ``orders``,
``customer``, ``events``, ``documents``, ``pages``...).  The listing adapter
and the cleaning steps are written once here as CTE text and reused.

``sround(x, d)`` rounds like Spark's ``round`` on doubles (half-up on the
shortest decimal form); DuckDB's own double ``round`` differs on exact halves.
"""

from __future__ import annotations

from .. import constants as K
from ..sources import adapter as A


def sround(expr: str, d: int) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,16)), {d}) AS DOUBLE)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def _kind_case() -> str:
    whens = " ".join(f"WHEN p_type = {q(k)} THEN {q(v)}" for k, v in A.PART_TYPE_TO_KIND.items())
    return f"CASE {whens} ELSE {q(A.OTHER_KIND)} END"


def _flags_sql() -> str:
    return ",\n    ".join(f"CAST((l_partkey >> {i}) & 1 AS INTEGER) AS {f}" for i, f in enumerate(K.MODEL_FLAGS))


def listings_cte() -> str:
    """CTEs ``li`` and ``listings``: the adapter view (mirror of sources.adapter.listings)."""
    base = (f"(CASE WHEN op = 'venta' THEN l_extendedprice ELSE l_extendedprice / {A.RENT_DIVISOR} END)")
    return f"""
li AS (
  SELECT l.*, p.p_name, p.p_type, p.p_size, n.n_name, n.n_regionkey,
    CASE WHEN l_orderkey % 37 = 0 THEN NULL WHEN l_linestatus = 'O' THEN 'venta' ELSE 'alquiler' END AS op,
    CAST((l_partkey * 7 + l_suppkey) % 171 - 10 AS INTEGER) AS age
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
),
listings AS (
  SELECT
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS row_id,
    'p' || lower(l_returnflag) AS portal,
    concat_ws('-', l_orderkey, l_linenumber) AS id_aviso,
    CASE WHEN l_orderkey % 31 = 0 THEN NULL
         ELSE concat_ws('/', '/listings', l_orderkey, l_linenumber, l_partkey) END AS url,
    l_shipdate AS fecha_scraping,
    op AS operacion,
    CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE {_kind_case()} END AS tipo_propiedad,
    CASE WHEN l_orderkey % 23 = 0 THEN NULL
         WHEN l_orderkey % 47 = 0 THEN 0.0
         WHEN l_returnflag = 'R' THEN {base} * {A.ARS_FACTOR}
         ELSE {base} END AS precio_valor,
    CASE WHEN l_orderkey % 41 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 'ARS' ELSE 'USD' END AS precio_moneda,
    CASE WHEN l_tax = 0 THEN NULL ELSE l_tax * 1000000.0 END AS expensas_valor,
    CASE WHEN l_tax = 0 THEN NULL ELSE 'ARS' END AS expensas_moneda,
    CASE WHEN l_orderkey % 13 = 0 THEN NULL
         ELSE concat_ws(' ', 'Calle', l_partkey, (l_partkey % 40) * 100 + 100) END AS direccion,
    CASE WHEN l_orderkey % 43 = 0 THEN NULL ELSE lower(n_name) END AS barrio,
    CAST(n_regionkey AS INTEGER) AS comuna,
    CASE WHEN l_orderkey % 17 = 0 THEN NULL
         WHEN l_orderkey % 53 = 0 THEN l_quantity * 100
         ELSE l_quantity * 4 END AS sup_total_m2,
    l_quantity * 4 * (0.6 + l_discount * 5) AS sup_cubierta_m2,
    CAST(p_size % 18 + 1 AS INTEGER) AS ambientes,
    CAST(p_size % 14 AS INTEGER) AS dormitorios,
    CAST(p_size % 3 + 1 AS INTEGER) AS banos,
    CAST(p_size % 2 AS INTEGER) AS cocheras,
    age AS antiguedad_anios,
    CASE WHEN age <= 0 THEN 1 ELSE 0 END AS es_a_estrenar,
    concat_ws(' - ', p_name, lower(n_name)) AS titulo,
    {_flags_sql()}
  FROM li
)"""


def _order() -> str:
    return "fecha_scraping DESC NULLS LAST, row_id DESC"


def clean_cte(fx: float = K.DEFAULT_FX, mode: str = "moderado", to_rent=K.FIX_TO_RENT_IDS,
              to_ars=K.FIX_TO_ARS_IDS, bad_area=K.FIX_BAD_AREA_IDS, until: int = 7) -> str:
    """CTEs up to ``tagged`` (steps 1..until) on top of ``listings``."""
    touched = list(dict.fromkeys(list(to_rent) + list(to_ars) + list(bad_area)))
    fxs = f"{float(fx)!r}"
    v = "CASE WHEN operacion = 'venta' THEN venta_m2_usd WHEN operacion = 'alquiler' THEN alquiler_m2_usd_mes END"
    p_lo, p_hi = K.TRIM_MODES[mode]
    steps = [f"""
t0 AS (
  SELECT *, CASE WHEN precio_valor IS NOT NULL AND precio_valor <> 0 AND sup_total_m2 IS NOT NULL
                  AND sup_total_m2 > 0 THEN {sround('precio_valor / sup_total_m2', 2)} END AS precio_m2
  FROM listings
),
t1 AS (
  SELECT * REPLACE (
    CASE WHEN coalesce(id_aviso IN {in_list(to_rent or ['~'])}, false) THEN 'alquiler' ELSE operacion END AS operacion,
    CASE WHEN coalesce(id_aviso IN {in_list(to_ars or ['~'])}, false) THEN 'ARS' ELSE precio_moneda END AS precio_moneda,
    CASE WHEN coalesce(id_aviso IN {in_list(bad_area or ['~'])}, false) THEN NULL ELSE sup_total_m2 END AS sup_total_m2,
    CASE WHEN coalesce(id_aviso IN {in_list(bad_area or ['~'])}, false) THEN NULL ELSE sup_cubierta_m2 END AS sup_cubierta_m2,
    CASE WHEN coalesce(id_aviso IN {in_list(touched or ['~'])}, false) THEN NULL ELSE precio_m2 END AS precio_m2)
  FROM t0
),
t2 AS (
  SELECT *, CASE WHEN coalesce(tipo_propiedad IN {in_list(K.RESIDENTIAL_TYPES)}, false) THEN CAST(NULL AS VARCHAR)
                 ELSE 'no_residencial' END AS motivo_exclusion
  FROM t1
),
a2 AS (SELECT * FROM t2 WHERE motivo_exclusion IS NULL),
s1 AS (SELECT * FROM a2 QUALIFY row_number() OVER (PARTITION BY url ORDER BY {_order()}) = 1),
s2 AS (SELECT * FROM s1 QUALIFY row_number() OVER (PARTITION BY id_aviso ORDER BY {_order()}) = 1),
s3 AS (
  SELECT row_id FROM s2 WHERE direccion IS NULL
  UNION ALL
  SELECT row_id FROM s2 WHERE direccion IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY direccion, sup_total_m2, precio_valor, operacion ORDER BY {_order()}) = 1
),
t3 AS (
  SELECT t2.* REPLACE (
    CASE WHEN t2.motivo_exclusion IS NOT NULL THEN t2.motivo_exclusion
         WHEN x3.row_id IS NOT NULL THEN NULL
         WHEN x2.row_id IS NOT NULL THEN 'duplicado_mismo_inmueble'
         WHEN x1.row_id IS NOT NULL THEN 'duplicado_id'
         ELSE 'duplicado_url' END AS motivo_exclusion)
  FROM t2
  LEFT JOIN (SELECT row_id FROM s1) x1 ON t2.row_id = x1.row_id
  LEFT JOIN (SELECT row_id FROM s2) x2 ON t2.row_id = x2.row_id
  LEFT JOIN s3 x3 ON t2.row_id = x3.row_id
)"""]
    if until >= 4:
        steps.append(f"""
t4 AS (
  SELECT * REPLACE (
    CASE WHEN motivo_exclusion IS NOT NULL THEN motivo_exclusion
         WHEN precio_valor IS NULL OR precio_valor <= 0 THEN 'precio_ausente_o_cero'
         WHEN sup_total_m2 IS NULL OR sup_total_m2 < {K.AREA_MIN} THEN 'superficie_menor_a_{K.AREA_MIN}m2'
         WHEN sup_total_m2 > {K.AREA_MAX} THEN 'superficie_mayor_a_{K.AREA_MAX}m2' END AS motivo_exclusion)
  FROM t3
),
t4b AS (
  SELECT * REPLACE (
    CASE WHEN motivo_exclusion IS NULL AND antiguedad_anios IS NOT NULL
              AND (antiguedad_anios < {K.AGE_MIN} OR antiguedad_anios > {K.AGE_MAX}) THEN NULL
         ELSE antiguedad_anios END AS antiguedad_anios,
    CASE WHEN motivo_exclusion IS NULL AND antiguedad_anios IS NOT NULL
              AND (antiguedad_anios < {K.AGE_MIN} OR antiguedad_anios > {K.AGE_MAX}) THEN NULL
         ELSE es_a_estrenar END AS es_a_estrenar,
    CASE WHEN motivo_exclusion IS NULL AND ambientes > {K.ROOMS_MAX} THEN NULL ELSE ambientes END AS ambientes,
    CASE WHEN motivo_exclusion IS NULL AND dormitorios > {K.BEDROOMS_MAX} THEN NULL ELSE dormitorios END AS dormitorios)
  FROM t4
)""")
    if until >= 5:
        steps.append(f"""
t5 AS (
  SELECT *,
    CASE WHEN motivo_exclusion IS NULL THEN
      (CASE WHEN precio_moneda = 'ARS' THEN precio_valor / {fxs} ELSE precio_valor END) END AS precio_usd,
    CASE WHEN motivo_exclusion IS NULL THEN
      (CASE WHEN expensas_moneda = 'ARS' THEN expensas_valor / {fxs} ELSE expensas_valor END) END AS expensas_usd
  FROM t4b
),
t5b AS (
  SELECT *,
    CASE WHEN motivo_exclusion IS NULL AND coalesce(operacion = 'venta', false) THEN precio_usd END AS venta_usd,
    CASE WHEN motivo_exclusion IS NULL AND NOT coalesce(operacion = 'venta', false) THEN precio_usd END AS alquiler_usd_mes
  FROM t5
),
t5c AS (
  SELECT * REPLACE (
    CASE WHEN motivo_exclusion IS NULL THEN {sround('precio_valor / nullif(sup_total_m2, 0)', 2)}
         ELSE precio_m2 END AS precio_m2),
    CASE WHEN motivo_exclusion IS NULL THEN {sround('venta_usd / nullif(sup_total_m2, 0)', 2)} END AS venta_m2_usd,
    CASE WHEN motivo_exclusion IS NULL THEN {sround('alquiler_usd_mes / nullif(sup_total_m2, 0)', 2)} END AS alquiler_m2_usd_mes
  FROM t5b
)""")
    if until >= 6:
        if mode == "conservador":
            steps.append("t6 AS (SELECT * FROM t5c)")
        else:
            steps.append(f"""
b6 AS (
  SELECT operacion AS op6, count(v) AS n6, quantile_cont(v, {p_lo}) AS lo6, quantile_cont(v, {p_hi}) AS hi6
  FROM (SELECT operacion, {v} AS v FROM t5c
        WHERE motivo_exclusion IS NULL AND operacion IN ('venta', 'alquiler'))
  WHERE v IS NOT NULL
  GROUP BY operacion
  HAVING count(v) >= {K.TRIM_MIN_GROUP}
),
t6 AS (
  SELECT t5c.* REPLACE (
    CASE WHEN t5c.motivo_exclusion IS NULL AND b6.op6 IS NOT NULL AND ({v}) IS NOT NULL
              AND (({v}) < b6.lo6 OR ({v}) > b6.hi6) THEN 'outlier_precio_m2_' || t5c.operacion
         ELSE t5c.motivo_exclusion END AS motivo_exclusion)
  FROM t5c LEFT JOIN b6 ON t5c.operacion = b6.op6
)""")
    if until >= 7:
        steps.append(f"""
tagged AS (
  SELECT *,
    CASE WHEN motivo_exclusion IS NULL THEN {bins_sql('antiguedad_anios', K.AGE_BINS, K.AGE_LABELS)} END AS antiguedad_rango,
    CASE WHEN motivo_exclusion IS NULL THEN {bins_sql('sup_total_m2', K.AREA_BINS, K.AREA_LABELS)} END AS superficie_rango,
    CASE WHEN motivo_exclusion IS NULL THEN {ratio_sql('sup_cubierta_m2', 'sup_total_m2', K.COVERED_RATIO_MAX, True)} END AS ratio_cubierta,
    CASE WHEN motivo_exclusion IS NULL THEN {ratio_sql('expensas_usd', 'alquiler_usd_mes', K.EXPENSES_RATIO_MAX, False)} END AS expensas_sobre_alquiler,
    CASE WHEN motivo_exclusion IS NULL THEN {family_sql('tipo_propiedad')} END AS tipo_familia
  FROM t6
)""")
    else:
        last = {3: "t3", 4: "t4b", 5: "t5c", 6: "t6"}[until]
        steps.append(f"tagged AS (SELECT * FROM {last})")
    return ",".join(steps)


def bins_sql(c: str, edges, labels) -> str:
    whens = " ".join(f"WHEN {c} > {lo} AND {c} <= {hi} THEN {q(lab)}"
                     for lo, hi, lab in zip(edges[:-1], edges[1:], labels))
    return f"CASE {whens} END"


def ratio_sql(num: str, den: str, cap: float, floor_zero: bool) -> str:
    r = sround(f"{num} / nullif({den}, 0)", 3)
    cond = f"{r} > {cap}" + (f" OR {r} <= 0" if floor_zero else "")
    return f"CASE WHEN {cond} THEN NULL ELSE {r} END"


def family_sql(c: str) -> str:
    return (f"CASE WHEN starts_with({c}, 'departamento') THEN 'departamento' "
            f"WHEN starts_with({c}, 'casa') THEN 'casa' WHEN {c} = 'ph' THEN 'ph' ELSE 'otro' END")


def with_clean(select: str, **kw) -> str:
    return f"WITH {listings_cte()},{clean_cte(**kw)}\n{select}"


def with_listings(select: str) -> str:
    return f"WITH {listings_cte()}\n{select}"


KEPT = "(SELECT * FROM tagged WHERE motivo_exclusion IS NULL)"
