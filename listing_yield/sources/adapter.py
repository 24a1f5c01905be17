"""Listing view over the star-schema test tables.

The test tables hold no listings, so this view maps lineitem (joined with part,
supplier and nation) to the unified listing columns, with a few NULLs injected
by key arithmetic so that every cleaning rule has work to do.  The exact same
mapping is written in SQL in ``listing_yield.plans.oracles.LISTINGS_SQL``.

Scale notes: lineitem is the fact side; part and supplier grow with the data,
so they are plain equi-joins and Spark's size-checked auto-broadcast/AQE picks
the strategy; nation is a fixed 25-row dimension and is broadcast explicitly.
Only the columns the view needs are read (the scan's ReadSchema is pruned).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..session import read_table, spread

# Mapping of the part type to a property type (one non-residential class).
PART_TYPE_TO_KIND = {
    "ECONOMY": "departamento_estandar",
    "STANDARD": "departamento_monoambiente",
    "MEDIUM": "ph",
    "LARGE": "casa",
    "SMALL": "departamento_loft",
}
OTHER_KIND = "oficina"
RENT_DIVISOR = 150.0
ARS_FACTOR = 1100.0


ID_SQL = "concat_ws('-', l_orderkey, l_linenumber)"


def _kind_sql() -> str:
    whens = " ".join(f"WHEN p_type = '{k}' THEN '{v}'" for k, v in PART_TYPE_TO_KIND.items())
    return f"CASE {whens} ELSE '{OTHER_KIND}' END"


def listing_exprs() -> list[str]:
    """The projection, as Spark SQL expressions (one call to build, one codegen stage to run)."""
    op = ("CASE WHEN pmod(l_orderkey, 37) = 0 THEN NULL WHEN l_linestatus = 'O' THEN 'venta' "
          "ELSE 'alquiler' END")
    base = f"(CASE WHEN {op} = 'venta' THEN l_extendedprice ELSE l_extendedprice / {RENT_DIVISOR} END)"
    age = "CAST(pmod(l_partkey * 7 + l_suppkey, 171) - 10 AS INT)"
    cols = {
        "row_id": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, date_format(l_shipdate, 'yyyyMMdd'))",
        "portal": "concat('p', lower(l_returnflag))",
        "id_aviso": ID_SQL,
        "url": "CASE WHEN pmod(l_orderkey, 31) = 0 THEN NULL "
               "ELSE concat_ws('/', '/listings', l_orderkey, l_linenumber, l_partkey) END",
        "fecha_scraping": "l_shipdate",
        "operacion": op,
        "tipo_propiedad": f"CASE WHEN pmod(l_orderkey, 29) = 0 THEN NULL ELSE {_kind_sql()} END",
        "precio_valor": f"CASE WHEN pmod(l_orderkey, 23) = 0 THEN NULL WHEN pmod(l_orderkey, 47) = 0 THEN 0.0D "
                        f"WHEN l_returnflag = 'R' THEN {base} * {ARS_FACTOR}D ELSE {base} END",
        "precio_moneda": "CASE WHEN pmod(l_orderkey, 41) = 0 THEN NULL WHEN l_returnflag = 'R' THEN 'ARS' ELSE 'USD' END",
        "expensas_valor": "CASE WHEN l_tax = 0 THEN NULL ELSE l_tax * 1000000.0D END",
        "expensas_moneda": "CASE WHEN l_tax = 0 THEN NULL ELSE 'ARS' END",
        "direccion": "CASE WHEN pmod(l_orderkey, 13) = 0 THEN NULL "
                     "ELSE concat_ws(' ', 'Calle', l_partkey, pmod(l_partkey, 40) * 100 + 100) END",
        "barrio": "CASE WHEN pmod(l_orderkey, 43) = 0 THEN NULL ELSE lower(n_name) END",
        "comuna": "CAST(n_regionkey AS INT)",
        "sup_total_m2": "CASE WHEN pmod(l_orderkey, 17) = 0 THEN NULL WHEN pmod(l_orderkey, 53) = 0 "
                        "THEN l_quantity * 100 ELSE l_quantity * 4 END",
        "sup_cubierta_m2": "l_quantity * 4 * (0.6D + l_discount * 5)",
        "ambientes": "CAST(pmod(p_size, 18) + 1 AS INT)",
        "dormitorios": "CAST(pmod(p_size, 14) AS INT)",
        "banos": "CAST(pmod(p_size, 3) + 1 AS INT)",
        "cocheras": "CAST(pmod(p_size, 2) AS INT)",
        "antiguedad_anios": age,
        "es_a_estrenar": f"CASE WHEN {age} <= 0 THEN 1 ELSE 0 END",
        "titulo": "concat_ws(' - ', p_name, lower(n_name))",
    }
    for i, f in enumerate(K.MODEL_FLAGS):
        cols[f] = f"CAST(shiftright(l_partkey, {i}) & 1 AS INT)"
    return [f"{e} AS {n}" for n, e in cols.items()]


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined table columns that the listing columns are made of: numbers and short strings, a third of the view."""
    li = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"))
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return (li.join(part, li.l_partkey == part.p_partkey)
            .join(supp, li.l_suppkey == supp.s_suppkey)
            .join(F.broadcast(nation), supp.s_nationkey == nation.n_nationkey)
            .drop("p_partkey", "s_suppkey", "s_nationkey", "n_nationkey"))


def view(rows: DataFrame) -> DataFrame:
    """The listing columns of ``base`` rows, all row-local; other columns (a row number, a reason) stay."""
    return rows.selectExpr(*listing_exprs(), *[f"`{c}`" for c in rows.columns if c[:2] not in ("l_", "p_", "n_")])


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(base(spark, sf_dir))
