"""Tag-and-remove rules: a removed row keeps a reason, nothing is deleted silently.

One DataFrame carries a ``motivo_exclusion`` column; NULL means the row is
still alive.  A rule only tags rows that are alive when it runs, so an earlier
rule always wins.  Masks are wrapped in ``coalesce(mask, false)`` so a NULL
comparison never drops a row from both the kept and the excluded side.
Row-local rules are plain ``when`` expressions and fuse into one codegen stage.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import constants as K

REASON = "motivo_exclusion"


def alive() -> Column:
    return F.col(REASON).isNull()


def start(df: DataFrame) -> DataFrame:
    """Add an empty reason column (every row alive)."""
    if REASON in df.columns:
        return df
    return df.withColumn(REASON, F.lit(None).cast("string"))


def tag(df: DataFrame, mask: Column, reason: str) -> DataFrame:
    """rows matching ``mask`` (NULL counts as no match) leave with ``reason``."""
    return df.withColumn(
        REASON, F.when(alive() & F.coalesce(mask, F.lit(False)), F.lit(reason)).otherwise(F.col(REASON)))


def tag_many(df: DataFrame, rules: Sequence[tuple[Column, str]]) -> DataFrame:
    """Several ordered row-local rules in one expression (first match wins)."""
    expr = F.col(REASON)
    chain = None
    for mask, reason in rules:
        cond = F.coalesce(mask, F.lit(False))
        chain = F.when(cond, F.lit(reason)) if chain is None else chain.when(cond, F.lit(reason))
    if chain is None:
        return df
    return df.withColumn(REASON, F.when(alive(), chain).otherwise(expr))


def null_out(df: DataFrame, cond: Column, columns: Iterable[str]) -> DataFrame:
    """keep the row, blank the values (only on alive rows)."""
    hit = alive() & F.coalesce(cond, F.lit(False))
    return df.withColumns({c: F.when(hit, F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c))
                           for c in columns})


def when_alive(expr: Column) -> Column:
    """Derived columns exist only for rows alive when they are computed."""
    return F.when(alive(), expr)


def not_in_set(c: str | Column, values: Sequence[str]) -> Column:
    """membership test where NULL counts as *not* a member."""
    col = F.col(c) if isinstance(c, str) else c
    return ~F.coalesce(col.isin(list(values)), F.lit(False))


# --- the concrete rules -----------------------------------------------------

def residential_rule(df: DataFrame, types: Sequence[str] = K.RESIDENTIAL_TYPES) -> DataFrame:
    return tag(df, not_in_set("tipo_propiedad", types), "no_residencial")


def impossible_values_rules(df: DataFrame) -> DataFrame:
    """F3-F5 as one ordered chain, then the F6 null-outs on the survivors."""
    return impossible_values_blanks(impossible_values_tags(df))


def impossible_values_tags(df: DataFrame) -> DataFrame:
    """F3-F5."""
    price, area = F.col("precio_valor"), F.col("sup_total_m2")
    return tag_many(df, [
        (price.isNull() | (price <= 0), "precio_ausente_o_cero"),
        (area.isNull() | (area < K.AREA_MIN), f"superficie_menor_a_{K.AREA_MIN}m2"),
        (area > K.AREA_MAX, f"superficie_mayor_a_{K.AREA_MAX}m2"),
    ])


def impossible_values_blanks(df: DataFrame) -> DataFrame:
    """F6 on the rows that F3-F5 left."""
    age = F.col("antiguedad_anios")
    df = null_out(df, age.isNotNull() & ((age < K.AGE_MIN) | (age > K.AGE_MAX)),
                  ["antiguedad_anios", "es_a_estrenar"])
    df = null_out(df, F.col("ambientes") > K.ROOMS_MAX, ["ambientes"])
    df = null_out(df, F.col("dormitorios") > K.BEDROOMS_MAX, ["dormitorios"])
    return df


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept rows (reason dropped) and excluded rows (with reason)."""
    return tagged.filter(alive()).drop(REASON), tagged.filter(~alive())


def drop_columns(df: DataFrame, columns: Sequence[str] = K.COLUMNS_TO_DROP) -> DataFrame:
    """drop the named columns that are present."""
    return df.drop(*[c for c in columns if c in df.columns])


def tally(tagged: DataFrame) -> DataFrame:
    """Excluded rows per reason and their share of the input (in %).

    One aggregation; the total comes from the same pass (conditional count
    summed over the tiny per-reason table), not from a second scan.
    """
    per = tagged.groupBy(REASON).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # at most len(REASONS)+1 rows
    return (per.withColumn("n_input", total)
            .filter(F.col(REASON).isNotNull())
            .select(REASON, "n", F.round(F.col("n") / F.col("n_input") * 100, 4).alias("pct_input")))


def range_filter(df: DataFrame, ranges: dict[str, tuple] | None = None, equals: dict[str, object] | None = None,
                 contains: dict[str, str] | None = None) -> DataFrame:
    """F16: rows within closed ranges, equal to values, and holding substrings (any letter case); NULL fails."""
    cond = F.lit(True)
    for c, (lo, hi) in (ranges or {}).items():
        cond = cond & F.col(c).between(lo, hi)
    for c, v in (equals or {}).items():
        cond = cond & (F.col(c) == F.lit(v))
    for c, v in (contains or {}).items():
        cond = cond & F.contains(F.lower(F.col(c)), F.lit(v.lower()))
    return df.filter(cond)
