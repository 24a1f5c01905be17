"""Grouped quantiles, the per-group quantile trim (F14) and the Tukey fence.

Exact quantiles (linear interpolation, as pandas' default and DuckDB's ``quantile_cont``) of any number of columns, in a
pair of aggregates that both combine map-side; rows are never multiplied:

1. a quantile sketch for each column brackets each wanted rank between two values;
2. for each bracket the rows below it and at its lower end are counted, and the values strictly inside are listed; the
   rank is then read off.

A bracket spans ``2 * MARGIN`` of a group's ranks (groups of up to ``SMALL`` rows are one bracket), and ties at its ends
are only counted. Where that could still be more than ``LIST`` values, passes over a grid of sketched values narrow the
brackets first, so no task ever holds a group's values, however many rows or ties it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .. import constants as K
from ..session import materialize
from . import rules

ACCURACY = 10_000  # the sketch's ranks are off by n / ACCURACY at most
SMALL = 10_000
MARGIN = 2 / ACCURACY + 1 / SMALL
LIST = 50_000  # values of a bracket that are listed
GRID = 64  # parts into which a narrowing pass splits a bracket; LIST has to be several times as many
BROADCAST_GROUPS = 20_000

Wanted = Sequence[tuple[Column, Sequence[float]]]  # columns, and the probabilities asked of each


def quantiles_of(df: DataFrame, wanted: Wanted, by: Sequence[str] = ()) -> DataFrame:
    """by, n0, q0_0, q0_1, ..., n1, q1_0, ...: for each column the number of its values and its exact quantiles. NULL
    values are left out, NULL keys form a group; a group without any value has no row, a column without any has n = 0
    and NULL quantiles."""
    keys = [f"_k{i}" for i in range(len(by))]
    vals = [f"_v{i}" for i in range(len(wanted))]
    base = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)],
                     *[v.cast("double").alias(n) for n, (v, _) in zip(vals, wanted)])
    base = base.filter(reduce(or_, [F.col(v).isNotNull() for v in vals]))
    brackets, most = _fetched(_sketched(base, keys, vals, wanted))
    while most > LIST:
        brackets, most = _fetched(_narrowed(_bracketed(base, brackets, keys), keys, brackets, wanted))
    aggs = []
    for i, (_, probs) in enumerate(wanted):
        v = F.col(vals[i])
        aggs.append(F.count(v).alias(f"n{i}"))
        for j in range(len(probs)):
            lo, hi = F.col(_b(i, j, "lo")), F.col(_b(i, j, "hi"))
            aggs += [F.count(F.when(v <= lo, 1)).alias(_b(i, j, "upto")),
                     F.collect_list(F.when((v > lo) & (v < hi), v)).alias(_b(i, j, "in"))]
    counted = _with_ends(_bracketed(base, brackets, keys), keys, brackets, wanted, aggs)
    counted = counted.select("*", *[F.array_sort(_b(i, j, "in")).alias(_b(i, j, "sorted"))
                                    for i, (_, ps) in enumerate(wanted) for j in range(len(ps))])
    out = []
    for i, (_, probs) in enumerate(wanted):
        out.append(F.col(f"n{i}"))
        for j, p in enumerate(probs):
            pos = (F.col(f"n{i}") - 1) * F.lit(float(p))
            a, z = (_at(i, j, F.floor(pos)), _at(i, j, F.ceil(pos)))
            q = F.when(a == z, a).otherwise((F.ceil(pos) - pos) * a + (pos - F.floor(pos)) * z)
            out.append(F.when(F.col(f"n{i}") > 0, q).alias(f"q{i}_{j}"))
    got = counted.select(*[F.col(k).alias(c) for k, c in zip(keys, by)], *out)
    return got if by else got.filter(reduce(or_, [F.col(f"n{i}") > 0 for i in range(len(wanted))]))


def _b(i: int, j: int, what: str) -> str:
    return f"_{what}_{i}_{j}"


def _at(i: int, j: int, rank: Column) -> Column:
    """The value of a rank (from 0): at the lower end, listed inside, or at the upper end."""
    inside = rank - F.col(_b(i, j, "upto"))
    listed = F.col(_b(i, j, "sorted"))
    return (F.when(inside < 0, F.col(_b(i, j, "lo")))
            .when(inside < F.size(listed), F.get(listed, inside.cast("int"))).otherwise(F.col(_b(i, j, "hi"))))


def _sketched(base: DataFrame, keys: list[str], vals: list[str], wanted: Wanted) -> DataFrame:
    """keys, and for each wanted quantile its bracket (lo, hi) and the most values that may lie inside."""
    aggs = []
    for v, (_, probs) in zip(vals, wanted):
        # the sketch keeps the least and greatest values, so shares 0 and 1 are exact
        ends = [*[min(1.0, max(0.0, p + m)) for p in probs for m in (-MARGIN, MARGIN)], 0.0, 1.0]
        aggs += [F.count(v).alias(f"{v}_n"), F.percentile_approx(v, F.array(*map(F.lit, ends)), ACCURACY).alias(f"{v}_q")]
    columns = []
    for i, (v, (_, probs)) in enumerate(zip(vals, wanted)):
        whole, n = F.col(f"{v}_n") <= SMALL, F.col(f"{v}_n")
        least, greatest = (F.col(f"{v}_q")[2 * len(probs) + k] for k in (0, 1))
        for j in range(len(probs)):
            columns += [F.when(whole, least).otherwise(F.col(f"{v}_q")[2 * j]).alias(_b(i, j, "lo")),
                        F.when(whole, greatest).otherwise(F.col(f"{v}_q")[2 * j + 1]).alias(_b(i, j, "hi")),
                        F.when(whole, n).otherwise(F.ceil(n * (2 * MARGIN + 2 / ACCURACY))).cast("long")
                        .alias(_b(i, j, "most"))]
    return base.groupBy(*keys).agg(*aggs).select(*keys, *columns)


def _fetched(brackets: DataFrame) -> tuple[DataFrame | Row, int]:
    """The brackets of up to ``BROADCAST_GROUPS`` groups as a local table to be broadcast (of one group without keys, the
    row itself), of more as a written table; and the most values that may lie inside any."""
    names = [c for c in brackets.columns if c.startswith("_most")]
    rows = brackets.limit(BROADCAST_GROUPS + 1).collect()
    if len(rows) > BROADCAST_GROUPS:
        table = materialize(brackets, "brackets")
        return table, table.agg(F.max(F.greatest(F.lit(0), *names))).first()[0] or 0
    most = max((r[c] or 0 for r in rows for c in names), default=0)
    if not any(c.startswith("_k") for c in brackets.columns):
        return rows[0], most
    return F.broadcast(brackets.sparkSession.createDataFrame(rows, brackets.schema)), most


def _bracketed(base: DataFrame, brackets: DataFrame | Row, keys: list[str]) -> DataFrame:
    """The rows with their group's brackets: a single group's as literals."""
    if isinstance(brackets, Row):
        return base.select("*", *[F.lit(v).cast("long" if c.startswith("_most") else "double").alias(c)
                                  for c, v in brackets.asDict().items()])
    side = brackets.select(*[F.col(k).alias(f"_o{k}") for k in keys], *[c for c in brackets.columns if c not in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_o{k}")) for k in keys])
    return base.join(side, same).drop(*[f"_o{k}" for k in keys])


def _narrowed(rows: DataFrame, keys: list[str], brackets: DataFrame | Row, wanted: Wanted) -> DataFrame:
    """Brackets of about 3 / ``GRID`` of the values in those of ``rows``."""
    grid = F.array(*[F.lit(g / GRID) for g in range(GRID + 1)])
    aggs = []
    for i, (_, probs) in enumerate(wanted):
        v = F.col(f"_v{i}")
        aggs.append(F.count(v).alias(f"n{i}"))
        for j in range(len(probs)):
            lo, hi = F.col(_b(i, j, "lo")), F.col(_b(i, j, "hi"))
            inside = F.when((v > lo) & (v < hi), v)
            aggs += [F.count(F.when(v <= lo, 1)).alias(_b(i, j, "upto")), F.count(inside).alias(_b(i, j, "n")),
                     F.percentile_approx(inside, grid, ACCURACY).alias(_b(i, j, "grid"))]
    columns = []
    for i, (_, probs) in enumerate(wanted):
        for j, p in enumerate(probs):
            lo, hi, n, own = (F.col(_b(i, j, x)) for x in ("lo", "hi", "n", "grid"))
            rank = (F.col(f"n{i}") - 1) * F.lit(float(p)) - F.col(_b(i, j, "upto"))
            part = F.floor(rank / F.nullif(n, F.lit(0)) * GRID).cast("int")
            few = n <= LIST
            columns += [F.when(few | (part < 1), lo).when(part > GRID, hi).otherwise(F.get(own, part - 1)).alias(_b(i, j, "lo")),
                        F.when(few | (part > GRID - 2), hi).when(part < -1, lo).otherwise(
                            F.get(own, F.greatest(part, F.lit(0)) + 2)).alias(_b(i, j, "hi")),
                        F.when(few, n).otherwise(F.ceil(n * (3 / GRID + 2 / ACCURACY))).cast("long").alias(_b(i, j, "most"))]
    return _with_ends(rows, keys, brackets, wanted, aggs).select(*keys, *columns)


def _with_ends(rows: DataFrame, keys: list[str], brackets: DataFrame | Row, wanted: Wanted, aggs: list) -> DataFrame:
    """Each group's aggregates and the ends of its brackets, which all its rows share."""
    ends = [_b(i, j, e) for i, (_, ps) in enumerate(wanted) for j in range(len(ps)) for e in ("lo", "hi")]
    if isinstance(brackets, Row):
        return rows.groupBy(*keys).agg(*aggs).select("*", *[F.lit(brackets[c]).cast("double").alias(c) for c in ends])
    return rows.groupBy(*keys).agg(*aggs, *[F.first(c, ignorenulls=True).alias(c) for c in ends])


def exact_quantiles(df: DataFrame, value: str | Column, probs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None) -> DataFrame:
    """by, n, and one column per probability; NULL values are left out, NULL keys form a group."""
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    got = quantiles_of(df, [(F.col(value) if isinstance(value, str) else value, probs)], by)
    return got.select(*by, F.col("n0").alias("n"), *[F.col(f"q0_{j}").alias(c) for j, c in enumerate(names)])


def medians(df: DataFrame, values: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """by and one exact median per named value, in one pair of passes; a group without any value has no row."""
    got = quantiles_of(df, [(v, [0.5]) for v in values.values()], by)
    return got.select(*by, *[F.col(f"q{i}_0").alias(k) for i, k in enumerate(values)])


def group_quantiles(df: DataFrame, value: str | Column, probs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None, accuracy: int | None = None,
                    with_count: bool = False) -> DataFrame:
    """Exact quantiles per group, or the sketch alone where ``accuracy`` is given."""
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    if not accuracy:
        return exact_quantiles(df, value, probs, by, names).select(*by, *(["n"] if with_count else []), *names)
    v = F.col(value) if isinstance(value, str) else value
    aggs = [F.percentile_approx(v, F.array(*[F.lit(float(p)) for p in probs]), accuracy).alias("_q"),
            F.count(v).alias("n")]
    grouped = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return grouped.select(*by, *(["n"] if with_count else []), *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


TRIM_TARGETS = (("venta", "venta_m2_usd"), ("alquiler", "alquiler_m2_usd_mes"))


def trim_value() -> Column:
    expr = None
    for op, col in TRIM_TARGETS:
        cond = F.col("operacion") == op
        expr = F.when(cond, F.col(col)) if expr is None else expr.when(cond, F.col(col))
    return expr


def trim_bounds(tagged: DataFrame, mode: str = "moderado", accuracy: int | None = None) -> DataFrame:
    """(operacion, n, lo, hi) over the alive rows, one row per operation (at most 2 rows)."""
    p_lo, p_hi = K.TRIM_MODES[mode]
    base = (tagged.filter(rules.alive() & F.col("operacion").isin([op for op, _ in TRIM_TARGETS]))
            .select("operacion", trim_value().alias("_v"))
            .filter(F.col("_v").isNotNull()))
    return group_quantiles(base, "_v", [p_lo, p_hi], ["operacion"], ["lo", "hi"], accuracy, with_count=True)


def quantile_trim(tagged: DataFrame, mode: str = "moderado", min_n: int = K.TRIM_MIN_GROUP,
                  accuracy: int | None = None) -> DataFrame:
    """tag alive rows whose price/m2 falls outside [p_lo, p_hi] of their operation.

    Groups with fewer than ``min_n`` values are left untouched; NULL values are kept.
    The bounds table has at most one row per operation, so it is broadcast.
    """
    if mode == "conservador":
        return tagged
    # written, so that every reader of the trimmed table joins two rows instead of finding the quantiles again
    bounds = materialize(trim_bounds(tagged, mode, accuracy).filter(F.col("n") >= min_n), "trim-bounds")
    b = F.broadcast(bounds.select(F.col("operacion").alias("_op"), F.col("lo").alias("_lo"),
                                  F.col("hi").alias("_hi")))
    j = tagged.join(b, F.col("operacion") == F.col("_op"), "left")
    v = trim_value()
    mask = F.col("_op").isNotNull() & v.isNotNull() & ((v < F.col("_lo")) | (v > F.col("_hi")))
    out = j.withColumn(rules.REASON, F.when(rules.alive() & F.coalesce(mask, F.lit(False)),
                                            F.concat(F.lit("outlier_precio_m2_"), F.col("operacion")))
                       .otherwise(F.col(rules.REASON)))
    return out.drop("_op", "_lo", "_hi")


def tukey_filter(df: DataFrame, value: str, by: Sequence[str] = (), k: float = 1.5,
                 accuracy: int | None = None) -> DataFrame:
    """keep rows with q1 - k*iqr <= value <= q3 + k*iqr (NULL values drop out).  The table of fences has a row
    per group; adaptive execution broadcasts it where its measured size allows."""
    stats = group_quantiles(df.filter(F.col(value).isNotNull()), value, [0.25, 0.75], by,
                            ["_q1", "_q3"], accuracy)
    stats = stats.select(*by, (F.col("_q1") - (F.col("_q3") - F.col("_q1")) * k).alias("_lo"),
                         (F.col("_q3") + (F.col("_q3") - F.col("_q1")) * k).alias("_hi"))
    if by:
        j = df.join(stats, list(by), "inner")
        return j.filter((F.col(value) >= F.col("_lo")) & (F.col(value) <= F.col("_hi"))).drop("_lo", "_hi")
    lo, hi = stats.select("_lo").scalar(), stats.select("_hi").scalar()  # one-row scalar subqueries
    return df.filter((F.col(value) >= lo) & (F.col(value) <= hi))
