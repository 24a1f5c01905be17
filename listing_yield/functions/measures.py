"""Column expressions for money, units, bins, ratios and yields (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL for a zero or NULL denominator (ANSI-safe)."""
    return F.try_divide(col_(num), col_(den))


def to_usd(amount: str | Column, currency: str | Column, fx: float | Column) -> Column:
    """ARS amounts divided by the rate; any other currency, NULL included, is left unchanged."""
    fx_c = fx if isinstance(fx, Column) else F.lit(float(fx))
    return F.when(col_(currency) == F.lit("ARS"), safe_div(amount, fx_c)).otherwise(col_(amount))


def is_sale(operation: str | Column = "operacion") -> Column:
    """True only for 'venta'; NULL operation counts as not-a-sale (rental side)."""
    return F.coalesce(col_(operation) == F.lit("venta"), F.lit(False))


def price_per_m2(price: str | Column, area: str | Column, digits: int = 2) -> Column:
    return F.round(safe_div(price, area), digits)


def price_per_m2_guarded(price: str | Column, area: str | Column) -> Column:
    """Only when both present and area > 0, rounded to 2: half up on the shortest decimal text of the quotient, as all
    rounded columns here."""
    a = col_(area)
    return F.when(col_(price).isNotNull() & (col_(price) != 0) & a.isNotNull() & (a > 0),
                  F.round(safe_div(price, a), 2))


def right_closed_bins(value: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """(lo, hi] bins; values outside every bin, and NULL, give NULL."""
    v = col_(value)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (v > F.lit(lo)) & (v <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def covered_ratio(covered: str | Column = "sup_cubierta_m2", total: str | Column = "sup_total_m2") -> Column:
    r = F.round(safe_div(covered, total), 3)
    return F.when((r > F.lit(K.COVERED_RATIO_MAX)) | (r <= 0), F.lit(None).cast("double")).otherwise(r)


def expenses_ratio(expenses: str | Column = "expensas_usd", rent: str | Column = "alquiler_usd_mes") -> Column:
    r = F.round(safe_div(expenses, rent), 3)
    return F.when(r > F.lit(K.EXPENSES_RATIO_MAX), F.lit(None).cast("double")).otherwise(r)


def type_family(kind: str | Column = "tipo_propiedad") -> Column:
    t = col_(kind)
    return (F.when(t.startswith("departamento"), F.lit("departamento"))
            .when(t.startswith("casa"), F.lit("casa"))
            .when(t == F.lit("ph"), F.lit("ph"))
            .otherwise(F.lit("otro")))


def gross_yield(rent_month: str | Column, price: str | Column) -> Column:
    """rent x 12 / price x 100, rounded to 2."""
    return F.round(safe_div(col_(rent_month) * 12, price) * 100, 2)


def net_yield(gross_rounded: str | Column, vacancy_pct: float, costs_pct: float) -> Column:
    """Derived from the already-rounded gross yield, then rounded to 2."""
    return F.round(col_(gross_rounded) * F.lit(1 - vacancy_pct / 100) * F.lit(1 - costs_pct / 100), 2)


def payback_months(price: str | Column, rent_month: str | Column) -> Column:
    return F.round(safe_div(price, rent_month), 0)


def yield_band(gross: str | Column, error: str | Column, sign: int) -> Column:
    return F.round(col_(gross) * (F.lit(1) + F.lit(sign) * col_(error)), 2)
