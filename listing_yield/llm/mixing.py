"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Documents are summed to cells (source, language, topic) with their tokens. Raking scales the cells' weights until the
shares of tokens by source, by language and by topic equal the targets; each sweep makes three scalings by window sums
over the small table of cells. After each round of sweeps the shares are compared with the targets, and raking goes on
until no share is further than ``TOLERANCE`` from its target. Targets that contradict each other can't all be met; then
raking ends when the largest deviation falls no more, that deviation is returned as ``residual``, and a warning names it. A document is then kept if a hash of its doc_id, as a number in [0, 1), is below its
cell's rate; rates are scaled so that the largest is 1, so no cell is cut short and the kept tokens have the targets'
shares in expectation.

Targets may be given as tables; by default each margin is tempered: its shares to the power ``alpha``, so large sources
give way a little to small ones. ``documents`` has no topic column, so the default topic is the layout of a text: the
mean length of its lines in three classes; callers pass their own column. Tokens are words unless a column says
otherwise.

Defined cases: null source, language or topic is a category of its own; null and empty texts have no tokens, and
documents of cells without tokens are kept (rate 1), as they change no share; a category that the targets lack (or give
0) gets rate 0; equal doc_ids get equal decisions, null doc_id is hashed as the empty text; an empty table gives no rows;
other columns are carried in one struct, so no name can clash.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, read_table

SWEEPS = 10  # of a round, and of one plan
MOST_SWEEPS = 500
TOLERANCE = 1e-6  # of a share
ALPHA = 0.9  # a category of 1 % of the tokens is raised by half and more; 0.97 left the shares nearly as they were
MARGINS = ("source", "lang", "topic")
NONE = "(none)"
BROADCAST_CELLS = 50_000
SHORT_LINE, LONG_LINE = 120, 400


def words(text: Column) -> Column:
    """Number of words; a word follows white space or the start."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def layout(text: Column) -> Column:
    """short, middle or long: the mean length of a text's lines."""
    text = F.coalesce(text, F.lit(""))
    lines = F.length(text) - F.length(F.translate(text, "\n", "")) + 1
    mean = F.length(text) / lines
    return F.when(mean < SHORT_LINE, "short").when(mean < LONG_LINE, "middle").otherwise("long")


def labelled(docs: DataFrame, tokens: Column | None = None, topic: Column | None = None) -> DataFrame:
    """row (all columns of docs), source, lang, topic, tokens."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    name = lambda c: F.coalesce(c, F.lit(NONE))
    return docs.select(row, name(F.col("source")).alias("source"), name(F.col("lang")).alias("lang"),
                       name(topic if topic is not None else layout(F.col("text"))).alias("topic"),
                       (tokens if tokens is not None else words(F.col("text"))).alias("tokens"))


def tempered(cells: DataFrame, margin: str, alpha: float) -> DataFrame:
    """category, target: shares of tokens to the power alpha, summing to 1."""
    share = cells.groupBy(F.col(margin).alias("category")).agg(F.sum("tokens").alias("t")).where("t > 0")
    return share.select("category", (F.pow(F.col("t"), F.lit(alpha)) /
                                     F.sum(F.pow(F.col("t"), F.lit(alpha))).over(Window.partitionBy())).alias("target"))


def deviation(raked: DataFrame, targets: dict[str, DataFrame]) -> float:
    """The largest difference of a category's share of the weights and its target, over all margins."""
    rows = None
    for m in MARGINS:
        have = raked.groupBy(F.col(m).alias("category")).agg(F.sum("weight").alias("weight"))
        both = have.join(targets[m].select("category", "target"), "category", "full").select(
            F.lit(m).alias("margin"), F.coalesce("weight", F.lit(0.0)).alias("weight"),
            F.coalesce(F.col("target").cast("double"), F.lit(0.0)).alias("target"))
        rows = both if rows is None else rows.unionByName(both)
    # one row for each category of a margin
    share = lambda c: F.coalesce(F.try_divide(c, F.sum(c).over(Window.partitionBy("margin"))), F.lit(0.0))
    rows = rows.select(F.abs(share(F.col("weight")) - share(F.col("target"))).alias("d"))
    return rows.agg(F.max("d")).first()[0] or 0.0


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """Adds ``weight`` (the raked tokens), ``rate`` (weight by token, largest 1) and ``residual`` (the largest deviation
    of a share from its target) to the cells; targets maps each margin to (category, target). The table of cells has one
    row for each combination of categories; ``sweeps`` are made between two looks at the margins."""
    out = cells.where("tokens > 0")
    for m in MARGINS:
        out = out.join(targets[m].select(F.col("category").alias(m), F.col("target").alias(f"{m}_target")), m, "left")
    out = out.withColumn("weight", F.col("tokens").cast("double"))
    done, before = 0, float("inf")
    while True:
        for start in range(0, sweeps, SWEEPS):  # a plan of more sweeps is too deep
            for _ in range(min(SWEEPS, sweeps - start)):
                for m in MARGINS:
                    total = F.sum("weight").over(Window.partitionBy(m))
                    out = out.withColumn("weight", F.when(
                        total > 0, F.col("weight") * F.coalesce(f"{m}_target", F.lit(0.0)) / total).otherwise(0.0))
            out = materialize(out, "raked-cells")
        done, residual = done + max(sweeps, 1), deviation(out, targets)
        if residual <= TOLERANCE or residual > 0.999 * before or done >= MOST_SWEEPS:
            break
        before = residual
    if residual > TOLERANCE:
        warnings.warn(f"mixing: targets not met after {done} sweeps; a share is off by {residual:.3g}", stacklevel=2)
    top = out.agg(F.max(F.col("weight") / F.col("tokens"))).scalar()
    rate = F.when(top > 0, F.col("weight") / F.col("tokens") / top).otherwise(0.0)
    raked = out.select(*MARGINS, "weight", rate.alias("rate"))
    return (cells.join(raked, list(MARGINS), "left")
            .select(*MARGINS, "tokens", "docs", F.coalesce("weight", F.lit(0.0)).alias("weight"),
                    F.lit(residual).alias("residual"),
                    F.when(F.col("tokens") > 0, F.coalesce("rate", F.lit(0.0))).otherwise(1.0).alias("rate")))


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) from doc_id: the first 52 bits of its MD5."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, alpha: float = ALPHA, sweeps: int = SWEEPS,
        tokens: Column | None = None, topic: Column | None = None) -> DataFrame:
    """row, source, lang, topic, tokens, rate, residual (the largest deviation of a share from its target), kept for every
    document."""
    known = labelled(docs, tokens, topic)
    cells = materialize(known.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"),
                                                    F.count(F.lit(1)).alias("docs")), "cells")
    rates = rake(cells, targets or {m: tempered(cells, m, alpha) for m in MARGINS}, sweeps)
    rates = materialize(rates.select(*MARGINS, "rate", "residual"), "rates")
    if rates.count() <= BROADCAST_CELLS:  # then texts needn't move, and a hot cell has no task of its own
        rates = F.broadcast(rates)
    out = known.join(rates, list(MARGINS), "left")
    return out.withColumn("kept", uniform(F.col("row.doc_id")) < F.col("rate"))


def sample(docs: DataFrame, **how) -> DataFrame:
    """The kept documents; columns stay."""
    return mix(docs, **how).where("kept").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    known = mix(docs)
    return known.select(F.col("row.doc_id").alias("doc_id"), *MARGINS, "tokens", F.round("rate", 9).alias("rate"),
                        (F.col("residual") <= TOLERANCE).alias("targets_met"), "kept")


def _oracle(sweeps: int = SWEEPS, alpha: float = ALPHA) -> str:
    ctes, last = [], "start"
    for _ in range(sweeps):
        for m in MARGINS:
            n = f"c{len(ctes)}"
            ctes.append(f"{n} AS MATERIALIZED (SELECT * REPLACE (weight * {m}_target / sum(weight) OVER (PARTITION BY {m})"
                        f" AS weight) FROM {last})")
            last = n
    margins = ", ".join(f"t_{m} AS (SELECT {m}, pow(sum(tokens), {alpha}) / sum(pow(sum(tokens), {alpha})) OVER ()"
                        f" AS {m}_target FROM cells WHERE tokens > 0 GROUP BY {m})" for m in MARGINS)
    off = " UNION ALL ".join(f"SELECT abs(sum(weight) / sum(sum(weight)) OVER () - any_value({m}_target)) AS d FROM {last}"
                             f" GROUP BY {m}" for m in MARGINS)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
    coalesce(text, '') AS t FROM documents),
k AS (SELECT doc_id, source, lang, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::BIGINT AS tokens,
    length(t) / (length(t) - length(replace(t, chr(10), '')) + 1) AS mean FROM d),
known AS (SELECT doc_id, source, lang, CASE WHEN mean < {SHORT_LINE} THEN 'short' WHEN mean < {LONG_LINE} THEN 'middle'
    ELSE 'long' END AS topic, tokens FROM k),
cells AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM known GROUP BY ALL),
{margins},
start AS (SELECT cells.*, source_target, lang_target, topic_target, tokens AS weight FROM cells
  JOIN t_source USING (source) JOIN t_lang USING (lang) JOIN t_topic USING (topic) WHERE tokens > 0),
{", ".join(ctes)},
rates AS (SELECT source, lang, topic, weight / tokens / max(weight / tokens) OVER () AS rate FROM {last}),
off AS ({off}),
met AS (SELECT max(d) <= {TOLERANCE} AS targets_met FROM off)
SELECT doc_id, source, lang, topic, tokens, round(coalesce(rate, 1.0), 9) AS rate, targets_met,
    ('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0 < coalesce(rate, 1.0) AS kept
FROM known LEFT JOIN rates USING (source, lang, topic), met
"""


ORACLE = _oracle()
