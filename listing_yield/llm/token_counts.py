"""Token counts: an exact histogram of encoded lengths, and suffix sums over it.

Each task counts its own documents by length, so the shuffle carries one row for each task and distinct length. A
context limit is answered from the suffix sums of the smallest length above it (``at_limits``): with D documents of that
length or more, and T tokens in shorter ones, a limit m keeps the T tokens and m of each of the D documents.

The suffix sums are taken in two steps, inside cells of ``CELL`` lengths and over the cells' totals, so no task orders
the whole histogram.

Defined cases: null and empty texts have length 0 and are counted; repeated rows count each; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, read_table
from .encode import VOCABULARY, encoder

CELL = 4096


def length_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """n_tokens, n_docs: the documents of each encoded length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen = encoder(vocabulary), Counter()
        for batch in batches:
            for text in batch.column(0):
                seen[len(enc.ids(text.as_py() or "")) // 4] += 1
        yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(list(seen.keys()), pa.int64()),
                                          "n_docs": pa.array(list(seen.values()), pa.int64())})

    return (docs.select("text").mapInArrow(run, "n_tokens long, n_docs long")
            .groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs")))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """Adds to each length: documents and tokens at that length or more (docs_ge, tokens_ge) and below
    (docs_lt, tokens_lt), and the tokens that remain when every document is cut to that length (truncated_tokens)."""
    cells = (counts.withColumn("cell", F.floor(F.col("n_tokens") / CELL))
             .groupBy("cell").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t")))
    # one row for each cell of lengths: as many as the longest document has cells, whatever the number of documents
    above = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("cell", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}_{n}")
                                   for c in "dt" for n, w in (("above", above), ("below", below))])
    tokens = F.col("n_docs") * F.col("n_tokens")
    up = Window.partitionBy("cell").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("cell").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    out = (counts.withColumn("cell", F.floor(F.col("n_tokens") / CELL)).join(cells, "cell")
           .select("n_tokens", "n_docs",
                   (F.sum("n_docs").over(up) + F.col("d_above")).alias("docs_ge"),
                   (F.sum(tokens).over(up) + F.col("t_above")).alias("tokens_ge"),
                   (F.coalesce(F.sum("n_docs").over(down), F.lit(0)) + F.col("d_below")).alias("docs_lt"),
                   (F.coalesce(F.sum(tokens).over(down), F.lit(0)) + F.col("t_below")).alias("tokens_lt")))
    return out.withColumn("truncated_tokens", F.col("tokens_lt") + F.col("n_tokens") * F.col("docs_ge"))


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """context_limit, total_docs, total_tokens, docs_over, truncated_tokens for each limit, read off the suffix sums: of
    the first length above the limit (its documents and the longer ones keep the limit's many tokens, all shorter ones
    stay whole), or of the longest length, for limits from there on. Without documents all are 0."""
    if not limits:
        return sums.limit(0).selectExpr("n_tokens context_limit", "0L total_docs", "0L total_tokens", "0L docs_over",
                                        "0L truncated_tokens")
    row = F.struct("n_tokens", "docs_ge", "docs_lt", "tokens_ge", "tokens_lt")
    # the smallest and largest row of either side combine on the map side; nothing but the limits' rows comes together
    picked = sums.agg(F.max(row).alias("top"), *[
        F.min(F.when(F.col("n_tokens") > int(x), row)).alias(f"above{i}") for i, x in enumerate(limits)])
    above = F.array(*[F.struct(F.lit(int(x)).cast("long").alias("context_limit"), F.col(f"above{i}").alias("above"))
                      for i, x in enumerate(limits)])
    none = F.lit(0).cast("long")
    found = picked.select("top", F.explode(above).alias("at")).select("top", "at.context_limit", "at.above")
    total = lambda c: F.coalesce(F.col(f"top.{c}_ge") + F.col(f"top.{c}_lt"), none)
    kept = F.coalesce(F.col("above.tokens_lt") + F.col("context_limit") * F.col("above.docs_ge"), total("tokens"))
    return found.select("context_limit", total("docs").alias("total_docs"), total("tokens").alias("total_tokens"),
                        F.coalesce("above.docs_ge", none).alias("docs_over"), kept.alias("truncated_tokens"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """share, n_tokens: the smallest length that at least that share of the documents doesn't exceed."""
    rank = [F.min(F.when(F.col("docs_lt") + F.col("n_docs") >= F.lit(q) * (F.col("docs_lt") + F.col("docs_ge")),
                         F.col("n_tokens"))).alias(f"q{i}") for i, q in enumerate(shares)]
    rows = F.array(*[F.struct(F.lit(float(q)).alias("share"), F.col(f"q{i}").alias("n_tokens"))
                     for i, q in enumerate(shares)])
    return sums.agg(*rank).select(F.explode(rows).alias("r")).select("r.share", "r.n_tokens")


#: Context limits that the registered query reports besides the lengths that occur.
LIMITS = [128, 512, 1024, 2048, 4096, 8192, 32768, 131072]
SHARES = [0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each encoded length that occurs (kind ``length``), with its suffix sums and the share of documents up
    to it; then the answers read off them: for each of ``LIMITS`` (kind ``limit``) how many documents are longer and what
    is left of all tokens, and for each of ``SHARES`` (kind ``quantile``) its length."""
    # several branches read the sums; written once, texts are encoded once
    counts = materialize(length_counts(read_table(spark, sf_dir, "documents")), "lengths")
    sums = materialize(suffix_sums(counts), "suffix-sums")
    share = (F.col("docs_lt") + F.col("n_docs")) / (F.col("docs_lt") + F.col("docs_ge"))
    lengths = sums.withColumn("share_le", share).withColumn("kind", F.lit("length"))
    limits = at_limits(sums, LIMITS).select(
        F.lit("limit").alias("kind"), F.col("context_limit").alias("n_tokens"), F.col("docs_over").alias("docs_ge"),
        (F.col("total_docs") - F.col("docs_over")).alias("docs_lt"), "truncated_tokens")
    cuts = quantiles(sums, SHARES).where("n_tokens is not null").select(
        F.lit("quantile").alias("kind"), "n_tokens", F.col("share").alias("share_le"))
    return lengths.unionByName(limits, allowMissingColumns=True).unionByName(cuts, allowMissingColumns=True)
