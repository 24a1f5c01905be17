"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join. DataFrame functions only.

A listed URL (rule) is ``host/path``; it fits its host and all subdomains, for every path that starts with its own.
A page's keys come from its own URL, however long the list: the host's last 1, 2, ... labels, each with every folder of
the path (its beginnings that end in a slash, and the empty one), as far as the list's deepest host and longest folder
go. A rule is found under its own folder. Keys that the filter can't exclude go on to an exact join with the listed
folders, which removes the false positives. A folder that is a rule itself gives a hit; where rules go on behind their
last slash, the folder's row says how long their paths are (numbers, at most one for each length), and the URL's
beginnings of these lengths pass the filter and an exact join once more, so rules of one folder never meet all of its
pages. Of the rules that remain the longest wins.

The filter is an array of 512-bit blocks: one hash names the block, another one bit in each of its eight words. It holds
rules and folders, is built as a table (block, eight words) by ``bit_or``, and broadcast only if it has at most
``BROADCAST_BYTES``, which is known from the list's size before it is built; beyond that the same join shuffles.

Defined cases: a null URL or one without ``://`` has empty host and path and fits no rule; null rules are left out;
a rule listed with two verdicts blocks; rules of equal length go by their text; repeated page rows are judged each; an
empty list or table is fine; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, read_table

BITS_PER_KEY = 16
WORDS = 8
BROADCAST_BYTES = 16 << 20

#: The rules of the contract.
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
         ("net/fr/", "block")]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def folder_of(path: Column) -> Column:
    """A path up to its last slash; empty without one."""
    return F.regexp_extract(path, "(?s)^(.*/)?", 0)


def canonical(rules: DataFrame) -> DataFrame:
    """rule, folder, labels, folder_length, path_length, verdict: each rule once, its host in lower case."""
    host = F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER)
    path = F.substring(F.col("rule"), F.length(F.substring_index("rule", "/", 1)) + 1, F.length("rule"))
    return (rules.where("rule is not null").select(host.alias("h"), path.alias("p"), "verdict")
            .select(F.concat("h", "p").alias("rule"), F.concat(F.col("h"), folder_of(F.col("p"))).alias("folder"),
                    F.size(F.split("h", "[.]")).alias("labels"), F.length(folder_of(F.col("p"))).alias("folder_length"),
                    F.length("p").alias("path_length"), "verdict")
            .groupBy("rule", "folder", "labels", "folder_length", "path_length")
            .agg(F.max("verdict").alias("verdict")))


def probe_columns(key: str, blocks: int) -> list[str]:
    """block, w0 to w7: the key's block and its one bit in each of the block's words."""
    return [f"pmod(xxhash64({key}), {blocks}L) block",
            *[f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({key}, 1), {6 * i}) & 63 as int)) w{i}"
              for i in range(WORDS)]]


def bloom_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """block, f0 to f7: the blocks that any key sets."""
    return (listed.selectExpr(*probe_columns(key, blocks)).groupBy("block")
            .agg(*[F.bit_or(f"w{i}").alias(f"f{i}") for i in range(WORDS)]))


def possible(probes: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows whose ``key`` the filter can't exclude."""
    bits = " and ".join(f"(w{i} & f{i}) != 0" for i in range(WORDS))
    return probes.selectExpr("*", *probe_columns("key", blocks)).join(bloom, "block").where(bits).select(*probes.columns)


def page_keys(pages: DataFrame, deepest: int, longest: int) -> DataFrame:
    """url, path, end (the host's last labels, ``deepest`` at most), key: each end of a host with each folder, of
    ``longest`` characters at most, of its path."""
    ends = (pages.where("host != ''").selectExpr(
        "url", "host", "path", f"substring(path, 1, {longest}) head",
        f"explode(sequence(1, least(size(split(host, '[.]')), {max(deepest, 1)}))) n")
        .selectExpr("url", "path", "head", "substring_index(host, '.', -n) end"))
    return (ends.selectExpr("url", "path", "end", "head", "explode(sequence(0, size(split(head, '/')) - 1)) n")
            .selectExpr("url", "path", "end", "concat(end, if(n = 0, '', concat(substring_index(head, '/', n), '/'))) key"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """page_id, host, path, rule (null if none fits), verdict (the rule's, else ``default``)."""
    listed = materialize(canonical(rules), "listed-urls")
    host, path = split_url(F.col("url"))
    pages = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    deepest, longest, further = listed.agg(F.max("labels"), F.max("folder_length"),
                                           F.max(F.col("path_length") - F.col("folder_length"))).first()
    folders = listed.groupBy(F.col("folder").alias("key")).agg(
        F.max(F.when(F.col("rule") == F.col("folder"), F.col("verdict"))).alias("verdict"),
        F.collect_set(F.when(F.col("rule") != F.col("folder"), F.col("path_length"))).alias("lengths"))
    keys = listed.select(F.explode(F.array_distinct(F.array("rule", "folder"))).alias("key")).distinct()
    blocks = max(1, math.ceil(keys.count() * bits_per_key / (64 * WORDS)))
    bloom = bloom_filter(keys, "key", blocks)
    if blocks * (WORDS + 1) * 8 <= BROADCAST_BYTES:
        bloom = F.broadcast(bloom)

    found = possible(page_keys(pages, deepest or 0, longest or 0), bloom, blocks).join(folders, "key")
    exact = found.where("verdict is not null").select("url", F.col("key").alias("rule"), "verdict")
    if further:  # rules that don't end in a slash
        deeper = (found.select("url", "path", "end", F.explode("lengths").alias("n")).where("length(path) >= n")
                  .selectExpr("url", "concat(end, substring(path, 1, n)) key"))
        exact = exact.unionByName(possible(deeper, bloom, blocks)
                                  .join(listed.select(F.col("rule").alias("key"), "verdict"), "key")
                                  .select("url", F.col("key").alias("rule"), "verdict"))
    best = (exact.groupBy("url")
            .agg(F.max(F.struct(F.length("rule").alias("n"), F.col("rule"), F.col("verdict"))).alias("best")))
    return (pages.join(best, "url", "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "rule string, verdict string"))


_VALUES = ", ".join(f"('{r.split('/')[0]}', '{r[r.index('/'):]}', '{r}', '{v}')" for r, v in RULES)

ORACLE = rf"""
WITH rest AS (SELECT page_id, url,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n FROM rest),
rules(h, p, rule, verdict) AS (VALUES {_VALUES}),
fits AS (SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (n)
"""
