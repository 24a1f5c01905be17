"""Line dedup: a deletion-neighbourhood join with an edit bound of one word.

A line is a part of a text between line feeds; lines are compared as sequences of words (``[^\\x20\\x09-\\x0D]+``, A-Z
lower-cased). A line is removed if an earlier line (by doc_id, then line number) equals it, or, from ``NEAR_WORDS``
words on, differs by at most one inserted, deleted or replaced word. Lines under ``MIN_WORDS`` words always stay.

1. Equal lines meet by a 128-bit hash; only each distinct line's first place goes on.
2. Lines one edit apart share their first or their last half (of the longer one's words but one). Lines that share
   neither half with a different line can have no neighbour and go no further.
3. The others emit every one-word deletion, and themselves, as hashed keys. Two lines of equal length whose variants
   are equal *and* lack the same position differ by one replaced word; a line that equals another's variant differs by
   one inserted word. No other pair of equal keys counts, so the kind of match is also the proof of its distance
   (up to collisions of 128 bits).
4. The earliest place by key (and position) is an aggregate that combines on the map side, so a key that a third of all
   lines share shrinks before it is shuffled, and no pairs of its lines are ever made; its rows join that aggregate,
   where adaptive execution may split a hot key.

Defined cases: null and empty texts have no lines; null doc_id comes first; rows with the same doc_id count as one
document, so equal lines at the same place all stay; an empty table gives no rows; other columns are not read
(``remove_lines`` carries them in one struct, so no name can clash).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, read_table
from . import textnp as T

MIN_WORDS = 5
NEAR_WORDS = 8

_SECOND = np.uint64(0xA0761D6478BD642F)
_SIDES = (np.uint64(0x1B873593CC9E2D51), np.uint64(0xE7037ED1A0B428DB))


class Lines:
    """Lines with a word of one slice: their row, number in the text, and words [start, end)."""

    def __init__(self, texts: pa.Array):
        data, ends = T.raw_bytes(texts)
        s, e, _ = T.words(data, ends)
        self.values = T.word_hashes(data, s, e, lower=True)
        self.second = T.mix(self.values ^ _SECOND)
        if not len(s):
            self.row = self.line = self.start = self.end = np.zeros(0, np.int64)
            return
        feeds = np.cumsum(data == 10)
        row = np.searchsorted(ends, s, "right")
        begins = np.r_[0, ends[:-1]]
        before = np.where(begins > 0, feeds[np.maximum(begins, 1) - 1], 0)
        line = feeds[s] - before[row]
        new = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(line) != 0)])
        self.row, self.line = row[new], line[new]
        self.start, self.end = new, np.r_[new[1:], len(s)]

    def keep(self, which: np.ndarray) -> None:
        self.row, self.line = self.row[which], self.line[which]
        self.start, self.end = self.start[which], self.end[which]


def _long(x: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64(), mask=None if valid is None else ~valid)


def line_keys(docs: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """doc, line, n, h1, h2 and up to four half keys (null under ``near_words``) of each line of ``min_words`` words."""
    names = ["doc", "line", "n", "h1", "h2", "p0", "p1", "s0", "s1"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in T.slices(batch.column(1)):
                x = Lines(batch.column(1).slice(a, b - a))
                x.keep(np.flatnonzero(x.end - x.start >= min_words))
                n = x.end - x.start
                near = n >= near_words
                columns = [batch.column(0).slice(a, b - a).take(pa.array(x.row)), pa.array(x.line), pa.array(n),
                           _long(T.span_hash(x.values, x.start, x.end)), _long(T.span_hash(x.second, x.start, x.end))]
                # an even number of words has one length of halves, an odd number two
                for side in (0, 1):
                    for half, valid in ((n // 2, near), ((n + 1) // 2, near & (n % 2 == 1))):
                        span = (x.start, x.start + half) if side == 0 else (x.end - half, x.end)
                        columns.append(_long(T.mix(T.span_hash(x.values, *span) ^ _SIDES[side]), valid))
                yield pa.RecordBatch.from_arrays(columns, names)

    return (docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
            .mapInArrow(run, ", ".join(f"{x} long" for x in names)))


def variants(docs: DataFrame, active: DataFrame) -> DataFrame:
    """k1, k2, gone, place: each active line without its word number ``gone``, and whole (gone = -1)."""
    wanted = active.groupBy("doc").agg(F.collect_list("line").alias("lines"))  # at most a document's lines
    source = (docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
              .join(wanted.withColumnRenamed("doc", "own"), F.expr("doc <=> own")).select("doc", "text", "lines"))
    names = ["k1", "k2", "gone", "doc", "line"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in T.slices(batch.column(1), T.SLICE_BYTES // 4):
                x = Lines(batch.column(1).slice(a, b - a))
                lists = batch.column(2).slice(a, b - a)
                rows = np.repeat(np.arange(b - a), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
                asked = np.sort(rows.astype(np.int64) << 32 | lists.flatten().to_numpy(zero_copy_only=False))
                own = x.row << 32 | x.line
                x.keep(np.flatnonzero(np.isin(own, asked)))
                n = x.end - x.start
                first = np.cumsum(n) - n
                word = np.arange(n.sum()) - np.repeat(first - x.start, n)
                gone = word - np.repeat(x.start, n)
                keys = []
                for values in (x.values, x.second):
                    less = T.span_hash_without(values, np.repeat(x.start, n), np.repeat(x.end, n), word)
                    keys.append(np.r_[less, T.span_hash(values, x.start, x.end)])
                doc = batch.column(0).slice(a, b - a).take(pa.array(np.r_[np.repeat(x.row, n), x.row]))
                yield pa.RecordBatch.from_arrays(
                    [_long(keys[0]), _long(keys[1]), pa.array(np.r_[gone, np.full(len(n), -1)]), doc,
                     pa.array(np.r_[np.repeat(x.line, n), x.line])], names)

    return (source.mapInArrow(run, ", ".join(f"{x} long" for x in names))
            .select("k1", "k2", "gone", F.struct("doc", "line").alias("place")))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """doc_id, line, first_doc_id, first_line, edits (0 or 1): the lines to remove, and an earlier line that is the
    reason: the earliest equal one, else the earliest one edit away."""
    keys = materialize(line_keys(docs, min_words, near_words), "lines")
    place = F.struct("doc", "line")
    distinct = materialize(keys.groupBy("h1", "h2", "n", "p0", "p1", "s0", "s1")
                           .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("lines")), "distinct-lines")
    many = distinct.where("lines > 1").select("h1", "h2", "first")
    equal = (keys.join(many, ["h1", "h2"]).where(place > F.col("first"))
             .select("doc", "line", "first", F.lit(0).alias("edits")))

    halves = (distinct.where("p0 is not null")
              .select("first", F.explode(F.array("p0", "p1", "s0", "s1")).alias("half")).where("half is not null"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("half")
    active = halves.join(shared, "half").select("first.doc", "first.line").distinct()
    own = materialize(variants(docs, active), "line-variants")
    by_position = own.groupBy("k1", "k2", "gone").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = F.col("gone") < 0
    by_key = (by_position.groupBy("k1", "k2")
              .agg(F.min(F.when(whole, F.col("first"))).alias("whole"),
                   F.min(F.when(~whole, F.col("first"))).alias("less"))
              .where("whole is not null and less is not null"))
    replaced = (own.join(by_position.where("rows > 1 and gone >= 0"), ["k1", "k2", "gone"])
                .select("place", "first"))
    inserted = (own.join(by_key, ["k1", "k2"])
                .select("place", F.when(whole, F.col("less")).otherwise(F.col("whole")).alias("first")))
    near = (replaced.unionByName(inserted).where("first < place")
            .groupBy("place").agg(F.min("first").alias("first"))
            .select("place.doc", "place.line", "first", F.lit(1).alias("edits")))
    return (equal.unionByName(near)
            .groupBy("doc", "line").agg(F.min(F.struct("edits", "first")).alias("why"))
            .select(F.col("doc").alias("doc_id"), "line", F.col("why.first.doc").alias("first_doc_id"),
                    F.col("why.first.line").alias("first_line"), F.col("why.edits").alias("edits")))


def remove_lines(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS,
                 drop_emptied: bool = False) -> DataFrame:
    """``docs`` without its repeated lines (n_chars counted again); columns and rows stay. With ``drop_emptied`` a
    document goes if it lost lines and has no word left: all of it stands earlier."""
    gone = (repeated_lines(docs, min_words, near_words).groupBy(F.col("doc_id").alias("gone_doc"))
            .agg(F.collect_set("line").alias("gone")))  # at most a document's lines
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = row.join(gone, F.col("row.doc_id").cast("long").eqNullSafe(F.col("gone_doc")), "left")
    kept = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(F.filter(
        F.transform(F.split("row.text", "\n", -1),
                    lambda x, i: F.when(~F.array_contains("gone", i.cast("long")), x)), lambda x: x.isNotNull()), "\n"))
    out = joined.withColumn("kept", kept)
    if drop_emptied:
        out = out.where(F.col("gone").isNull() | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    return out.select(*[F.col("kept").alias(c) if c == "text" else F.length("kept").cast("long").alias(c)
                        if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(read_table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE = rf"""
WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, unnest(x) AS x, generate_subscripts(x, 1) - 1 AS line FROM p),
k AS (SELECT doc_id * 10000000 + line AS place,
    regexp_extract_all(translate(x, '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM l),
e AS (SELECT place, w, min(place) OVER (PARTITION BY w) AS f FROM k WHERE len(w) >= {MIN_WORDS}),
d AS (SELECT DISTINCT w, f FROM e WHERE len(w) >= {NEAR_WORDS}),
g AS (SELECT f, w, unnest(generate_series(1, len(w))) AS gone FROM d),
v AS (SELECT f, gone, md5(array_to_string(list_concat(w[1:gone - 1], w[gone + 1:len(w)]), ' ')) AS h FROM g
  UNION ALL SELECT f, -1, md5(array_to_string(w, ' ')) FROM d),
m AS (SELECT f, gone, min(f) OVER (PARTITION BY h, gone) AS same,
    min(f) FILTER (gone = -1) OVER (PARTITION BY h) AS whole, min(f) FILTER (gone > 0) OVER (PARTITION BY h) AS less
  FROM v),
c AS (SELECT f, unnest([CASE WHEN gone > 0 THEN same END, CASE WHEN gone > 0 THEN whole ELSE less END]) AS c FROM m),
r AS (SELECT f AS place, min(c) AS f, 1 AS edits FROM c WHERE c < f GROUP BY f
  UNION ALL SELECT place, f, 0 FROM e WHERE f < place)
SELECT place // 10000000 AS doc_id, place % 10000000 AS line, f // 10000000 AS first_doc_id, f % 10000000 AS first_line,
    edits
FROM r QUALIFY row_number() OVER (PARTITION BY place ORDER BY edits, f) = 1
"""
