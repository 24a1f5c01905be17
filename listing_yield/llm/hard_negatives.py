"""Hard-negative mining for a stated set of anchors, by segment summary filtering.

Vectors are integers floor(scale * x), scores their inner products. A vector is cut into segments, and of each its mean
m and deviation s (over the segment's w components) are stored: a segment's part of x.y lies within
w * (mx * my - sx * sy) and w * (mx * my + sx * sy). Segments are refined by level: ``FIRST`` of them, then twice as
many each time, as long as they have more than one component; what every level leaves is scored exactly.

Rows are dealt into blocks by (label, vec_id). A block is one row: ids, labels, vectors and their summaries; a small table
holds the range of the blocks' first-level means and deviations. Pairs of an anchor block and a row block whose ranges show
that no score can matter are left out before a vector is moved. For the others a row block goes to its tasks once
for ``SHARE`` anchor blocks, which stream past it. Two searches of this kind:

* positives: the best ``positives`` rows of the anchor's label; only blocks that hold the label meet;
* negatives: for each positive, the best ``negatives`` rows of another label whose score is between ``low`` percent
  and 100 percent of the positive's. A row is of interest if its upper bound reaches the least score still wanted by
  any of the anchor's positives, and its lower bound isn't above the best positive.

In a task the least score wanted rises with what was found, so later chunks of ``CHUNK`` rows are filtered harder. A task
returns its best rows for each anchor (and positive); a window picks the best of all.

Defined cases: rows with a null vec_id, label or vector, or a null or non-finite component, take no part; exactly
repeated rows count once; an anchor's candidates are all rows of other vec_id; ties go to the smaller vec_id; positives
with negative scores have no negatives (their range is empty); shorter vectors count as filled up with zeros; an anchor
without rows of its label gives no rows, nor does an empty table; other columns are not read. Scores have to be under
2**53, where sums of doubles are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, read_table

FIRST = 8  # segments of the first level
BLOCK_VALUES = 1 << 19  # components in a row block
ANCHOR_VALUES = 1 << 15  # components in an anchor block
SHARE = 64  # anchor blocks that one copy of a row block meets
CHUNK = 2048
SLACK = 1e-3  # scores are whole numbers; rounding errors of bounds stay far below


def labelled_vectors(table: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id, label, v (array<double> of whole numbers, equally long), twin: usable rows, each once. ``twin`` tells
    rows of one vec_id apart."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    out = (table.where("vec_id is not null and label is not null and embedding is not null").where(fine)
           .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                   whole.alias("v")))
    size = out.agg(F.max(F.size("v"))).first()[0] or 0
    out = out.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(size) - F.size("v"))))
    return out.distinct().withColumn("twin", F.xxhash64("label", "v"))


# ---------------------------------------------------------------- summaries

def levels(size: int) -> list[int]:
    """Numbers of segments, coarse to fine; the finest has segments of two components."""
    out, n = [], FIRST
    while n < size:
        out.append(n)
        n *= 2
    return out


def summary(v: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's segment means and deviations, both times the root of the segment's width."""
    edges = np.arange(segments + 1) * v.shape[1] // segments
    width = np.diff(edges)
    total = np.add.reduceat(v, edges[:-1], axis=1)
    squares = np.add.reduceat(v * v, edges[:-1], axis=1)
    mean = total / np.sqrt(width)
    return mean, np.sqrt(np.maximum(squares - mean * mean, 0.0))


# ---------------------------------------------------------------- blocks

BLOCK = "block long, ids binary, labels binary, vectors binary, twins binary"
REACH = "block long, own array<long>, low array<double>, high array<double>, spread array<double>"


def deal_blocks(rows: DataFrame, values: int, size: int, label: str) -> tuple[DataFrame, DataFrame, int]:
    """Blocks of about ``values`` components, their reach (labels, and range of first-level means and deviations),
    and how many there are."""
    count = rows.count()
    n = max(1, math.ceil(count * max(size, 1) / values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        ids, labels, twins = (table.column(i).to_numpy() for i in (0, 1, 3))
        v = table.column(2).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        order = np.lexsort((ids, labels))
        ids, labels, v, twins = ids[order], labels[order], v[order], twins[order]
        mean, spread = summary(v, min(FIRST, max(size, 1))) if size else (np.zeros((len(ids), 1)),) * 2
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([TaskContext.get().partitionId()], pa.int64()),
            "ids": pa.array([ids.tobytes()], pa.binary()), "labels": pa.array([labels.tobytes()], pa.binary()),
            "vectors": pa.array([v.tobytes()], pa.binary()), "twins": pa.array([twins.tobytes()], pa.binary()),
            "own": pa.array([np.unique(labels).tolist()], pa.list_(pa.int64())),
            "low": pa.array([mean.min(axis=0).tolist()], pa.list_(pa.float64())),
            "high": pa.array([mean.max(axis=0).tolist()], pa.list_(pa.float64())),
            "spread": pa.array([spread.max(axis=0).tolist()], pa.list_(pa.float64()))})

    dealt = rows.repartitionByRange(n, label, "vec_id", "twin").select("vec_id", label, "v", "twin")
    blocks = materialize(dealt.mapInArrow(run, f"{BLOCK}, {REACH.split(', ', 1)[1]}"), "vector-blocks")
    return blocks.select("block", "ids", "labels", "vectors", "twins"), blocks.select(
        "block", "own", "low", "high", "spread"), n


class Rows:
    """A block's rows, and their summaries once they are needed."""

    def __init__(self, ids: bytes, labels: bytes, vectors: bytes, twins: bytes):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.twins = np.frombuffer(twins, np.int64)
        self.v = np.frombuffer(vectors, np.float64).reshape(len(self.ids), -1)
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.v, self.v))
        self.levels = [summary(self.v, n) for n in levels(self.v.shape[1])]


def candidates(anchors: Rows, rows: Rows, who: np.ndarray, at: np.ndarray, allowed: np.ndarray, least: np.ndarray,
               most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors and rows that the summaries leave of ``who`` x ``at``, their exact scores, and which of these pairs
    were left: those allowed whose bounds reach into [least, most] of the anchor."""
    slack = SLACK + 1e-9 * anchors.norm[who].max(initial=0.0) * rows.norm[at].max(initial=0.0)
    alive = allowed
    for (ma, sa), (mr, sr) in zip(anchors.levels, rows.levels):
        near, wide = alive.any(axis=1), alive.any(axis=0)
        who, at, alive = who[near], at[wide], alive[near][:, wide]
        if not alive.size:
            break
        middle, reach = ma[who] @ mr[at].T, sa[who] @ sr[at].T + slack
        alive = alive & (middle + reach >= least[who, None]) & (middle - reach <= most[who, None])
    near, wide = alive.any(axis=1), alive.any(axis=0)
    who, at, alive = who[near], at[wide], alive[near][:, wide]
    return who, at, anchors.v[who] @ rows.v[at].T, alive


def best(scores: np.ndarray, names: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's k highest finite scores, ties to the smaller name; best first in each row."""
    if scores.shape[1] > k:
        edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        r, c = np.nonzero((scores >= edge[:, None]) & np.isfinite(scores))
    else:
        r, c = np.nonzero(np.isfinite(scores))
    order = np.lexsort((names[r, c], -scores[r, c], r))
    r, c = r[order], c[order]
    rank = np.arange(len(r)) - np.searchsorted(r, r, "left")
    return r[rank < k], c[rank < k]


class Found:
    """For each of n searches the best k (score, id, twin) so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.twins = np.zeros((n, k), np.int64)

    def add(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray, twins: np.ndarray) -> None:
        """``scores`` (a row for each of ``which``, -inf for what doesn't count) of rows ``ids``."""
        r, c = best(scores, np.broadcast_to(ids, scores.shape), self.k)
        if not len(r):
            return
        rank = np.arange(len(r)) - np.searchsorted(r, r, "left")
        new = [np.full((len(which), self.k), -np.inf), np.full((len(which), self.k), np.iinfo(np.int64).max),
               np.zeros((len(which), self.k), np.int64)]
        new[0][r, rank], new[1][r, rank], new[2][r, rank] = scores[r, c], ids[c], twins[c]
        both = [np.concatenate([old[which], x], axis=1) for old, x in zip((self.scores, self.ids, self.twins), new)]
        order = np.lexsort((both[1], -both[0]), axis=1)[:, : self.k]
        for old, x in zip((self.scores, self.ids, self.twins), both):
            old[which] = np.take_along_axis(x, order, axis=1)


# ---------------------------------------------------------------- the two searches

def meet(blocks: DataFrame, asked: DataFrame, pairs: DataFrame, work, schema: str) -> DataFrame:
    """``work(rows, payload of an anchor block)`` for each pair (block, ask), where a row block is sent once for up to
    ``SHARE`` anchor blocks, which stream past it."""
    pairs = pairs.withColumn("share", F.floor(F.col("ask") / SHARE))
    none = [F.lit(None).cast("binary").alias(c) for c in asked.columns if c != "ask"]
    own = [F.lit(None).cast("binary").alias(c) for c in ("ids", "labels", "vectors", "twins")]
    held = pairs.select("block", "share").distinct().join(blocks, "block").select(
        "block", "share", F.lit(-1).cast("long").alias("ask"), "ids", "labels", "vectors", "twins", *none)
    sent = pairs.join(asked, "ask").select("block", "share", "ask", *own, *[c for c in asked.columns if c != "ask"])
    dealt = held.unionByName(sent).repartition("block", "share").sortWithinPartitions("block", "share", "ask")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = None
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column(2)[i].as_py() < 0:
                    rows = Rows(*(batch.column(c)[i].as_py() for c in range(3, 7)))
                else:
                    yield from work(rows, [batch.column(c)[i].as_py() for c in range(7, batch.num_columns)])

    return dealt.mapInArrow(run, schema)


def _positives(k: int):
    def work(rows: Rows, payload: list) -> Iterator[pa.RecordBatch]:
        anchors = Rows(*payload)
        n = len(anchors.ids)
        found = Found(n, k)
        most = np.full(n, np.inf)
        for start in range(0, len(rows.ids), CHUNK):
            at = np.arange(start, min(start + CHUNK, len(rows.ids)))
            who = np.flatnonzero(np.isin(anchors.labels, rows.labels[at]))
            allowed = (anchors.labels[who, None] == rows.labels[at]) & (anchors.ids[who, None] != rows.ids[at])
            who, at, scores, alive = candidates(anchors, rows, who, at, allowed, found.scores[:, -1], most)
            found.add(who, np.where(alive, scores, -np.inf), rows.ids[at], rows.twins[at])
        a, c = np.nonzero(np.isfinite(found.scores))
        yield pa.RecordBatch.from_pydict({
            "anchor_id": pa.array(anchors.ids[a]), "anchor_twin": pa.array(anchors.twins[a]),
            "positive_id": pa.array(found.ids[a, c]), "positive_twin": pa.array(found.twins[a, c]),
            "positive_score": pa.array(found.scores[a, c].astype(np.int64))})
    return work


def _negatives(k: int, low: int):
    def work(rows: Rows, payload: list) -> Iterator[pa.RecordBatch]:
        anchors = Rows(*payload[:4])
        owner, score, place = (np.frombuffer(x, np.int64) for x in payload[4:])
        score = score.astype(float)
        floor = np.ceil(low * score / 100)  # scores are whole numbers
        found = Found(len(owner), k)
        n = len(anchors.ids)
        most = np.full(n, -np.inf)
        np.maximum.at(most, owner, score)
        for start in range(0, len(rows.ids), CHUNK):
            at = np.arange(start, min(start + CHUNK, len(rows.ids)))
            # what any positive of an anchor still wants
            least = np.full(n, np.inf)
            np.minimum.at(least, owner, np.maximum(floor, found.scores[:, -1]))
            who = np.flatnonzero(least <= most)
            allowed = (anchors.labels[who, None] != rows.labels[at]) & (anchors.ids[who, None] != rows.ids[at])
            who, at, scores, alive = candidates(anchors, rows, who, at, allowed, least, most)
            if not scores.size:
                continue
            line = np.full(n, -1)
            line[who] = np.arange(len(who))
            mine = np.flatnonzero(line[owner] >= 0)
            for first in range(0, len(mine), CHUNK):
                part = mine[first: first + CHUNK]
                s, fits = scores[line[owner[part]]], alive[line[owner[part]]]
                fits = fits & (s >= floor[part, None]) & (s <= score[part, None])
                some = fits.any(axis=1)
                found.add(part[some], np.where(fits[some], s[some], -np.inf), rows.ids[at], rows.twins[at])
        p, c = np.nonzero(np.isfinite(found.scores))
        yield pa.RecordBatch.from_pydict({
            "anchor_id": pa.array(anchors.ids[owner[p]]), "anchor_twin": pa.array(anchors.twins[owner[p]]),
            "place": pa.array(place[p]), "positive_score": pa.array(score[p].astype(np.int64)),
            "negative_id": pa.array(found.ids[p, c]),
            "negative_score": pa.array(found.scores[p, c].astype(np.int64))})
    return work


def _reach_score(a: str, b: str):
    """The highest score that a pair of blocks can hold, from the ranges of their means and deviations."""
    corner = F.greatest(*[F.col(f"{a}.{x}")[F.col("i")] * F.col(f"{b}.{y}")[F.col("i")]
                          for x in ("low", "high") for y in ("low", "high")])
    return F.sum(corner + F.col(f"{a}.spread")[F.col("i")] * F.col(f"{b}.spread")[F.col("i")])


def find_positives(vectors: DataFrame, anchors: DataFrame, size: int, k: int, dealt=None) -> DataFrame:
    """anchor_id, anchor_twin, place, positive_id, positive_twin, positive_score."""
    blocks, reach, _ = dealt or deal_blocks(vectors, BLOCK_VALUES, size, "label")
    asked, asked_reach, _ = deal_blocks(anchors, ANCHOR_VALUES, size, "label")
    labels = reach.select("block", F.explode("own").alias("label"))
    wanted = asked_reach.select(F.col("block").alias("ask"), F.explode("own").alias("label"))
    pairs = materialize(wanted.join(labels, "label").select("block", "ask").distinct(), "block-pairs")
    payload = asked.select(F.col("block").alias("ask"), *[F.col(c).alias(f"a_{c}") for c in
                                                          ("ids", "labels", "vectors", "twins")])
    found = meet(blocks, payload, pairs, _positives(k), "anchor_id long, anchor_twin long, positive_id long, "
                                                        "positive_twin long, positive_score long")
    order = Window.partitionBy("anchor_id", "anchor_twin").orderBy(F.desc("positive_score"), "positive_id",
                                                                   "positive_twin")
    return (found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
            .withColumn("place", F.col("place").cast("long")))


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    vectors = materialize(vectors, "vectors")
    first = vectors.select(F.size("v")).first()
    size = first[0] if first else 0
    dealt = deal_blocks(vectors, BLOCK_VALUES, size, "label")
    pos = materialize(find_positives(vectors, anchors, size, positives, dealt), "positives")

    # anchor blocks with their positives: one row for each anchor, then one for each block
    per_anchor = pos.groupBy("anchor_id", "anchor_twin").agg(
        F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("wanted"))  # ``positives`` at most
    asked = anchors.join(per_anchor.select(F.col("anchor_id").alias("vec_id"), F.col("anchor_twin").alias("twin"),
                                           "wanted"), ["vec_id", "twin"])
    asked = materialize(_anchor_blocks(asked, size, low), "anchor-blocks")
    blocks, reach, n = dealt
    rows = reach.select(F.col("block").alias("number"), F.struct("low", "high", "spread").alias("r"))
    asks = asked.select("ask", "least", F.struct("low", "high", "spread").alias("a"), F.explode(F.sequence(
        F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("number"))  # a stated query set, in blocks
    pairs = (asks.join(rows, "number").select("ask", "number", "least", "a", "r", F.explode(
        F.sequence(F.lit(0), F.lit(min(FIRST, max(size, 1)) - 1))).alias("i"))
        .groupBy("ask", "number", "least").agg(_reach_score("a", "r").alias("most"))
        .where(F.col("most") + SLACK + 1e-9 * F.abs("most") >= F.col("least"))
        .select("ask", F.col("number").alias("block")))
    payload = asked.select("ask", "ids", "labels", "vectors", "twins", "owner", "score", "place").toDF(
        "ask", "a_ids", "a_labels", "a_vectors", "a_twins", "owner", "score", "place")
    found = meet(blocks, payload, materialize(pairs, "block-pairs"), _negatives(negatives, low),
                 "anchor_id long, anchor_twin long, place long, positive_score long, negative_id long, "
                 "negative_score long")
    order = Window.partitionBy("anchor_id", "anchor_twin", "place").orderBy(F.desc("negative_score"), "negative_id")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    names = pos.select("anchor_id", "anchor_twin", "place", "positive_id")
    return top.join(names, ["anchor_id", "anchor_twin", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
        "negative_score")


def _anchor_blocks(asked: DataFrame, size: int, low: int) -> DataFrame:
    """Blocks of anchors (vec_id, label, v, twin, wanted): as row blocks, with the anchors' positives and the least
    score that any of these lets through."""
    schema = ("ask long, ids binary, labels binary, vectors binary, twins binary, owner binary, score binary, "
              "place binary, least double, low array<double>, high array<double>, spread array<double>")
    n = max(1, math.ceil(asked.count() * max(size, 1) / ANCHOR_VALUES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        ids, labels, twins = (table.column(i).to_numpy() for i in (0, 1, 3))
        v = table.column(2).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        wanted = table.column(4).to_pylist()
        owner = np.repeat(np.arange(len(ids)), [len(w) for w in wanted])
        place = np.array([x["place"] for w in wanted for x in w], np.int64)
        score = np.array([x["positive_score"] for w in wanted for x in w], np.int64)
        positive = score[score >= 0]
        mean, spread = summary(v, min(FIRST, max(size, 1))) if size else (np.zeros((len(ids), 1)),) * 2
        yield pa.RecordBatch.from_arrays([
            pa.array([TaskContext.get().partitionId()], pa.int64()),
            *[pa.array([x.tobytes()], pa.binary()) for x in (ids, labels, v, twins, owner.astype(np.int64), score, place)],
            pa.array([float(positive.min()) * low / 100 if len(positive) else math.inf], pa.float64()),
            *[pa.array([x.tolist()], pa.list_(pa.float64())) for x in (mean.min(axis=0), mean.max(axis=0),
                                                                       spread.max(axis=0))]],
            names=[x.split()[0] for x in schema.split(", ")])

    return asked.repartitionByRange(n, "label", "vec_id", "twin").select(
        "vec_id", "label", "v", "twin", "wanted").mapInArrow(run, schema)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    table = table.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
                             .otherwise(F.col("label")))
    vectors = materialize(labelled_vectors(table), "labelled-vectors")
    return mine(vectors, vectors.where("vec_id % 100 = 0"))


ORACLE = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score
    AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
