"""Exact top-k search: best-first search in M-trees of bounded size, for a stated query set in blocks.

Vectors are integers floor(scale * x); the score is their inner product. Rows are dealt into trees of about ``TREE_ROWS``
rows, by the nearest of ``PIVOTS`` rows picked by hash, then by norm (equal norms by vec_id, so copies can't fill one; the
picked rows only choose a row's tree). A tree has pages: inner pages hold routing
vectors with covering radius, largest norm and distance to the page's own routing vector, leaf pages hold rows with
their distance to it. For a query q at a page with routing vector p, d(q, p) is known, so the stored distance alone gives
d(q, x) >= |d(q, p) - d(x, p)| (less x's radius), and with q.v = (|q|^2 + |v|^2 - d(q, v)^2) / 2 a bound on the score of
all below x. Only entries that this bound leaves are computed; then the nearer bounds q.x + |q| radius and |q| norm
apply. Pages are visited in order of their bounds until the best bound is under the query's k-th score.

Each query starts with the k-th score of a bounded set of rows, the ``SEEDS`` of largest norm; it only prunes, and all
of the rows are in some tree. Trees are written as a table of one row each, with the tree's mean, covering radius and
largest norm in columns of their own. Queries go in blocks of ``BLOCK`` neighbours. Blocks first meet the trees' summaries,
``CHUNK`` of them in a row, and for each tree only the queries whose bound reaches their start value go on; these are
joined to the tree's pages, and a query's best rows of all trees are ranked.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do rows without vec_id;
exactly repeated rows count once; a query's candidates are all rows of other vec_id; ties go to the smaller vec_id;
shorter vectors count as filled up with zeros; empty tables give no rows; other columns are not read. Scores have to be
under 2**53, where sums of doubles are exact.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, read_table

TREE_ROWS = 4096
PAGE = 64  # rows of a leaf page
FAN = 16  # entries of an inner page
BLOCK = 256
SEEDS = 1024
PIVOTS = 256
CHUNK = 1024  # summaries of trees in a row
BROADCAST_BYTES = 16 << 20  # of all summaries
SLACK = 1e-3  # scores are integers, so rounding errors of bounds stay far below


def integer_vectors(table: DataFrame, scale: float = 64.0) -> DataFrame:
    """vec_id, v (array<double> of whole numbers), norm: usable rows, each once."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    out = (table.where("vec_id is not null and embedding is not null").where(fine)
           .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")).distinct())
    return out.withColumn("norm", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))


def matrix(vectors: list) -> np.ndarray:
    wide = max((len(x) for x in vectors), default=0)
    out = np.zeros((len(vectors), wide))
    for i, x in enumerate(vectors):
        out[i, : len(x)] = x
    return out


def widened(x: np.ndarray, wide: int) -> np.ndarray:
    return x if x.shape[1] >= wide else np.pad(x, ((0, 0), (0, wide - x.shape[1])))


class Tree:
    """Pages of a bulk-loaded M-tree. Inner page: (True, entries' numbers, routing vectors, radius, largest squared
    norm, distance to the page's routing vector); leaf page: (False, ids, vectors, squared norms, distance)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.pages: list[tuple] = []
        self.wide = vectors.shape[1]
        self.norms = np.einsum("ij,ij->i", vectors, vectors)
        self.centre = vectors[0] if len(ids) else np.zeros(self.wide)
        self.root = self._build(ids, vectors, self.norms, self.centre)
        self.most = float(self.norms.max(initial=0.0))
        del self.norms

    def _build(self, ids, vectors, norms, centre) -> int:
        if len(ids) <= PAGE:
            self.pages.append((False, ids, vectors, norms, np.sqrt(((vectors - centre) ** 2).sum(axis=1))))
            return len(self.pages) - 1
        fan = min(FAN, math.ceil(len(ids) / PAGE) + 1)
        routing = vectors[np.linspace(0, len(ids) - 1, fan).astype(int)]
        far = norms[:, None] - 2 * (vectors @ routing.T) + np.einsum("ij,ij->i", routing, routing)[None, :]
        side = far.argmin(axis=1)
        sizes = np.bincount(side, minlength=fan)
        if sizes.max() > 0.7 * len(ids):  # many copies or one dense spot: equal parts in order of distance
            order = np.lexsort((ids, far[:, sizes.argmax()]))
            side = np.empty(len(ids), int)
            side[order] = np.arange(len(ids)) * fan // len(ids)
            sizes = np.bincount(side, minlength=fan)
            routing = np.array([vectors[order[len(ids) * i // fan]] for i in range(fan)])
        numbers, own, radius, most = [], [], [], []
        for i in np.flatnonzero(sizes):
            rows = np.flatnonzero(side == i)
            numbers.append(self._build(ids[rows], vectors[rows], norms[rows], routing[i]))
            own.append(routing[i])
            radius.append(math.sqrt(((vectors[rows] - routing[i]) ** 2).sum(axis=1).max()))
            most.append(norms[rows].max())
        own = np.array(own)
        self.pages.append((True, np.array(numbers), own, np.array(radius), np.array(most),
                           np.sqrt(((own - centre) ** 2).sum(axis=1))))
        return len(self.pages) - 1

    def search(self, q: np.ndarray, own: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query of a block (a row of q), ids and scores of its best k rows other than its own, best first
        (score -inf where there are fewer), among those of at least ``least``. Pages are visited in order of the best
        bound that any query of the block has; on a page only the queries that need it are computed."""
        n, least = len(q), least.copy()
        qq = np.einsum("ij,ij->i", q, q)
        size = np.sqrt(qq)
        slack = SLACK + 1e-9 * (qq + self.most)  # rounding errors of the bounds stay far below
        ids, scores = np.full((n, k), np.iinfo(np.int64).max), np.full((n, k), -np.inf)
        rows = np.flatnonzero(size * math.sqrt(self.most) >= least - slack)
        queue: list[tuple] = []
        if len(rows):
            d = np.sqrt(((q[rows] - self.centre) ** 2).sum(axis=1))
            queue.append((-math.inf, 0, self.root, rows, d, np.full(len(rows), np.inf)))
        turn = 1
        while queue:
            _, _, number, rows, d, bound = heapq.heappop(queue)
            keep = bound >= least[rows] - slack[rows]
            rows, d = rows[keep], d[keep]
            if not len(rows):
                continue
            page = self.pages[number]
            need = (least[rows] - slack[rows])[:, None]
            if page[0]:
                _, numbers, routing, radius, most, stored = page
                gap = np.maximum(np.abs(d[:, None] - stored) - radius, 0.0)
                alive = (qq[rows, None] + most - gap * gap) / 2 >= need
                left = np.flatnonzero(alive.any(axis=0))
                if not len(left):
                    continue
                x, r, m = routing[left], radius[left], most[left]
                dots = q[rows] @ x.T
                far = np.sqrt(np.maximum(qq[rows, None] - 2 * dots + np.einsum("ij,ij->i", x, x), 0.0))
                gap = np.maximum(far - r, 0.0)
                best = np.minimum(np.minimum(dots + size[rows, None] * r, size[rows, None] * np.sqrt(m)),
                                  (qq[rows, None] + m - gap * gap) / 2)
                alive = alive[:, left] & (best >= need)
                for c in np.flatnonzero(alive.any(axis=0)).tolist():
                    own_rows = np.flatnonzero(alive[:, c])
                    value = best[own_rows, c]
                    heapq.heappush(queue, (-float(value.max()), turn, int(numbers[left[c]]), rows[own_rows],
                                           far[own_rows, c], value))
                    turn += 1
            else:
                _, names, vectors, norms, stored = page
                gap = d[:, None] - stored
                alive = (qq[rows, None] + norms - gap * gap) / 2 >= need
                left = np.flatnonzero(alive.any(axis=0))
                if not len(left):
                    continue
                got = q[rows] @ vectors[left].T
                got[names[left][None, :] == own[rows, None]] = -np.inf
                better = np.flatnonzero((got >= least[rows, None]).any(axis=1))
                if not len(better):
                    continue
                rows, got = rows[better], got[better]
                both = np.concatenate([scores[rows], got], axis=1)
                name = np.concatenate([ids[rows], np.broadcast_to(names[left], got.shape)], axis=1)
                order = np.lexsort((name, -both), axis=1)[:, :k]
                scores[rows] = np.take_along_axis(both, order, axis=1)
                ids[rows] = np.take_along_axis(name, order, axis=1)
                least[rows] = np.maximum(least[rows], scores[rows, -1])
        return ids, scores


def packed(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, np.float64).tobytes()


def unpacked(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(rows, -1)


def arrays(column: pa.Array) -> list[np.ndarray]:
    return [x.values.to_numpy(zero_copy_only=False) for x in column]


def picked_rows(vectors: DataFrame, count: int) -> np.ndarray:
    """``count`` rows at most, by a hash of vec_id."""
    return matrix([r[0] for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").select("v").limit(count).collect()])


def with_region(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """vec_id, v, norm, region: the nearest pivot's number."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)  # PIVOTS vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            v = matrix(arrays(batch.column(1)))
            wide = max(v.shape[1], pivots.shape[1])
            p = widened(pivots, wide)
            far = np.einsum("ij,ij->i", p, p)[None, :] - 2 * (widened(v, wide) @ p.T)
            near = far.argmin(axis=1) if len(p) else np.zeros(len(v), int)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int64())], ["vec_id", "v", "norm", "region"])

    return (vectors.select("vec_id", "v", "norm")
            .mapInArrow(run, "vec_id long, v array<double>, norm double, region long"))


def build_trees(vectors: DataFrame, trees: int, pivots: np.ndarray) -> DataFrame:
    """tree, rows, mean, radius, most, pages: one M-tree for each range of (region, norm), with its summary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            rows += arrays(batch.column(1))
        if ids:
            v = matrix(rows)
            tree, mean = Tree(np.array(ids, np.int64), v), v.mean(axis=0)
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([TaskContext.get().partitionId()], pa.int64()), "rows": pa.array([len(ids)], pa.int64()),
                "mean": pa.array([packed(mean)], pa.binary()),
                "radius": pa.array([math.sqrt(((v - mean) ** 2).sum(axis=1).max())]),
                "most": pa.array([tree.most]), "pages": pa.array([pickle.dumps(tree, protocol=5)], pa.binary())})

    dealt = with_region(vectors, pivots).repartitionByRange(trees, "region", "norm", "vec_id").select("vec_id", "v")
    return materialize(dealt.mapInArrow(run, "tree long, rows long, mean binary, radius double, most double, pages binary"),
                       "m-trees")


ASKED = "ids binary, queries binary, least binary"  # of a block: int64, rows of doubles, doubles


def asked_batch(ids: np.ndarray, q: np.ndarray, least: np.ndarray, **more: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({**{c: pa.array([x], pa.int64()) for c, x in more.items()},
                                       "ids": pa.array([ids.tobytes()], pa.binary()),
                                       "queries": pa.array([packed(q)], pa.binary()),
                                       "least": pa.array([packed(least)], pa.binary())})


def query_blocks(vectors: DataFrame, queries: DataFrame, k: int, pivots: np.ndarray) -> DataFrame:
    """ids, queries, least: blocks of at most ``BLOCK`` neighbouring queries, with the k-th score among the seeds."""
    top = vectors.orderBy(F.desc("norm"), "vec_id", "v").limit(SEEDS).select("vec_id", "v").collect()
    seeds = vectors.sparkSession.sparkContext.broadcast((np.array([r[0] for r in top], np.int64),
                                                         matrix([r[1] for r in top])))

    def block(ids: list, rows: list) -> pa.RecordBatch:
        seed_ids, seed_rows = seeds.value
        own, q = np.array(ids, np.int64), matrix(rows)
        wide = max(q.shape[1], seed_rows.shape[1])
        s = widened(seed_rows, wide) @ widened(q, wide).T
        s[seed_ids[:, None] == own[None, :]] = -np.inf
        least = np.partition(s, len(s) - k, axis=0)[len(s) - k] if len(s) >= k else np.full(len(own), -np.inf)
        return asked_batch(own, q, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            rows += arrays(batch.column(1))
            while len(ids) >= BLOCK:
                yield block(ids[:BLOCK], rows[:BLOCK])
                ids, rows = ids[BLOCK:], rows[BLOCK:]
        if ids:
            yield block(ids, rows)

    parts = max(1, math.ceil(queries.count() / (2 * BLOCK)))
    return (with_region(queries, pivots).repartitionByRange(parts, "region", "norm", "vec_id")
            .sortWithinPartitions("region", "norm", "vec_id").select("vec_id", "v").mapInArrow(run, ASKED))


def wanted_trees(blocks: DataFrame, trees: DataFrame) -> DataFrame:
    """tree, ids, queries, least: of each block the queries whose bound at the tree reaches their least score."""
    chunk = F.floor(F.col("tree") / CHUNK).alias("chunk")
    last, size = trees.agg(F.max(chunk), F.sum(F.length("mean") + 24)).first()
    summaries = (trees.groupBy(chunk)
                 .agg(F.collect_list(F.struct("tree", "mean", "radius", "most")).alias("trees")))  # CHUNK at most
    if (size or 0) <= BROADCAST_BYTES:
        summaries = F.broadcast(summaries)
    met = blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last or 0).cast("long"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column(0)[i].as_py(), np.int64)
                q, least = unpacked(batch.column(1)[i].as_py(), len(ids)), unpacked(batch.column(2)[i].as_py(), len(ids))[:, 0]
                trees = batch.column(3)[i].values
                numbers = trees.field(0).to_numpy()
                means = matrix([np.frombuffer(x.as_py(), np.float64) for x in trees.field(1)])
                radius, most = trees.field(2).to_numpy(), trees.field(3).to_numpy()
                wide = max(q.shape[1], means.shape[1])
                qq = np.einsum("ij,ij->i", q, q)[:, None]
                size = np.sqrt(qq)
                bound = np.minimum(widened(q, wide) @ widened(means, wide).T + size * radius, size * np.sqrt(most))
                alive = bound >= least[:, None] - SLACK - 1e-9 * (qq + most)
                for t in np.flatnonzero(alive.any(axis=0)).tolist():
                    own = np.flatnonzero(alive[:, t])
                    yield asked_batch(ids[own], q[own], least[own], tree=int(numbers[t]))

    return (met.join(summaries, "chunk").select("ids", "queries", "least", "trees")
            .mapInArrow(run, f"tree long, {ASKED}"))


def search(vectors: DataFrame, queries: DataFrame, k: int, tree_rows: int = TREE_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` for each row of ``queries``."""
    vectors = materialize(vectors, "vectors")
    count = max(1, math.ceil(vectors.count() / tree_rows))
    pivots = picked_rows(vectors, max(1, min(PIVOTS, count // 4)))  # about four shells of norms or more in a region
    trees = build_trees(vectors, count, pivots)
    wanted = wanted_trees(query_blocks(vectors, queries, k, pivots), trees)
    pairs = wanted.join(trees.select("tree", "pages"), "tree").select("tree", "pages", "ids", "queries", "least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tree = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                number, pages, own, q, least = (c[i].as_py() for c in batch.columns)
                if number != last:
                    last, tree = number, pickle.loads(pages)
                own = np.frombuffer(own, np.int64)
                q, least = unpacked(q, len(own)), unpacked(least, len(own))[:, 0]
                q = widened(q, tree.wide)[:, : tree.wide]  # what the tree's vectors lack counts as 0
                ids, scores = tree.search(q, own, k, least)
                j, at = np.nonzero(scores >= np.where(np.isfinite(least), least, -1e300)[:, None])
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(own[j]), "vec_id": pa.array(ids[j, at]),
                                                  "score": pa.array(scores[j, at].astype(np.int64))})

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op3_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(read_table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.where("vec_id % 20 = 0"), 20)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
    vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""
