"""MinHash near-dedup by an LSH forest.

A document's set holds its distinct shingles of words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased); texts with equal
sets form a class, and only classes go on, each under a number of its own. A signature has ``TREES`` blocks of 8 minima; each block is the head of one
sorted order of all signatures, so the forest has one order (tree) for each block.

* Regions. A region of a tree is a common prefix of its order. Its depth adapts to its population: 3 minima, one more
  where over ``CROWDED[0]`` classes share them, and another one where over ``CROWDED[1]`` do. Classes of a region that
  was split so also meet in ``TREES`` further trees, each of 5 minima from four blocks, so that crowding loses no pairs.
* First candidates. In each region, every class meets its neighbours of longest common prefix (the next one in the sorted
  order) and the class that agrees best with the region's most frequent minima. That is at most two pairs for each
  class and tree, whatever the region's size.
* Links are confirmed on full sets, and linked classes joined to components.
* The rest. Pairs of one region that are still in different components are all compared too, so nothing is lost to
  the first step's limit. Classes with a likely partner are sent, with their full sets, to their region's task, which
  counts common shingles over postings and returns links that join something new: at most one for each class, never the
  pairs themselves. Regions of over ``CHUNK`` classes go in blocks, one task for each pair of blocks; the blocks of the
  region's largest component meet only those of the others, so a region that one group of copies fills stays linear.

Pairs whose signatures agree in so few minima that a pair at the threshold has as few or fewer with probability ``LOSS``
at most (exact binomial tail), or whose set sizes alone exclude a link, are no candidates. A pair of similarity 0.8 shares
no region of depth 3 in 16 trees with probability 1e-5, and none of depth 5 in those and the further ones with 1.2e-5.

Defined cases: texts without words are linked with nothing and keep themselves; documents of fewer words than a shingle
have their whole sequence as one; null doc_id is kept apart (component null, kept); rows of one doc_id are one document,
whose texts each have their own set and whose links are those of all its texts, but each row is returned; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, read_table
from . import textnp as T
from .components import components

TREES = 16
BLOCK = 8  # minima of a tree's block
MINIMA = TREES * BLOCK
CROWDED = (32, 256)
CHUNK = 2048  # classes of a region that one task compares
BROADCAST_IDS = 500_000
LOSS = 3e-6  # of links, by the signature test
SLICE = 1 << 19
#: The minima of a further tree, from the first of its block on: those that no tree's prefix uses, and one of each of two
#: other blocks.
FURTHER = (5, 6, 7, 3 * BLOCK + 3, 7 * BLOCK + 4)

_SEEDS = T.mix(np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D)) | np.uint64(1)


def shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text of a slice, ordered by row and hash, and their rows."""
    data, ends = T.raw_bytes(texts)
    s, e, upto = T.words(data, ends)
    h = T.word_hashes(data, s, e, lower=True)
    n = np.diff(np.r_[0, upto])
    many = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    first = np.cumsum(many) - many
    row = np.repeat(np.arange(len(n)), many)
    start = np.arange(many.sum()) - np.repeat(first, many) + np.repeat(upto - n, many)
    stop = start + np.minimum(words, n[row])
    found = T.span_hash(h, start, stop)
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    new = np.r_[True, (np.diff(row) != 0) | (found[1:] != found[:-1])] if len(row) else np.zeros(0, bool)
    return found[new], row[new]


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, spot (names the row by doc_id and text), n_shingles, s1, s2 (128 bits that name the set), sig (a byte of
    each minimum), keys (for each tree, the prefixes of 3, 4 and 5 minima; then the further trees' keys); sig and keys
    are null for empty sets."""
    schema = "doc_id long, spot long, n_shingles long, s1 long, s2 long, sig binary, keys array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in T.slices(batch.column(2), SLICE):
                found, row = shingles(batch.column(2).slice(a, b - a), words)
                n = np.bincount(row, minlength=b - a)
                full = np.flatnonzero(n)
                at = np.flatnonzero(np.r_[True, np.diff(row) != 0]) if len(row) else np.zeros(0, int)
                names = set_names(found, row, b - a)
                minima = np.zeros((len(full), MINIMA), np.uint32)
                if len(full):
                    for i, seed in enumerate(_SEEDS):
                        minima[:, i] = np.minimum.reduceat(found * seed, at) >> np.uint64(32)
                keys = prefixes(minima)
                sig = [None] * (b - a)
                lists: list = [None] * (b - a)
                for j, i in enumerate(full.tolist()):
                    sig[i] = minima[j].astype(np.uint8).tobytes()
                    lists[i] = keys[j]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(n, pa.int64()),
                     pa.array(names[0]), pa.array(names[1]), pa.array(sig, pa.binary()),
                     pa.array(lists, pa.list_(pa.int64()))],
                    ["doc_id", "spot", "n_shingles", "s1", "s2", "sig", "keys"])

    return _spotted(docs).select("doc_id", "spot", "text").mapInArrow(run, schema)


def _spotted(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.withColumn("spot", F.xxhash64("doc_id", "text"))


def set_names(found: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """128 bits that name each row's set, as two rows of longs; 0 for an empty set."""
    out = np.zeros((2, rows), np.uint64)
    if len(row):
        at = np.flatnonzero(np.r_[True, np.diff(row) != 0])
        out[0, row[at]] = np.add.reduceat(found, at)
        out[1, row[at]] = np.add.reduceat(T.mix(found ^ np.uint64(0x9FB21C651E98DF25)), at)
    return out.view(np.int64)


def prefixes(minima: np.ndarray) -> np.ndarray:
    """For each row, 3 x TREES keys: tree 0's prefixes of 3, 4 and 5 minima, then tree 1's, and so on; then one key for
    each of TREES further trees."""
    out = np.zeros((len(minima), 4 * TREES), np.uint64)
    for t in range(2 * TREES):
        h = np.full(len(minima), t + 1, np.uint64)
        places = range(5) if t < TREES else FURTHER
        for i, place in enumerate(places):
            h = T.mix(h ^ T.mix(minima[:, (BLOCK * t + place) % MINIMA].astype(np.uint64) + np.uint64((i + 1) << 40)))
            if t < TREES and i >= 2:
                out[:, 3 * t + i - 2] = h
        if t >= TREES:
            out[:, 2 * TREES + t] = h
    return out.view(np.int64)


def regions(classes: DataFrame) -> DataFrame:
    """tree, key, size, cls: the classes of each region with at least two; the key tells depth and tree."""
    rows = (classes.select("cls", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.slice("keys", t * 3 + 1, 3))).alias("tree", "k"))
        .select("cls", "tree", F.col("k")[0].alias("k0"), F.col("k")[1].alias("k1"), F.col("k")[2].alias("k2")))
    out = crowded = None
    for depth in range(3):
        key = f"k{depth}"
        sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        rows = materialize(rows.join(sizes, key), f"forest-{depth + 3}")
        last = depth == 2
        done = (rows if last else rows.where(F.col("size") <= CROWDED[depth])).select(
            "tree", F.col(key).alias("key"), "size", "cls")
        out = done if out is None else out.unionByName(done)
        if not last:
            rows = rows.where(F.col("size") > CROWDED[depth]).drop("size")
        if depth == 0:
            crowded = rows.select("cls").distinct()
    more = (classes.join(crowded, "cls", "left_semi")
            .select("cls", F.posexplode(F.slice("keys", 3 * TREES + 1, TREES)).alias("tree", "key"))
            .withColumn("tree", F.col("tree") + TREES))
    sizes = more.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return out.unionByName(materialize(more.join(sizes, "key"), "forest-further").select("tree", "key", "size", "cls"))


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """The rows of each run of equal first ``keys`` columns, as arrays; runs may go on in the next batch."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        columns = [table.column(i).to_numpy() for i in range(table.num_columns)]
        if not table.num_rows:
            continue
        change = np.zeros(table.num_rows, bool)
        for c in columns[:keys]:
            change[1:] |= c[1:] != c[:-1]
        at = np.r_[0, np.flatnonzero(change), table.num_rows]
        for a, b in zip(at[:-2], at[1:-1], strict=True):
            if b - a > 1:
                yield [c[a:b] for c in columns]
        rest = table.slice(at[-2]).combine_chunks()
    if rest is not None and rest.num_rows > 1:
        yield [rest.column(i).to_numpy() for i in range(rest.num_columns)]


def _matrix(sigs: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(sigs.tolist()), np.uint8).reshape(len(sigs), MINIMA)


def first_candidates(members: DataFrame, percent: int) -> DataFrame:
    """a, b: each class with its next one in the tree's order, and with the one nearest to the region's consensus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for _, _, tree, cls, n, sigs in _runs(batches, 2):
            sig = _matrix(sigs)
            m = len(cls)
            if m == 2:
                pairs = np.array([[0, 1]])
            else:
                turned = np.ascontiguousarray(np.roll(sig, -BLOCK * int(tree[0]), axis=1))
                order = np.argsort(turned.view(f"S{MINIMA}").ravel(), kind="stable")
                votes = np.zeros((MINIMA, 256), np.int32)
                np.add.at(votes, (np.arange(MINIMA)[None, :].repeat(m, axis=0), sig), 1)
                lead = int(votes[np.arange(MINIMA)[None, :], sig].sum(axis=1).argmax())
                others = np.delete(np.arange(m), lead)
                pairs = np.concatenate([np.c_[order[:-1], order[1:]], np.c_[np.full(m - 1, lead), others]])
            keep = likely(sig, n, pairs, percent)
            a += cls[pairs[keep, 0]].tolist()
            b += cls[pairs[keep, 1]].tolist()
            if len(a) > 20_000:
                yield _pairs(a, b)
                a, b = [], []
        yield _pairs(a, b)

    return members.mapInArrow(run, "a long, b long").distinct()


@cache
def least_equal(percent: int) -> int:
    """The largest k such that a pair at the threshold has fewer than k equal minima with probability LOSS at most."""
    p, below, k = percent / 100, 0.0, 0
    while (below := below + comb(MINIMA, k) * p**k * (1 - p) ** (MINIMA - k)) <= LOSS:
        k += 1
    return k


def likely(sig: np.ndarray, n: np.ndarray, pairs: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs agree in enough minima and have set sizes that allow a link."""
    i, j = pairs[:, 0], pairs[:, 1]
    same = (sig[i] == sig[j]).sum(axis=1) >= least_equal(percent)
    return same & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))


def _pairs(a: list, b: list, names: tuple[str, str] = ("a", "b")) -> pa.RecordBatch:
    x, y = np.array(a, np.int64), np.array(b, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], list(names))


def members_left(members: DataFrame, percent: int) -> DataFrame:
    """key, i, j, cls: the classes of a region (or of two of its blocks) with a likely partner in another component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, first, second, cls, n, sigs, part, side in _runs(batches, 3):
            parts, sig = np.unique(part, return_inverse=True)[1], _matrix(sigs)
            if parts.max() == 0:
                continue
            active = np.zeros(len(cls), bool)
            for i in range(len(cls)):
                j = np.flatnonzero(_apart(parts, side, i)) + i + 1
                if len(j):
                    j = j[likely(sig, n, np.c_[np.full(len(j), i), j], percent)]
                    active[j] = True
                    active[i] |= len(j) > 0
            if active.any():
                m = int(active.sum())
                yield pa.RecordBatch.from_pydict({"key": key[:m], "i": first[:m], "j": second[:m], "cls": cls[active]})

    return members.mapInArrow(run, "key long, i long, j long, cls long")


def _apart(parts: np.ndarray, side: np.ndarray, i: int) -> np.ndarray:
    """Which of the rows after i are in another component; of two blocks, only pairs between them count (those within
    one are another task's)."""
    out = parts[i + 1:] != parts[i]
    return out & (side[i + 1:] != side[i]) if side.max() != side.min() else out


def region_links(members: DataFrame, percent: int) -> DataFrame:
    """u, v: links between different components that the full sets of each region's members give; of links that join
    the same components only the first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, cls, part, side, packed in _runs(batches, 3):
            parts = np.unique(part, return_inverse=True)[1]
            sets = [_numbers(x) for x in packed]
            n = np.array([len(x) for x in sets])
            ids, item = np.unique(np.concatenate(sets), return_inverse=True)
            owner = np.repeat(np.arange(len(sets)), n)
            posting = owner[np.argsort(item, kind="stable")]
            upto = np.r_[0, np.cumsum(np.bincount(item, minlength=len(ids)))]
            begin = np.r_[0, np.cumsum(n)]
            found: list[tuple[int, int]] = []
            for i in range(len(sets) - 1):
                e = item[begin[i]: begin[i + 1]]
                size = upto[e + 1] - upto[e]
                at = np.repeat(upto[e] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
                common = np.bincount(posting[at], minlength=len(sets))[i + 1:]
                good = (100 * common >= percent * (n[i] + n[i + 1:] - common)) & _apart(parts, side, i)
                for j in (np.flatnonzero(good) + i + 1).tolist():
                    if parts[j] != parts[i]:
                        found.append((i, j))
                        parts[parts == parts[j]] = parts[i]
            if found:
                x, y = np.array(found).T
                yield _pairs(cls[x].tolist(), cls[y].tolist(), ("u", "v"))

    return materialize(members.mapInArrow(run, "u long, v long"), "links")


def _numbers(packed: bytes) -> np.ndarray:
    """The sorted 48-bit numbers of a set."""
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def full_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """cls, set: the shingle set of each class in ``wanted``, as sorted 48-bit hashes, read from one of its texts. The
    names of up to ``BROADCAST_IDS`` such texts are broadcast; more of them join by a shuffle."""
    wanted = materialize(classes.join(wanted.distinct(), "cls", "left_semi").select("spot", "cls", "s1", "s2"), "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    own = _spotted(docs).select("spot", "text").join(wanted, "spot").select("cls", "s1", "s2", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in T.slices(batch.column(3), SLICE):
                part = batch.slice(a, b - a)
                found, row = shingles(part.column(3), words)
                names = set_names(found, row, b - a)
                right = (part.column(1).to_numpy() == names[0]) & (part.column(2).to_numpy() == names[1])
                at = np.searchsorted(row, np.arange(b - a + 1))
                six = np.ascontiguousarray((found >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6])
                yield pa.RecordBatch.from_pydict({
                    "cls": part.column(0),
                    "set": pa.array([six[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                }).filter(pa.array(right))

    return materialize(own.mapInArrow(run, "cls long, set binary").dropDuplicates(["cls"]), "sets")


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """u, v: the pairs whose full sets have a similarity of at least ``percent``."""
    wanted = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls")))
    known = full_sets(docs, classes, wanted, words)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                both = np.concatenate([_numbers(x.as_buffer()), _numbers(y.as_buffer())])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(
                pa.array(keep, pa.bool_()))

    both = (pairs.join(known.select(F.col("cls").alias("a"), F.col("set").alias("x")), "a")
            .join(known.select(F.col("cls").alias("b"), F.col("set").alias("y")), "b").select("a", "b", "x", "y"))
    return materialize(both.mapInArrow(compare, "u long, v long"), "links")


def same_document(signed: DataFrame, classes: DataFrame) -> DataFrame | None:
    """u, v: links between the classes of a doc_id that has several; None if there is no such doc_id."""
    filled = signed.where("n_shingles > 0 and doc_id is not null").select("doc_id", "n_shingles", "s1", "s2")
    several = materialize(filled.groupBy("doc_id").agg(
        *[f(c).alias(f"{c}_{f.__name__}") for c in ("n_shingles", "s1", "s2") for f in (F.min, F.max)])
        .where(" or ".join(f"{c}_min <> {c}_max" for c in ("n_shingles", "s1", "s2"))).select("doc_id"), "several")
    if several.isEmpty():
        return None
    texts = materialize(filled.join(several, "doc_id").distinct().join(
        classes.select("n_shingles", "s1", "s2", "cls"), ["n_shingles", "s1", "s2"]).select("doc_id", "cls"), "several-texts")
    least = texts.groupBy("doc_id").agg(F.min("cls").alias("v"))
    return texts.join(least, "doc_id").select(F.col("cls").alias("u"), "v").where("u <> v")


def block_pairs(placed: DataFrame) -> DataFrame:
    """``placed`` with block, i and j: a row for each pair of blocks (a task) that a class of a region takes part in.
    Blocks of a large region's largest component come first and meet only the other blocks."""
    zero = F.lit(0).cast("long")
    large = F.col("size") > CHUNK
    lead = (placed.where(large).groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("key").agg(F.max(F.struct("n", "part")).alias("lead")))
    placed = placed.join(lead, "key", "left")
    first = F.ceil(F.col("lead.n") / CHUNK).cast("long")
    rest = F.ceil((F.col("size") - F.col("lead.n")) / CHUNK).cast("long")
    placed = placed.withColumn("first", F.coalesce(first, zero)).withColumn("rest", F.coalesce(rest, zero))
    leads = F.col("part") == F.col("lead.part")
    block = F.when(leads, F.pmod(F.xxhash64("cls"), F.col("first"))).otherwise(
        F.col("first") + F.pmod(F.xxhash64("cls"), F.col("rest")))
    placed = placed.withColumn("block", F.when(large, block).otherwise(zero)).withColumn(
        "other", F.explode(F.when(~large, F.array(zero)).when(
            leads, F.sequence(F.col("first"), F.col("first") + F.col("rest") - 1)).otherwise(
            F.sequence(zero, F.col("first") + F.col("rest") - 1))))
    return placed.select("*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def group(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    signed = materialize(signatures(docs, words), "signatures")
    by_set = ["n_shingles", "s1", "s2"]
    classes = materialize(
        signed.where("n_shingles > 0 and doc_id is not null").groupBy(*by_set)
        .agg(F.min(F.struct("doc_id", "spot")).alias("least"), F.first("sig").alias("sig"), F.first("keys").alias("keys"))
        .select(F.monotonically_increasing_id().alias("cls"), *by_set, "least.doc_id", "least.spot", "sig", "keys"),
        "classes")
    spots = regions(classes)
    signs = classes.select("cls", "n_shingles", "sig")
    chunk = F.when(F.col("size") > CHUNK, F.pmod(F.xxhash64("cls", "tree"), F.ceil(F.col("size") / CHUNK))).otherwise(0)
    members = materialize(spots.join(signs, "cls").withColumn("chunk", chunk.cast("long")), "members")
    near = first_candidates(members.repartition("key", "chunk").sortWithinPartitions("key", "chunk")
                            .select("key", "chunk", "tree", "cls", "n_shingles", "sig"), percent)
    tried = materialize(near, "candidates")
    links = confirmed(tried, docs, classes, words, percent)
    same = same_document(signed, classes)
    if same is not None:
        links = materialize(links.unionByName(same), "links")
    parts = components(links)

    placed = members.drop("chunk").join(parts.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "part", F.coalesce("component", "cls")).drop("component")
    mixed = placed.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("key")
    placed = block_pairs(materialize(placed.join(mixed, "key"), "mixed"))
    by_task = ["key", "i", "j"]
    left = materialize(members_left(
        placed.select(*by_task, "cls", "n_shingles", "sig", "part", "block").repartition(*by_task)
        .sortWithinPartitions(*by_task), percent), "members-left")
    known = full_sets(docs, classes, left.select("cls"), words)
    places = placed.select(*by_task, "cls", "part", "block")
    found = region_links(left.join(places, [*by_task, "cls"]).join(known, "cls")
                         .select(*by_task, "cls", "part", "block", "set").repartition(*by_task)
                         .sortWithinPartitions(*by_task, "cls"), percent)
    links = links.unionByName(found)
    parts = components(links)

    named = classes.select(*by_set, "cls", "doc_id").join(parts.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.withColumn("part", F.coalesce("component", "cls"))
    least = named.groupBy("part").agg(F.min("doc_id").alias("least"))
    by_class = named.join(least, "part").select(*by_set, F.col("least").alias("component"))
    known = signed.select("doc_id", *by_set).join(by_class, by_set, "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return (known.select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that a group's least doc_id stands for; columns stay. Rows that repeat a doc_id
    stay or go together."""
    gone = group(docs, words, percent).where("not kept").select("doc_id").distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    left = row.join(gone, F.col("row.doc_id").cast("long") == F.col("doc_id"), "left_anti")
    return left.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(read_table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: All pairs by their common shingles, and the closure of the links.
ORACLE = rf"""
WITH RECURSIVE d AS (SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(generate_series(1, len(w) - 2),
    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS x FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY ALL),
e AS (SELECT u, v FROM c JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 85 * (x.n + y.n - k)),
r AS (SELECT doc_id AS node, doc_id AS root FROM d UNION SELECT v, root FROM r JOIN e ON u = node WHERE root < v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(root) AS component_id, min(root) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON node = d.doc_id GROUP BY d.doc_id, n.n
"""
