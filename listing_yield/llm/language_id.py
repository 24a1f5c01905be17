"""Language ID by unigram pieces over a fixed public vocabulary, with the segmentation summed out.

Words are maximal runs of letters (``str.isalpha``, in any plane), lower-cased. For a language, the probability of a word
is the sum, over all its segmentations into vocabulary pieces, of the product of the pieces' probabilities: the
forward algorithm, a[e] = sum of a[s] * p(word[s:e]), run for all languages and for all distinct words of equal length
at once. Longer runs (unspaced scripts) go through in parts of ``PART`` letters: what lies before a part reaches it as
the last sums, as many as the longest piece has letters, and a part maps these to the sums at its end. That map is
linear, so all parts' maps are made at once and then applied one after the other, rescaled in between: the result is the
sum over all segmentations of the whole run. A text's score for a language is the sum of its words' log probabilities;
``score`` is the best language's posterior under equal priors.

The piece probabilities come from expectation maximisation: expected piece counts by the forward and backward sums over
a bounded training sample (at most ``TRAIN_DOCS`` labelled documents for each language, those with the smallest hash of
doc_id), summed by Spark. Only sums by language and piece, at most vocabulary x languages numbers, reach the driver; more
than ``MAX_LANGUAGES`` labels are an error. All pieces of letters alone are used; single letters that are no piece
share one floor.

Defined cases: a text that is null or has no letter is ``und`` with score 0; without any training document all texts are
``und``; ties go to the first language by name; null doc_id counts as held in by no rule (held_out is null-safe false);
repeated rows are judged each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, read_table
from . import textnp as T

VOCABULARY = "piece_bpe_32k.model"
TRAIN_DOCS = 400
ROUNDS = 3
PART = 24  # letters that sums go through without rescaling
MAX_LANGUAGES = 1000
BROADCAST_IDS = 500_000
BUCKETS = 64
SLICE = 1 << 19
FLOOR = 1e-7

_TABLED = 0x20000  # code points with an entry in a table; those above are looked up one by one


def _lower(c: str) -> int:
    return ord(x) if len(x := c.lower()) == 1 else ord(c)


class Letters:
    """Which code points are letters, and their lower case (tables are made once in a process)."""

    made: "Letters | None" = None

    def __init__(self):
        chars = [chr(i) for i in range(_TABLED)]
        self.letter = np.array([c.isalpha() for c in chars])
        self.lower = np.array([_lower(c) for c in chars], np.uint32)

    @classmethod
    def get(cls) -> "Letters":
        if cls.made is None:
            cls.made = cls()
        return cls.made

    def read(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower-cased code points, and which are letters."""
        high = np.flatnonzero(codes >= _TABLED)
        if not len(high):
            return self.lower[codes], self.letter[codes]
        tabled = np.where(codes < _TABLED, codes, 0)
        lower, letter = self.lower[tabled], self.letter[tabled]
        distinct, at = np.unique(codes[high], return_inverse=True)
        lower[high] = np.array([_lower(chr(c)) for c in distinct.tolist()], np.uint32)[at]
        letter[high] = np.array([chr(c).isalpha() for c in distinct.tolist()])[at]
        return lower, letter


def values_of(codes: np.ndarray) -> np.ndarray:
    """A 64-bit value for each code point, as hashes of spans use them."""
    return T.mix(codes.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))


def piece_hashes(vocabulary: str = VOCABULARY) -> tuple[np.ndarray, int]:
    """Sorted hashes of the vocabulary's pieces that are letters only, without the word-start mark, lower-cased; and
    the letters of the longest."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
    pieces = {"".join(chr(_lower(c)) for c in sp.id_to_piece(i).lstrip("▁")) for i in range(sp.get_piece_size())}
    return hashes_of(sorted(x for x in pieces if x.isalpha()))


def hashes_of(pieces: list[str]) -> tuple[np.ndarray, int]:
    codes = np.array([ord(c) for x in pieces for c in x], np.uint32)
    ends = np.cumsum([len(x) for x in pieces], dtype=np.int64)
    starts = ends - np.array([len(x) for x in pieces], np.int64)
    return np.unique(T.span_hash(values_of(codes), starts, ends)), max(map(len, pieces), default=1)


class Pieces:
    """Hash to piece number in a power-of-two table with linear probing; the number of pieces means none."""

    def __init__(self, hashes: np.ndarray, longest: int):
        self.n, self.longest = len(hashes), longest
        size = 1 << max(4, int(np.ceil(np.log2(max(1, 8 * self.n)))))
        self.mask = np.uint64(size - 1)
        self.keys = np.zeros(size, np.uint64)
        self.at = np.full(size, self.n, np.int32)
        self.probes = 1
        for i, h in enumerate(hashes.tolist()):
            k, step = h & (size - 1), 1
            while self.at[k] != self.n:
                k, step = (k + 1) & (size - 1), step + 1
            self.keys[k], self.at[k] = h, i
            self.probes = max(self.probes, step)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes & self.mask).astype(np.int64)
        out = np.where(self.keys[slot] == hashes, self.at[slot], self.n)
        for step in range(1, self.probes):
            left = np.flatnonzero(out == self.n)
            if not len(left):
                break
            s = (slot[left] + step) & int(self.mask)
            hit = self.keys[s] == hashes[left]
            out[left[hit]] = self.at[s[hit]]
        return out


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points of a slice, start and end of each word, and each word's row."""
    encoded = [(x or "").encode("utf-32-le", "surrogatepass") for x in texts]
    sizes = np.array([len(x) // 4 for x in encoded], np.int64)
    codes, letter = Letters.get().read(np.frombuffer(b"".join(encoded), np.uint32))
    ends = np.cumsum(sizes)
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    inner = ends[(ends > 0) & (ends < len(codes))]
    first[inner] |= letter[inner]
    last[inner - 1] |= letter[inner - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return codes, s, e, np.searchsorted(ends, s, "right")


def distinct_words(codes: np.ndarray, s: np.ndarray, e: np.ndarray):
    """First occurrence of each distinct word, and each word's number among them."""
    values = values_of(codes)
    _, first, inverse = np.unique(T.span_hash(values, s, e), return_index=True, return_inverse=True)
    return values, first, inverse


def lattice(values: np.ndarray, starts: np.ndarray, n: int, pieces: Pieces) -> dict[tuple[int, int], np.ndarray]:
    """Piece number of each span [i, j) of all words of n letters that start at ``starts``."""
    up, down = T.powers(n + 1)
    total = np.zeros((n + 1, len(starts)), np.uint64)
    for i in range(n):
        total[i + 1] = total[i] + values[starts + i] * up[i]
    out = {}
    for i in range(n):
        for j in range(i + 1, min(n, i + pieces.longest) + 1):
            size = np.uint64((j - i) * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
            out[i, j] = pieces.find(T.mix((total[j] - total[i]) * down[i] + size))
    return out


def span_probs(probs: np.ndarray, piece: np.ndarray, letters: int) -> np.ndarray:
    """Probability of spans by language; probs has a row of zeros for "no piece" at its end."""
    p = probs[piece]
    return np.maximum(p, FLOOR) if letters == 1 else p


def forward(spans: dict, n: int, probs: np.ndarray, m: int) -> np.ndarray:
    """a[e] of each word and language."""
    a = np.zeros((n + 1, m, probs.shape[1]))
    a[0] = 1.0
    for (i, j), piece in sorted(spans.items(), key=lambda x: x[0][1]):
        a[j] += a[i] * span_probs(probs, piece, j - i)
    return a


class LongRuns:
    """Runs of over ``PART`` letters, cut into parts that carry the forward sums on.

    A state is the sums at a part's start and at the K - 1 positions before it, K the longest piece. ``spans`` holds,
    for each end j in a part and each length, the part's pieces that end there, those from before the part included."""

    def __init__(self, values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, pieces: Pieces):
        count = -(-sizes // PART)
        self.k, self.run = pieces.longest, np.repeat(np.arange(len(sizes)), count)
        self.first = np.cumsum(count) - count
        number = np.arange(count.sum()) - self.first[self.run]
        self.n = np.minimum(PART, sizes[self.run] - PART * number)
        at, low = starts[self.run] + PART * number, starts[self.run]
        end = at + self.n
        k, up, down = self.k, *T.powers(pieces.longest + PART + 1)
        total = np.zeros((k + PART + 1, len(at)), np.uint64)
        for t in range(k + PART):
            place = at - k + t
            inside = (place >= low) & (place < end)
            total[t + 1] = total[t] + np.where(inside, values[np.where(inside, place, 0)], 0) * up[t]
        self.spans: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # end, letters, parts, pieces
        for j in range(1, PART + 1):
            for letters in range(1, k + 1):
                t = k + j
                size = np.uint64(letters * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
                found = pieces.find(T.mix((total[t] - total[t - letters]) * down[t - letters] + size))
                fits = (j <= self.n) & (at + j - letters >= low)
                own = np.flatnonzero(fits if letters == 1 else fits & (found < pieces.n))
                if len(own):
                    self.spans.append((j, letters, own, found[own]))

    def maps(self, probs: np.ndarray) -> np.ndarray:
        """For each part and language, the matrix from the state at its start to the state at its end."""
        k, m, width = self.k, len(self.n), probs.shape[1]
        a = np.zeros((k + PART, m, k, width))  # a[k - 1 + j] stands for position j of the part
        for i in range(k):
            a[k - 1 - i, :, i] = 1.0
        for j, letters, own, piece in self.spans:
            a[k - 1 + j, own] += a[k - 1 + j - letters, own] * span_probs(probs, piece, letters)[:, None, :]
        ends = k - 1 + self.n
        return np.stack([a[ends - i, np.arange(m)] for i in range(k)], axis=1)  # part, to, from, language

    def states(self, maps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state at each part's end, scaled to a largest entry of 1, and the log probability of each run."""
        m, k, _, width = maps.shape
        out, logs = np.zeros((m, k, width)), np.zeros((len(self.first), width))
        for i in range(m):
            if i == self.first[self.run[i]]:
                state = np.zeros((k, width))
                state[0] = 1.0
            state = np.einsum("tfl,fl->tl", maps[i], state)
            top = state.max(axis=0)
            state = state / top
            out[i] = state
            logs[self.run[i]] += np.log(top)
        last = np.r_[self.first[1:], m] - 1
        return out, logs + np.log(out[last, 0])

    def counts(self, probs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in one language, each run counted ``weight`` times."""
        k, m = self.k, len(self.n)
        maps = self.maps(probs)
        ends, _ = self.states(maps)
        maps, ends = maps[..., 0], ends[..., 0]
        starts, back = np.zeros((m, k)), np.zeros((m, k))
        starts[self.first, 0] = 1.0
        later = np.flatnonzero(np.arange(m) != self.first[self.run])
        starts[later] = ends[later - 1]
        for i in range(m - 1, -1, -1):  # what follows a part, by entry of its last state
            if i == m - 1 or self.run[i] != self.run[i + 1]:
                back[i, 0] = 1.0
            else:
                follow = maps[i + 1].T @ back[i + 1]
                back[i] = follow / follow.max()
        a, b = np.zeros((k + PART, m)), np.zeros((k + PART, m))
        a[:k] = starts.T[::-1]
        for i in range(k):
            b[k - 1 + self.n - i, np.arange(m)] += back[:, i]
        for j, letters, own, piece in self.spans:
            a[k - 1 + j, own] += a[k - 1 + j - letters, own] * span_probs(probs[:, 0], piece, letters)
        whole = sum(a[k - 1 + self.n - i, np.arange(m)] * back[:, i] for i in range(k))
        out = np.zeros(len(probs))
        for j, letters, own, piece in reversed(self.spans):
            p, after = span_probs(probs[:, 0], piece, letters), b[k - 1 + j, own]
            b[k - 1 + j - letters, own] += p * after
            share = a[k - 1 + j - letters, own] * probs[piece, 0] * after * weight[self.run[own]] / whole[own]
            out += np.bincount(piece, share, len(out))
        return out


def long_blocks(sizes: np.ndarray, width: int, longest: int) -> Iterator[np.ndarray]:
    """Blocks of long runs whose maps take about 32 MB, or single runs."""
    most = max(1, (1 << 22) // ((longest + PART) * longest * width))
    parts = np.cumsum(-(-sizes // PART))
    at = 0
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(parts, (parts[at - 1] if at else 0) + most, "right")))
        yield np.arange(at, stop)
        at = stop


def word_scores(values, s, e, first, pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """Log probability of each distinct word in each language."""
    starts, sizes = s[first], (e - s)[first]
    out = np.zeros((len(first), probs.shape[1]))
    for n in np.unique(sizes[sizes <= PART]).tolist():
        which = np.flatnonzero(sizes == n)
        for at in range(0, len(which), 4096):
            own = which[at: at + 4096]
            spans = lattice(values, starts[own], n, pieces)
            out[own] = np.log(forward(spans, n, probs, len(own))[n])
    long = np.flatnonzero(sizes > PART)
    for block in long_blocks(sizes[long], probs.shape[1], pieces.longest):
        runs = LongRuns(values, starts[long[block]], sizes[long[block]], pieces)
        out[long[block]] = runs.states(runs.maps(probs))[1]
    return out


def expected_counts(values, s, e, first, weight: np.ndarray, pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over the words, each counted ``weight`` times, in one language."""
    out = np.zeros(pieces.n + 1)
    starts, sizes = s[first], (e - s)[first]
    for n in np.unique(sizes[sizes <= PART]).tolist():
        own = np.flatnonzero(sizes == n)
        spans = lattice(values, starts[own], n, pieces)
        a = forward(spans, n, probs, len(own))[:, :, 0]
        b = np.zeros_like(a)
        b[n] = 1.0
        for (i, j), piece in sorted(spans.items(), key=lambda x: -x[0][0]):
            b[i] += span_probs(probs[:, 0], piece, j - i) * b[j]
        scale = weight[own] / a[n]
        for (i, j), piece in spans.items():
            out += np.bincount(piece, a[i] * probs[piece, 0] * b[j] * scale, len(out))
    long = np.flatnonzero(sizes > PART)
    for block in long_blocks(sizes[long], 1, pieces.longest):
        out += LongRuns(values, starts[long[block]], sizes[long[block]], pieces).counts(probs, weight[long[block]])
    return out


def training_sample(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """lang, text of at most ``train_docs`` documents a language, chosen by a hash of doc_id among those that aren't
    held out. The ranking sees only doc_id and lang, first in ``BUCKETS`` parts of a language, so that no task ranks
    more than BUCKETS * train_docs rows of one."""
    own = docs.select("doc_id", "lang").where("lang is not null and doc_id is not null").where(~held_out())
    own = own.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)))
    smallest = [F.xxhash64("doc_id", F.lit(1)), "doc_id"]
    for keys in (["lang", "bucket"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(*smallest)
        own = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= train_docs).drop("rank")
    chosen = materialize(own.select("doc_id").distinct(), "langid-chosen")
    if chosen.count() <= BROADCAST_IDS:  # train_docs ids a language
        chosen = F.broadcast(chosen)
    return (docs.select("doc_id", "lang", "text").where("lang is not null and text is not null")
            .join(chosen, "doc_id", "left_semi").select("lang", "text"))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS, vocabulary: str = VOCABULARY):
    """The languages in order, the pieces and their probabilities (pieces + 1 rows, one column a language;
    the last row is 0 and stands for no piece)."""
    spark = docs.sparkSession
    sample = materialize(training_sample(docs, train_docs).repartition(spark.sparkContext.defaultParallelism),
                         "langid-sample")
    langs = [r[0] for r in sample.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    hashes, longest = piece_hashes(vocabulary)
    pieces, n = Pieces(hashes, longest), len(hashes)
    probs = np.full((n + 1, len(langs)), 1.0 / max(n, 1))
    probs[n] = 0.0
    for _ in range(rounds if langs else 0):
        now = spark.sparkContext.broadcast((pieces, probs))

        def run(batches: Iterator[pa.RecordBatch], langs=langs, now=now) -> Iterator[pa.RecordBatch]:
            pieces, probs = now.value
            totals = np.zeros((len(langs), pieces.n + 1))
            for batch in batches:
                lang = np.array(batch.column(0).to_pylist())
                for k, name in enumerate(langs):
                    texts = batch.column(1).filter(pa.array(lang == name))
                    for a, b in T.slices(texts, SLICE):
                        codes, s, e, _ = words_of(texts.slice(a, b - a).to_pylist())
                        if len(s):
                            values, first, inverse = distinct_words(codes, s, e)
                            weight = np.bincount(inverse).astype(float)
                            totals[k] += expected_counts(values, s, e, first, weight, pieces, probs[:, k: k + 1])
            k, piece = np.nonzero(totals[:, :-1])
            yield pa.RecordBatch.from_pydict({"k": pa.array(k, pa.int64()), "piece": pa.array(piece, pa.int64()),
                                              "uses": pa.array(totals[k, piece], pa.float64())})

        # at most languages x pieces rows
        rows = (sample.mapInArrow(run, "k long, piece long, uses double")
                .groupBy("k", "piece").agg(F.sum("uses").alias("uses")).toPandas())
        uses = np.zeros((n + 1, len(langs)))
        uses[rows["piece"], rows["k"]] = rows["uses"]
        probs = (uses + 0.01) / (uses[:n].sum(axis=0) + 0.01 * n)
        probs[n] = 0.0
        now.unpersist()
    return langs, pieces, probs


def predict(docs: DataFrame, model) -> DataFrame:
    """doc_id, held_out, lang_pred, score. Only the text is an input of a prediction."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # pieces x languages numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, pieces, probs = shared.value
        for batch in batches:
            for a, b in T.slices(batch.column(2), SLICE):
                part = batch.slice(a, b - a)
                codes, s, e, row = words_of(part.column(2).to_pylist())
                names, scores = np.full(b - a, "und", object), np.zeros(b - a)
                if len(s) and langs:
                    values, first, inverse = distinct_words(codes, s, e)
                    logs = word_scores(values, s, e, first, pieces, probs)[inverse]
                    at = np.flatnonzero(np.r_[True, np.diff(row) > 0])
                    total = np.add.reduceat(logs, at, axis=0)
                    best = total.argmax(axis=1)
                    share = 1.0 / np.exp(total - total.max(axis=1)[:, None]).sum(axis=1)
                    names[row[at]] = np.array(langs, object)[best]
                    scores[row[at]] = share
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.string()),
                                                  pa.array(scores)], ["doc_id", "held_out", "lang_pred", "score"])

    return (docs.select("doc_id", held_out().alias("held_out"), "text")
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return predict(docs, fit(docs))
