"""Packing: order-preserving dynamic programming over document and sentence ends.

Each input partition is one stream of ids in input order (a document's ids, then the separator 0). The stream may be
cut at document ends (free) and sentence ends (``SENTENCE_PRICE``); only where two of these are further apart than the
window, a grid between them is allowed too (``INSIDE_PRICE``). A sequence that is as long as a power of two needs no
padding, any other is padded to the window. With P the position of a cut point and c its price, the best price of a
stream that is cut at j is

    best[j] = c[j] + min(window - P[j] + min(best[i] + P[i]  for  P[j] - P[i] <= window),
                         min(best[i]  for  P[j] - P[i] a power of two)).

The first minimum slides over a window of cut points, and a monotone queue finds it in amortised constant time; the second
looks at one point for each power. The programme runs through the whole partition: cuts are settled, and the documents
before them sent on, as soon as all ways that may still be taken have them in common, so the result doesn't depend on when
that is looked at. No row is moved: packing adds no shuffle, and a lost task is made again from its own input split with
the same ids.

A sentence ends behind a full stop, exclamation or question mark (closing quotes and brackets included) that white space
follows, behind their full-width forms, an ellipsis, or line ends; a stop behind a single letter (``e.g.``) is none.

Defined cases: a null or empty text is one separator; null doc_id stays null; repeated rows are packed each; an empty
table gives no rows; other columns are not read. The rest of a partition's stream is padded once.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table
from .encode import VOCABULARY, Encoder, encoder

WINDOW = 1024
SENTENCE_PRICE = 2.0  # in padded tokens
INSIDE_PRICE = 32.0
GRID = 16  # ids, in gaps wider than the window
LOOK = 1 << 17  # ids after which settled cuts are looked for

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "cut string")
KINDS = ("document", "sentence", "inside")

_CLOSING = rb"(?:[\"')\]]|\xe2\x80[\x99\x9d]|\xc2\xbb)*"
_WIDE = rb"(?:\xe3\x80\x82|\xef\xbc\x81|\xef\xbc\x9f|\xe2\x80\xa6)*"
#: It starts with one set of bytes, so that the search jumps from one of these to the next.
SENTENCE_END = re.compile(
    rb"[.!?\n\xe2\xe3\xef](?:(?<=[.!?])(?<!\b[A-Za-z]\.)[.!?]*" + _CLOSING + rb"(?=\s|$)|(?<=\n)\n*"
    rb"|(?:(?<=\xe3)\x80\x82|(?<=\xef)\xbc[\x81\x9f]|(?<=\xe2)\x80\xa6)" + _WIDE + _CLOSING + rb")")


def sentence_ends(text: bytes, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many ids stand before each sentence end of a text that falls between two ids; ``sizes`` are ids' bytes."""
    at = np.array([m.end() for m in SENTENCE_END.finditer(text)], np.int64)
    upto = np.cumsum(sizes[ids])
    place = np.searchsorted(upto, at)
    place = place[place < len(upto)]
    return np.unique(place[upto[place] == at[: len(place)]] + 1)


def token_sizes(enc: Encoder) -> np.ndarray:
    out = np.zeros(max(enc.tokens.values()) + 1, np.int64)
    for token, i in enc.tokens.items():
        out[i] = len(token)
    return out


def with_grid(at: np.ndarray, kind: np.ndarray, window: int = WINDOW, grid: int = GRID) -> tuple[np.ndarray, np.ndarray]:
    """Cut points (the first is where the last ones ended) and their kinds, with a grid in gaps over the window."""
    gaps = np.diff(at)
    wide = np.flatnonzero(gaps > window)
    n = (gaps[wide] - 1) // grid
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + 1
    every = np.concatenate([at, np.repeat(at[wide], n) + grid * step])
    order = np.argsort(every, kind="stable")
    return every[order], np.concatenate([kind, np.full(len(step), 2)])[order]


class Cutter:
    """The dynamic programme of one stream. ``feed`` it with cut points in order; ``settled`` gives, in order, those of
    its cheapest packing that no later point can change, ``finish`` all that are left."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.powers = [1 << k for k in range(window.bit_length()) if 1 << k <= window]
        self.best = {0: 0.0}
        self.came: dict[int, int] = {}
        self.points, self.low = [0], 0  # those within the window, from ``low`` on
        self.queue, self.worth, self.head = [0], [0.0], 0  # cut points with growing best + position
        self.done = 0

    def _a_power_before(self, at: list[int]) -> tuple[list[int], list[int]]:
        """Points that lie a power of two before each of ``at``: where each one's begin in the list, and the list."""
        new = np.array(at, np.int64)
        first = self.points[self.low]
        known = np.zeros(new[-1] - first + 1, bool)
        known[np.array(self.points[self.low:], np.int64) - first] = True
        known[new - first] = True
        of, found = [], []
        for step in self.powers:
            before = new - step - first
            own = np.flatnonzero(before >= 0)
            own = own[known[before[own]]]
            of.append(own)
            found.append(new[own] - step)
        of, found = np.concatenate(of), np.concatenate(found)
        order = np.argsort(of, kind="stable")
        return np.searchsorted(of[order], np.arange(len(new) + 1)).tolist(), found[order].tolist()

    def feed(self, at: list[int], price: list[float]) -> None:
        if not at:
            return
        begin, earlier = self._a_power_before(at)
        best, came, queue, worth, points, window = self.best, self.came, self.queue, self.worth, self.points, self.window
        head, low = self.head, self.low
        for j, (p, c) in enumerate(zip(at, price, strict=True)):
            while queue[head] < p - window:
                head += 1
            while points[low] < p - window:
                low += 1
            i, least = queue[head], window - p + worth[head]
            for q in earlier[begin[j]: begin[j + 1]]:
                if best[q] < least:
                    i, least = q, best[q]
            came[p] = i
            best[p] = least + c
            w = best[p] + p
            while len(queue) > head and worth[-1] >= w:
                queue.pop()
                worth.pop()
            queue.append(p)
            worth.append(w)
            points.append(p)
        self.queue, self.worth, self.head = queue[head:], worth[head:], 0
        for p in points[:low]:
            del best[p]
        self.points, self.low = points[low:], 0

    def settled(self) -> list[int]:
        """All ways from the points within the window back to the first that they share."""
        ways = [-p for p in self.points]
        heapq.heapify(ways)
        while len(ways) > 1:
            p = -heapq.heappop(ways)
            while ways and -ways[0] == p:
                heapq.heappop(ways)
            if not ways or p <= self.done:
                heapq.heappush(ways, -p)
                break
            heapq.heappush(ways, -self.came[p])
        return self._back(-ways[0])

    def finish(self) -> list[int]:
        return self._back(self.points[-1])

    def _back(self, p: int) -> list[int]:
        out = []
        while p > self.done:
            out.append(p)
            p = self.came[p]
        if out:
            self.done = out[0]
            for x in [x for x in self.came if x <= self.done]:
                del self.came[x]
        return out[::-1]


class Stream:
    """Documents of a partition in order, those that are still to be sent, and the cuts known so far."""

    def __init__(self, first_sequence: int, window: int = WINDOW):
        self.cutter, self.window = Cutter(window), window
        self.sequence, self.offset = first_sequence, 0
        self.end = self.sent = 0  # ids so far, and those before the last settled cut
        self.docs: list[tuple[int | None, int, bytes]] = []  # doc_id, first position, ids
        self.at: list[np.ndarray] = []
        self.kind: list[np.ndarray] = []
        self.last = 0  # last cut point that was fed
        self.kinds: dict[int, int] = {}

    def add(self, doc_id: int | None, ids: bytes, ends: np.ndarray) -> None:
        """``ends``: how many of the document's ids stand before each of its sentence ends."""
        n = len(ids) // 4
        self.docs.append((doc_id, self.end, ids + b"\0\0\0\0"))
        ends = ends[ends < n]
        self.at.append(np.r_[self.end + ends, self.end + n + 1])
        self.kind.append(np.r_[np.ones(len(ends), int), 0])
        self.end += n + 1

    def feed(self) -> None:
        if not self.at:
            return
        at, kind = with_grid(np.r_[self.last, np.concatenate(self.at)], np.r_[0, np.concatenate(self.kind)], self.window)
        at, kind = at[1:].tolist(), kind[1:].tolist()
        price = (0.0, SENTENCE_PRICE, INSIDE_PRICE)
        self.cutter.feed(at, [price[k] for k in kind])
        self.kinds.update(zip(at, kind, strict=True))
        self.last, self.at, self.kind = at[-1], [], []

    def take(self, cuts: list[int]) -> list[list]:
        """The columns of all pieces before the last of ``cuts``."""
        rows: list[tuple] = []
        here = self.sent
        left = iter(cuts)
        cut = next(left, None)
        gone = 0
        for doc_id, first, ids in self.docs:
            size = len(ids) // 4
            here = max(here, first)
            while cut is not None and here < first + size:
                stop = min(cut, first + size)
                part = memoryview(ids)[4 * (here - first): 4 * (stop - first)]
                kind = self.kinds[stop] if stop == cut else 0
                rows.append((doc_id, here - first, stop - here, zlib.crc32(part), size, self.sequence, self.offset,
                             KINDS[kind]))
                self.offset += stop - here
                here = stop
                if stop == cut:
                    self.sequence, self.offset, cut = self.sequence + 1, 0, next(left, None)
            if here < first + size:
                break
            gone += 1
        self.docs = self.docs[gone:]
        self.sent = here
        if cuts:
            self.kinds = {p: k for p, k in self.kinds.items() if p > cuts[-1]}
        return [list(c) for c in zip(*rows)]


def pack(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each piece of a document: ``docs`` needs ``doc_id`` (long) and ``text``. ``cut`` is the kind of place
    where the piece ends: ``document``, ``sentence`` or ``inside`` (of a sentence longer than the window)."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        sizes = token_sizes(enc)
        stream = Stream(TaskContext.get().partitionId() << 40)

        def sent(cuts: list[int]) -> Iterator[pa.RecordBatch]:
            columns = stream.take(cuts)
            if columns:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        looked = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                ids = enc.ids(text)
                stream.add(doc_id, ids, sentence_ends(text.encode(), np.frombuffer(ids, "<u4"), sizes))
                if stream.end - looked >= LOOK:
                    looked = stream.end
                    stream.feed()
                    yield from sent(stream.cutter.settled())
        stream.feed()
        yield from sent(stream.cutter.finish())

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """sequences, tokens, padded, and how many sequences end at a document, at a sentence and inside one."""
    own = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.struct("offset", "cut")).alias("end"))
    power = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    return own.agg(F.count(F.lit(1)).alias("sequences"), F.sum("n").alias("tokens"),
                   F.sum(F.when(power, 0).otherwise(window - F.col("n"))).alias("padded"),
                   *[F.count(F.when(F.col("end.cut") == k, 1)).alias(f"ends_{k}") for k in KINDS])


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
