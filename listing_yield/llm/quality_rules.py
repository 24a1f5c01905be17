"""Quality rules, line first: lines that fail a rule are removed, then documents that lost too much are rejected.

A line is a part of the text between line feeds that holds a word (``[^\\x20\\x09-\\x0D]+``). It fails by

* punctuation: at least a quarter of its words, and two of them, end in two or more of ``!#$%&*`` (words in running text
  end in at most one such mark);
* navigation: at least 3 of its words are the separator ``|`` (or the start of such a list: words and separators take
  turns), that is, separators are at least a quarter of its words;
* boilerplate: it has at most 30 words and holds one of ``BOILERPLATE`` in any letter case.

Lines without a word stay as they are. A document is rejected if failed lines hold more than ``max_loss`` of its words,
or by the base rules (fewer than 50 words; more than half of the words in repeated 3-word windows).

Every rule reads whole texts, row by row: no shuffle, and a task holds one slice of a batch.

Defined cases: null and empty texts have no words and are rejected; null doc_id stays null; repeated rows are judged
each; an empty table gives no rows; other columns are neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table
from . import textnp as T

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOSS_PERCENT = 50
SYMBOLS = "#*$%&|<>"
BOILERPLATE = ("all rights reserved", "cookie policy", "enable javascript", "lorem ipsum", "privacy policy",
               "sign up for our newsletter", "skip to content", "terms of service", "terms of use",
               "this site uses cookies")
BOILERPLATE_WORDS = 30

_MARKS = b"!#$%&*"
_PHRASES = tuple(x.encode() for x in BOILERPLATE)
_MARKED = tuple(bytes([a, b]) for a in _MARKS for b in _MARKS)

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SCHEMA = f"{BASE}, n_bad_words long, n_bad_lines long, base_failed boolean, kept boolean, clean_text string"


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more. Words, then pairs, then windows are numbered, so equal
    numbers are equal windows."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    found, at, count = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    if len(found) == len(at):
        return 0
    start = np.flatnonzero(count[at] > 1)
    return int(np.minimum(np.diff(start, append=start[-1] + 3), 3).sum())


def line_fails(line: bytes, words: list[bytes]) -> bool:
    n = len(words)
    if b"|" in line:
        bars = words.count(b"|")
        if bars >= 3 and 4 * bars >= n:
            return True
    marked = sum(w.endswith(_MARKED) for w in words) if line.translate(None, _MARKS) != line else 0
    if marked >= 2 and 4 * marked >= n:
        return True
    if n <= BOILERPLATE_WORDS:
        low = line.lower()  # of bytes: A-Z only
        return any(p in low for p in _PHRASES)
    return False


def judge(text: str | None) -> tuple:
    """The columns of SCHEMA for one text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    lines = data.split(b"\n")
    words, kept_lines, seen = [], [], set()
    dup = bad_words = bad_lines = 0
    for line in lines:
        own = line.split()  # of bytes: exactly the six ASCII white-space characters
        if own:
            words += own
            dup += line in seen
            seen.add(line)
            if line_fails(line, own):
                bad_words += len(own)
                bad_lines += 1
                continue
        kept_lines.append(line)
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\r\x0b\x0c"))
    repeat = repeated_words(words)
    base_failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    kept = not base_failed and 100 * bad_words <= MAX_LOSS_PERCENT * n
    clean = b"\n".join(kept_lines).decode("utf-8", "surrogatepass") if bad_lines else text
    return n, chars, sum(map(text.count, SYMBOLS)), dup, repeat, bad_words, bad_lines, base_failed, kept, clean


def apply_rules(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), clean_text: bool = False) -> DataFrame:
    """The columns ``keep`` of ``docs`` (one struct, so that no name can clash) and those of SCHEMA; ``clean_text`` is
    the text without its failed lines and is only carried when asked for."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    wanted = names if clean_text else names[:-1]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    source = docs.select(row, F.col("text").alias("text"))
    schema = ", ".join([f"row {source.schema['row'].dataType.simpleString()}",
                        *[x for x in SCHEMA.split(", ") if x.split()[0] in wanted]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 7 + [pa.bool_(), pa.bool_(), pa.string()]
        for batch in batches:
            for a, b in T.slices(batch.column(1)):
                part = batch.slice(a, b - a)
                columns = list(zip(*[judge(x.as_py()) for x in part.column(1)], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, t) for c, t in zip(columns[: len(wanted)], types, strict=False)]],
                    ["row", *wanted])

    return source.mapInArrow(run, schema)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_rules(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "n_bad_words", "n_bad_lines")


def keep_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with failed lines removed from their text (and n_chars counted again); the columns
    stay those of ``docs``."""
    rest = tuple(c for c in docs.columns if c != "text")
    out = apply_rules(docs, rest, clean_text=True).where("kept")
    return out.select(*[F.col("clean_text").alias("text") if c == "text"
                        else F.length("clean_text").cast("long").alias(c) if c == "n_chars"
                        else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


_BOILERPLATE_SQL = "|".join(BOILERPLATE)

ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
win AS (SELECT doc_id, unnest(generate_series(1, len(w) - 2)) AS i, w FROM w WHERE len(w) >= 3),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS x FROM win),
rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM tri),
cov AS (SELECT DISTINCT doc_id, i + k AS pos FROM rep, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1),
repeats AS (SELECT doc_id, count(*) AS n_repeat_words FROM cov GROUP BY doc_id),
parts AS (SELECT doc_id, string_split(t, chr(10)) AS p FROM d),
numbered AS (SELECT doc_id, unnest(p) AS line, generate_subscripts(p, 1) AS n FROM parts),
lines AS (SELECT doc_id, line, n, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS lw,
    len(list_filter(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda x: x = '|')) AS bars,
    len(list_filter(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda x: regexp_matches(x, '[!#$%&*][!#$%&*]$'))) AS marked
  FROM numbered),
judged AS (SELECT doc_id, lw, row_number() OVER (PARTITION BY doc_id, line ORDER BY n) > 1 AS dup,
    (bars >= 3 AND 4 * bars >= lw) OR (marked >= 2 AND 4 * marked >= lw)
      OR (lw <= {BOILERPLATE_WORDS} AND regexp_matches(lower(line), '{_BOILERPLATE_SQL}')) AS bad
  FROM lines WHERE lw > 0),
per_doc AS (SELECT doc_id, sum(dup::INT) AS n_dup_lines, sum(CASE WHEN bad THEN lw ELSE 0 END) AS n_bad_words,
    sum(bad::INT) AS n_bad_lines FROM judged GROUP BY doc_id),
counted AS (SELECT w.doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_bad_words, 0)::BIGINT AS n_bad_words, coalesce(n_bad_lines, 0)::BIGINT AS n_bad_lines
  FROM w LEFT JOIN per_doc ON w.doc_id = per_doc.doc_id LEFT JOIN repeats ON w.doc_id = repeats.doc_id),
based AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 100 * n_bad_words <= {MAX_LOSS_PERCENT} * n_words AS kept, n_bad_words, n_bad_lines
FROM based
"""
