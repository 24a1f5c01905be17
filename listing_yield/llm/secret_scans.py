"""Secret scans: pattern kinds, and sliding-window Shannon entropy over candidate strings. DataFrame functions only.

Base kinds are patterns (``assign``, ``access``, ``hex``). The method adds kind ``entropy``: candidates are runs of at
least ``WINDOW`` characters of a class (hexadecimal; otherwise Base64), with a letter and a digit; the window slides over
a candidate, and its entropy is kept as S = sum of f(count) with f(c) = c log2 c in integer millionths, so H = log2 W -
S / W. The counts of all characters are carried along, packed into longs of five bits each: a step reads the
outgoing and the incoming character's count, takes their terms from f(c) to f(c-1) and from f(c) to f(c+1), and updates
the two counts; nothing is counted anew. A window passes if S is at most the class's limit and it holds no literal of
the allow list (sequences, placeholders, names of digests); the span goes from the first passing window's start to the
last one's end. Candidates that are a path of words, and spans that overlap a base span, are suppressed.

Positions are code points: the pieces between matches (``split``) and the matches (``regexp_extract_all``) alternate, so
running sums of their lengths give every start. Running values go through an array in chunks (``running``), and overlaps
are found by two sweeps over the sorted spans, so one text's cost is linear in its hits. Each kind first tests the whole
text with one pattern; only texts that hold a match do the rest.

Defined cases: null text is empty and has no span; null doc_id stays null; repeated rows are scanned each; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table

#: The patterns of the contract; letters of the words in either case.
_WORDS = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                  for w in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"""(?:{_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]"""
ASSIGN, ASSIGN_TEST = _ASSIGN + "+)", _ASSIGN + "{12,})"
ACCESS = "AKIA[A-Z0-9]{14,}"  # a run of 18 or more
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
SCALE = 1_000_000
F_OF = [round(c * math.log2(c) * SCALE) if c else 0 for c in range(WINDOW + 1)]
#: Least entropy in bits of a passing window, by class.
LEAST_BITS = {"hex": 3.0, "base64": 3.75}
LIMIT = {k: round(WINDOW * (math.log2(WINDOW) - v) * SCALE) for k, v in LEAST_BITS.items()}
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
HEX_ONLY = "^[0-9A-Fa-f]+$"
_SEPARATOR, _PART = "[/_=+-]+", "(?:[A-Z]?[a-z]{1,15}|[A-Z]{1,15}|[0-9]{1,8})"
#: A path of words: nothing but single-case words (a capital may lead) and short numbers between separators, and a word
#: of six letters or more among them. Repeats are bounded, so what is longer is scanned.
WORD_PATH = f"^(?:{_SEPARATOR})?(?:{_PART}{_SEPARATOR}){{0,32}}(?:[A-Z]?[a-z]{{6,15}}|[A-Z]{{6,15}})" \
            f"(?:{_SEPARATOR}{_PART}){{0,32}}(?:{_SEPARATOR})?$"
#: Windows that hold one of the literals are no secrets, nor are candidates that are a path of words as a whole.
LITERALS = "(?:0123456789|abcdefghij|ABCDEFGHIJ|EXAMPLE|example|PLACEHOLDER|placeholder|sha256|sha512)"
LONGEST_LITERAL = 11
CHUNK = 128  # of running values
FIRST_CHAR, LAST_CHAR, PER_LONG = ord("+"), ord("z"), 12  # five bits a character's count
LONGS = (LAST_CHAR - FIRST_CHAR) // PER_LONG + 1
SPAN = "struct<start:int,kind:int,end:int>"


def running(items: Column, state: Column, kind: str, step) -> Column:
    """The values that ``step(state, item)`` (a struct of ``state`` and ``out``, of type ``kind``) gives from item to
    item. Chunks are gathered by themselves, so what is copied as the result grows stays small."""
    def scan(values: Column, start: Column) -> Column:
        zero = F.struct(start.alias("state"), F.array().cast(f"array<{kind}>").alias("outs"))

        def one(s: Column, x: Column) -> Column:
            now = step(s["state"], x)
            return F.struct(now["state"].alias("state"), F.concat(s["outs"], F.array(now["out"])).alias("outs"))
        return F.aggregate(values, zero, one)

    zero = F.struct(state.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("outs"))

    def chunks(values: Column) -> Column:
        starts = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.size(values), F.lit(CHUNK)))

        def chunk(s: Column, at: Column) -> Column:
            return let(scan(F.slice(values, at, CHUNK), s["state"]), lambda done: F.struct(
                done["state"].alias("state"), F.concat(s["outs"], F.array(done["outs"])).alias("outs")))
        return F.flatten(F.aggregate(F.coalesce(starts, F.array().cast("array<int>")), zero, chunk, lambda s: s["outs"]))

    return let(items, chunks)


def let(value: Column, use) -> Column:
    """``use(value)``; as a lambda's variable the value is made once, not once for each use in a loop."""
    return F.element_at(F.transform(F.array(value), use), 1)


def spans(text: Column, pattern: str, test: str, kind: int, keep=None) -> Column:
    """array<struct<start, kind, end>> of the pattern's matches; ``keep(i)`` says which of them (by number) count."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    once = F.struct(gaps.alias("gaps"), hits.alias("hits"))

    def found(x: Column) -> Column:
        zipped = F.arrays_zip(F.transform(F.slice(x["gaps"], 1, F.size(x["hits"])), F.length).alias("gap"),
                              F.transform(x["hits"], F.length).alias("hit"),
                              (keep or (lambda h: F.transform(h, lambda _: F.lit(True))))(x["hits"]).alias("keep"))

        def step(at: Column, x: Column) -> Column:
            start = at + x["gap"]
            span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x["hit"]).alias("end"))
            return F.struct((start + x["hit"]).alias("state"), F.when(x["keep"], span).alias("out"))
        return F.filter(running(zipped, F.lit(0), SPAN, step), lambda v: v.isNotNull())

    return F.when(text.rlike(test), let(once, found)).otherwise(
        F.array().cast(f"array<{SPAN}>"))


def _f(count: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x).cast("long") for x in F_OF]), count + 1)


def passing(candidate: Column) -> Column:
    """struct<first, last> of the candidate's windows that pass (numbered from 0), last -1 if none does."""
    limit = F.when(candidate.rlike(HEX_ONLY), F.lit(LIMIT["hex"])).otherwise(F.lit(LIMIT["base64"])).cast("long")
    codes = F.transform(F.split(candidate, ""), lambda c: F.ascii(c) - FIRST_CHAR)
    once = F.struct(candidate.alias("text"), codes.alias("codes"), limit.alias("limit"),
                    candidate.rlike(LITERALS).alias("literal"))
    return let(once, _passing)


def _passing(c: Column) -> Column:
    """One pass over the candidate's characters; those of the first window are only taken in."""
    longs = [f"c{k}" for k in range(LONGS)]

    def count(s: Column, code: Column) -> Column:
        word = F.element_at(F.array(*[s[k] for k in longs]), (code / PER_LONG).cast("int") + 1)
        # a right shift by a column's number of bits, as a division by a power of two
        return (word.bitwiseAND(F.lit(31).cast("long") * _bit(code)) / _bit(code)).cast("int")

    def step(s: Column, i: Column) -> Column:  # character i comes (from 1 on), character i - WINDOW goes
        came = F.element_at(c["codes"], i)
        gone = F.when(i > WINDOW, F.element_at(c["codes"], F.greatest(i - WINDOW, F.lit(1))))
        a = F.coalesce(count(s, gone), F.lit(0))
        b = count(s, came) - F.when(gone == came, 1).otherwise(0)
        now = s["s"] + F.when(gone.isNotNull(), _f(F.greatest(a - 1, F.lit(0))) - _f(a)).otherwise(0) + _f(b + 1) - _f(b)
        tail = F.substring(c["text"], F.greatest(i - LONGEST_LITERAL + 1, F.lit(1)), F.least(i, F.lit(LONGEST_LITERAL)))
        ended = F.regexp_extract(tail, f"({LITERALS})$", 1)
        # the last start of a literal that has ended; it is in the window unless it lies before the window's start
        literal = F.when(c["literal"] & (ended != ""), i - F.length(ended)).otherwise(s["literal"])
        at = i - WINDOW
        good = (at >= 0) & (now <= c["limit"]) & (literal < at)
        return F.struct(*[(s[k] + F.when(_long(came) == n, _bit(came)).otherwise(0)
                           - F.when(_long(gone) == n, _bit(gone)).otherwise(0)).alias(k) for n, k in enumerate(longs)],
                        now.alias("s"), literal.alias("literal"),
                        F.when(good & (s["first"] < 0), at).otherwise(s["first"]).alias("first"),
                        F.when(good, at).otherwise(s["last"]).alias("last"))

    zero = F.struct(*[F.lit(0).cast("long").alias(k) for k in longs], F.lit(0).cast("long").alias("s"),
                    F.lit(-1).alias("literal"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    return F.aggregate(F.sequence(F.lit(1), F.size(c["codes"])), zero, step,
                       lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _long(code: Column) -> Column:
    return (code / PER_LONG).cast("int")


def _bit(code: Column) -> Column:
    """The least bit of a character's count in its long."""
    return F.element_at(F.array(*[F.lit(1 << 5 * k).cast("long") for k in range(PER_LONG)]), code % PER_LONG + 1)


def entropy_spans(text: Column) -> Column:
    """Spans of kind ``entropy``, before those that overlap base spans are taken out."""
    likely = lambda x: (x.rlike("[0-9]") & x.rlike("[A-Za-z]") & ~x.rlike(WORD_PATH))
    test = f"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z]){CANDIDATE}"
    kind = KINDS.index("entropy")
    runs = spans(text, CANDIDATE, test, kind, lambda h: F.transform(h, likely))
    hits = F.filter(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), likely)

    def judged(runs: Column) -> Column:
        cut = F.when(F.size(runs) > 0, F.zip_with(runs, hits, lambda r, h: F.struct(
            r["start"].alias("start"), passing(h).alias("p"))))
        return F.coalesce(F.transform(F.filter(cut, lambda x: x["p"]["last"] >= 0), lambda x: F.struct(
            (x["start"] + x["p"]["first"]).alias("start"), F.lit(kind).alias("kind"),
            (x["start"] + x["p"]["last"] + WINDOW).alias("end"))), F.array().cast(f"array<{SPAN}>"))

    return let(runs, judged)


def without_overlaps(base: Column, entropy: Column) -> Column:
    """The spans of ``base`` and those of ``entropy`` that overlap none of them, sorted. Forward, a span needs a start
    beyond all ends of base spans so far; backward, an end before the next base span's start."""
    kind = KINDS.index("entropy")

    def forward(end: Column, x: Column) -> Column:
        free = (x["kind"] < kind) | (end <= x["start"])
        return F.struct(F.when(x["kind"] < kind, F.greatest(end, x["end"])).otherwise(end).alias("state"),
                        F.when(free, x).alias("out"))

    def backward(start: Column, x: Column) -> Column:
        free = (x["kind"] < kind) | (x["end"] <= start)
        return F.struct(F.when(x["kind"] < kind, F.least(start, x["start"])).otherwise(start).alias("state"),
                        F.when(free, x).alias("out"))

    left = lambda spans: F.filter(spans, lambda x: x.isNotNull())
    ahead = left(running(F.array_sort(F.concat(base, entropy)), F.lit(-1), SPAN, forward))
    back = left(running(F.reverse(ahead), F.lit(2**31 - 1), SPAN, backward))
    both = (F.size(base) > 0) & (F.size(entropy) > 0)
    return F.when(both, F.array_sort(back)).otherwise(F.concat(base, entropy))


def joined(found: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", F.element_at(name, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans: arrays of struct<start, kind, end>, kind an index of KINDS."""
    text = F.col("text")
    value = lambda hits: F.transform(hits, lambda h: F.length(F.regexp_extract(h, f"^{ASSIGN}$", 1)) >= 12)
    base = F.array_sort(F.concat(spans(text, ASSIGN, ASSIGN_TEST, 0, value), spans(text, ACCESS, ACCESS, 1),
                                 spans(text, HEX, HEX, 2)))
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = out.select("doc_id", base.alias("base"), entropy_spans(text).alias("entropy"))
    return out.select("doc_id", "base", without_overlaps(F.col("base"), F.col("entropy")).alias("spans"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(kind))).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _span_sql(pattern: str, kind: int, keep: str = "true") -> str:
    p = pattern.replace("'", "''")
    return (f"SELECT doc, {kind} AS kind, i, g, h, list_sum(list_transform(g[1:i], lambda x: length(x)))"
            f" + coalesce(list_sum(list_transform(h[1:i-1], lambda x: length(x))), 0) AS s, h[i] AS hit FROM "
            f"(SELECT doc, g, h, unnest(generate_series(1, len(h))) AS i FROM (SELECT doc, "
            f"string_split_regex(t, '{p}') AS g, regexp_extract_all(t, '{p}') AS h FROM d)) WHERE {keep}")


_ASSIGN_SQL = ASSIGN.replace("'", "''")
_CASES = " ".join(f"WHEN {c} THEN {x}" for c, x in enumerate(F_OF))

ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT doc, kind, s::BIGINT AS s, (s + length(hit))::BIGINT AS e FROM (
  {_span_sql(ASSIGN, 0, f"length(regexp_extract(h[i], '^{_ASSIGN_SQL}$', 1)) >= 12")}
  UNION ALL {_span_sql(ACCESS, 1)} UNION ALL {_span_sql(HEX, 2)})),
cand AS (SELECT doc, s::BIGINT AS s, hit, CASE WHEN regexp_matches(hit, '{HEX_ONLY}') THEN {LIMIT["hex"]}
    ELSE {LIMIT["base64"]} END AS lim FROM (
  {_span_sql(CANDIDATE, 3, f"regexp_matches(h[i], '[0-9]') AND regexp_matches(h[i], '[A-Za-z]') AND NOT regexp_matches(h[i], '{WORD_PATH}')")})),
win AS (SELECT * FROM (SELECT doc, s, hit, lim, unnest(generate_series(0, length(hit) - {WINDOW})) AS i FROM cand)
  WHERE NOT regexp_matches(substr(hit, (i + 1)::BIGINT, {WINDOW}), '{LITERALS}')),
chars AS (SELECT doc, s, lim, i, c, count(*) AS n FROM (SELECT doc, s, lim, i,
    unnest(string_split(substr(hit, (i + 1)::BIGINT, {WINDOW}), '')) AS c FROM win) GROUP BY ALL),
sums AS (SELECT doc, s, lim, i, sum(CASE n {_CASES} END) AS x FROM chars GROUP BY doc, s, lim, i),
ent AS (SELECT doc, 3 AS kind, s + min(i) AS s, s + max(i) + {WINDOW} AS e FROM sums WHERE x <= lim GROUP BY doc, s),
free AS (SELECT * FROM ent WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc = ent.doc AND b.s < ent.e AND ent.s < b.e)),
named AS (SELECT doc, kind, s, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || s || ':' || e AS x
  FROM (SELECT * FROM base UNION ALL SELECT * FROM free)),
per AS (SELECT doc, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS h,
    string_agg(x, ',' ORDER BY s, kind) FILTER (kind < 3) AS bx, string_agg(x, ',' ORDER BY s, kind) AS sx
  FROM named GROUP BY doc)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(h, 0) AS n_hex,
    sha256(coalesce(bx, '')) AS base_sha256, coalesce(sx, '') AS spans
FROM d LEFT JOIN per USING (doc)
"""
