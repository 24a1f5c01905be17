"""Operators over several rows against brute force: exact search, line dedup, near-dedup, language ID, mixing."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from listing_yield.llm import components, exact_search, language_id, line_dedup, mixing, near_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(x):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in x)


def docs_of(spark, rows, clash=True):
    df = spark.createDataFrame([(i, t, "s", "en", len(t or "")) for i, t in rows],
                               "doc_id long, text string, source string, lang string, n_chars long")
    if clash:
        for c in ("row", "gone", "line", "cls", "kept", "tokens", "component_id"):
            df = df.withColumn(c, F.lit(7))
    return df


# exact search

def brute_search(rows, k):
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            fine.setdefault(i, [int(np.floor(64 * float(np.float32(x)))) for x in v])
    out = set()
    for q in fine:
        if q % 20 == 0:
            scored = sorted(((sum(a * b for a, b in zip(fine[q], v)), i) for i, v in fine.items() if i != q),
                            key=lambda x: (-x[0], x[1]))
            out |= {(q, r + 1, i, s) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("kind", ["random", "copies", "tiny"])
def test_exact_search(spark, kind):
    rng = np.random.default_rng(5)
    n = {"random": 900, "copies": 700, "tiny": 5}[kind]
    vectors = rng.normal(size=(n, 12)).astype(np.float32)
    if kind == "copies":
        vectors[: n // 2] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(None, [1.0] * 12), (10_001, None), (10_002, [None] * 12), (10_020, [float("nan")] * 12),
             (10_040, [float("inf")] * 12), (10_060, []), rows[1], rows[0]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    found = exact_search.integer_vectors(table)
    got = exact_search.search(found, found.where("vec_id % 20 = 0"), 20, tree_rows=256)
    assert {tuple(r) for r in got.collect()} == brute_search(rows, 20)
    assert exact_search.search(found.limit(0), found.limit(0), 20).count() == 0


def test_queries_meet_only_trees_in_reach(spark, monkeypatch):
    monkeypatch.setattr(exact_search, "CHUNK", 3)
    monkeypatch.setattr(exact_search, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(exact_search, "SEEDS", 2000)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 8)) * 5
    rows = [(i // 2, (centres[i % 12] + rng.normal(size=8) / 4).tolist()) for i in range(1600)]  # two vectors for each id
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = exact_search.integer_vectors(table)
    asked = found.where("vec_id % 20 = 0")
    pivots = exact_search.picked_rows(found, 12)
    trees = exact_search.build_trees(found, 32, pivots)
    wanted = exact_search.wanted_trees(exact_search.query_blocks(found, asked, 5, pivots), trees)
    met = sum(len(r.ids) // 8 for r in wanted.select("ids").collect())
    assert 0 < met < asked.count() * trees.count() / 2
    got = exact_search.search(found, asked, 5, tree_rows=50)
    v = [(i, np.floor(64 * np.array(x)).astype(int)) for i, x in rows]
    want = set()
    for q in {i for i, _ in v if i % 20 == 0}:
        scored = sorted((-int(a @ b), j) for i, a in v if i == q for j, b in v if j != q)
        want |= {(q, r + 1, j, -s) for r, (s, j) in enumerate(scored[:5])}
    assert {tuple(r) for r in got.collect()} == want


# line dedup

def lines_of(text):
    return [(i, [lower(w) for w in WORD.findall(x)]) for i, x in enumerate((text or "").split("\n"))]


def distance_at_most_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute_lines(rows):
    every = [((i, n), w) for i, t in rows for n, w in lines_of(t) if len(w) >= line_dedup.MIN_WORDS]
    gone = {}
    for p, w in every:
        earlier = [(e, q) for q, v in every if q < p for e in
                   ([0] if v == w else [1] if min(len(v), len(w)) >= line_dedup.NEAR_WORDS
                    and distance_at_most_one(v, w) else [])]
        if earlier:
            gone[p] = (min(earlier)[0], min(q for e, q in earlier if e == min(earlier)[0]))
    return gone


def edited_lines(seed):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("ab cd ef gh ij kl".split()) + str(rng.randint(0, 30)) for _ in range(n))
            for n in (4, 5, 7, 8, 8, 9, 10, 11, 12, 20)] + ["x x x x x x x x x", "the one line of them all is this"]
    rows = []
    for d in range(40):
        out = []
        for _ in range(rng.randint(0, 6)):
            w = rng.choice(base).split()
            for _ in range(rng.randint(0, 2)):
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1:], w[:i] + [f"n{rng.randint(0, 3)}"] + w[i:],
                                w[:i] + [f"m{rng.randint(0, 3)}"] + w[i + 1:], w[:i] + [w[i].upper()] + w[i + 1:]]) or w
            out.append("  ".join(w) if rng.random() < 0.2 else " ".join(w))
        rows.append((d, "\n".join(out)))
    return rows + [(90, None), (91, ""), (92, "\n\n"), (93, "é è ê ë à â ä ù û"), (94, "é è ê ë à â ä ù x")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_line_dedup(spark, seed):
    rows = edited_lines(seed)
    df = docs_of(spark, rows)
    got = {(r.doc_id, r.line): (r.edits, (r.first_doc_id, r.first_line))
           for r in line_dedup.repeated_lines(df).collect()}
    assert got == brute_lines(rows)
    if seed > 1:
        return
    left = line_dedup.remove_lines(df)
    assert left.columns == df.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    for i, t in rows:
        want = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in got)
        assert texts[i] == want
    assert line_dedup.remove_lines(df.limit(0)).count() == 0


# near-dedup

def brute_groups(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = [lower(x) for x in WORD.findall(t or "")]
        sets[i] = {tuple(w[k: k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    part = {i: i for i in sets}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                part[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def edited_docs(seed, n=250):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    bases = [[rng.choice(words) for _ in range(rng.choice([3, 10, 40, 120, 200]))] for _ in range(25)]
    rows = []
    for d in range(n):
        w = list(bases[0] if rng.random() < 0.4 else rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((d, " ".join(w).upper() if rng.random() < 0.1 else "\n".join(w)))
    return rows + [(n, None), (n + 1, ""), (n + 2, "a"), (n + 3, "A"), (n + 4, "a b"), (n + 5, " \t")]


@pytest.mark.parametrize("seed,words,percent,crowded,chunk,ids",
                         [(1, 3, 85, (32, 256), 512, 10**6), (2, 3, 85, (4, 8), 8, 0), (3, 5, 80, (32, 256), 16, 10**6)])
def test_near_dedup(spark, monkeypatch, seed, words, percent, crowded, chunk, ids):
    monkeypatch.setattr(near_dedup, "CROWDED", crowded)
    monkeypatch.setattr(near_dedup, "CHUNK", chunk)
    monkeypatch.setattr(near_dedup, "BROADCAST_IDS", ids)
    rows = edited_docs(seed)
    df = docs_of(spark, [*rows, rows[3], (None, "a b")])
    got = near_dedup.group(df, words, percent).collect()
    assert len(got) == len(rows) + 2
    want = brute_groups(rows, words, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    if seed > 1:
        return
    kept = near_dedup.keep_one(df, words, percent)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c} | {None}
    assert near_dedup.group(df.limit(0), words, percent).count() == 0


def test_one_doc_id_with_several_texts(spark):
    """All texts of a doc_id lead to its links, however the rows are dealt."""
    words = [f"w{i}" for i in range(120)]
    a, b, other = words[:60], words[60:], [f"o{i}" for i in range(60)]
    near = lambda x: " ".join([*x[:-1], "zz"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (1, " ".join(b)), (2, near(b)), (3, near(a)), (7, " ".join(other)),
            (4, " ".join(a)), (9, None), (9, " ".join(other)), (5, "x y"), (5, None)]
    want = {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 9: 7, 5: 5}
    for n in (1, 3, 5):
        got = near_dedup.group(docs_of(spark, rows).repartition(n), 3, 85).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r.component_id == (want[r.doc_id] if r.n_shingles else r.doc_id)
            assert r.kept == (r.doc_id == r.component_id)


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)]
    edges += [(500, 500 + i) for i in range(1, 50)]
    part = {x: x for e in edges for x in e}
    for _ in part:
        for a, b in edges:
            part[a] = part[b] = min(part[a], part[b])
    got = components.components(spark.createDataFrame(edges, "u long, v long"))
    want = {x: c for x, c in part.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert {r.node: r.component for r in got.collect()} == want and got.count() == len(want)


# language ID

def total_probability(word, probs):
    """Sum over all segmentations, letter by letter in logs, with no limit on the word's length."""
    import math
    longest = max(map(len, probs))
    a = [0.0] + [-math.inf] * len(word)
    for j in range(1, len(word) + 1):
        terms = []
        for n in range(1, min(longest, j) + 1):
            p = max(probs.get(word[j - n: j], 0.0), language_id.FLOOR if n == 1 else 0.0)
            if p and a[j - n] > -math.inf:
                terms.append(a[j - n] + math.log(p))
        top = max(terms)
        a[j] = top + math.log(sum(math.exp(x - top) for x in terms))
    return a[-1]


def table_of(probs):
    """Pieces and their column of probabilities."""
    hashes, longest = language_id.hashes_of(sorted(probs))
    own = {int(language_id.hashes_of([x])[0][0]): p for x, p in probs.items()}
    return language_id.Pieces(hashes, longest), np.array([[own[h]] for h in hashes.tolist()] + [[0.0]]), [
        next(x for x in probs if int(language_id.hashes_of([x])[0][0]) == h) for h in hashes.tolist()]


LONG_PIECE = "abcdefghijklmnop"
PROBS = {"a": 0.1, "b": 0.2, "ab": 0.3, "ba": 0.15, "aba": 0.05, LONG_PIECE: 0.1, "\U00030001\U00030002": 0.1}
HIGH = "\U00030001\U00030002\U0002A700"  # letters of planes 2 and 3


def test_forward_sums_all_segmentations():
    pieces, probs, _ = table_of(PROBS)
    rng = random.Random(1)
    long = ["".join(rng.choice(["a", "b", "ab", LONG_PIECE, "z"]) for _ in range(n)) for n in (20, 30, 200, 1000)]
    long += ["z" * 4000, LONG_PIECE * 50, "a" * 25, "ab" * 24, "b" * 24, "z" + LONG_PIECE * 3]
    words = ["abab", "ba", "aba", "c", LONG_PIECE, "x" + LONG_PIECE + "y", HIGH, HIGH * 30] + long
    codes, s, e, row = language_id.words_of(["abab, Ba! aba", "c", None, "1 2", " ".join(words[4:])])
    values, first, inverse = language_id.distinct_words(codes, s, e)
    got = language_id.word_scores(values, s, e, first, pieces, probs)[inverse][:, 0]
    assert np.allclose(got, [total_probability(w, PROBS) for w in words], rtol=1e-10)
    assert row.tolist() == [0, 0, 0, 1] + [4] * len(words[4:])


def test_expected_counts_follow_from_all_segmentations():
    """The expected uses of a piece are the derivative of the log probability by the log of its probability."""
    pieces, probs, names = table_of(PROBS)
    rng = random.Random(2)
    words = ["abab", LONG_PIECE + "ab", "ab" * 40, "".join(rng.choice(["a", "b", "z", LONG_PIECE]) for _ in range(90)), HIGH * 12]
    codes, s, e, _ = language_id.words_of([" ".join(words)])
    values, first, inverse = language_id.distinct_words(codes, s, e)
    weight = np.zeros(len(first))
    weight[inverse] = [1, 2, 3, 4, 5]
    got = language_id.expected_counts(values, s, e, first, weight, pieces, probs)
    for i, x in enumerate(names):
        up, down = ({**PROBS, x: PROBS[x] * f} for f in (1 + 1e-6, 1 - 1e-6))
        slope = sum(w * (total_probability(t, up) - total_probability(t, down)) / 2e-6
                    for w, t in zip([1, 2, 3, 4, 5], words, strict=True))
        assert abs(got[i] - slope) < 1e-4 * max(1, slope), x
    assert got[-1] == 0


def test_language_id(spark):
    rng = random.Random(6)
    syllables = {"en": "th on er ing and".split(), "fr": "eau tion que é ou".split(), "de": "sch keit ung ü der".split()}
    rows = []
    for i in range(240):
        lang = rng.choice(list(syllables))
        text = " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(30))
        rows.append((i, text, lang if i % 7 else None, lang))
    extra = [(1000, None, "en", "und"), (1001, "", "en", "und"), (1002, "12 34 !", "fr", "und"), (None, "sch", "de", "de"),
             (1003, "the " * 30_000 + "é" * 5000, "en", None), (1004, "x" * 3000, None, None),
             (1005, HIGH, None, "de"), (1006, HIGH * 2000 + " eau eau", None, "fr")]  # ties go to the first by name
    df = spark.createDataFrame([r[:3] for r in rows + extra], "doc_id long, text string, lang string")
    df = df.withColumn("score", F.lit(3)).withColumn("source", F.lit("s"))
    out = {r.doc_id: r for r in language_id.predict(df, language_id.fit(df, train_docs=40)).collect()}
    import zlib
    for i, _, _, want in rows + extra:
        r = out[i]
        assert 0 <= r.score <= 1
        assert want is None or r.lang_pred == want
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
    assert out[1005].score > 0.3 and out[1004].lang_pred != "und"
    nothing = language_id.fit(df.limit(0))
    assert {r.lang_pred for r in language_id.predict(df, nothing).collect()} == {"und"}
    assert language_id.predict(df.limit(0), nothing).count() == 0


# mixing

def test_mixing(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["a", "a", "b", "c", None]), rng.choice(["en", "en", "fr"]),
             "word " * rng.randint(1, 50) + ("\n" * rng.choice([0, 3]))) for i in range(2000)]
    rows += [(5000, "z", "en", None), (5001, "z", "fr", ""), (None, None, None, "some words")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    for c in ("tokens", "weight", "rate", "row", "topic"):
        df = df.withColumn(c, F.lit(1))
    targets = {"source": {"a": .25, "b": .25, "c": .25, "(none)": .25}, "lang": {"en": .5, "fr": .5},
               "topic": {"x": .3, "y": .7}}
    tables = {m: spark.createDataFrame(list(t.items()), "category string, target double") for m, t in targets.items()}
    topic = F.when(F.col("doc_id") % 3 == 0, "x").otherwise("y")
    out = mixing.mix(df.where("doc_id < 5000"), targets=tables, sweeps=40, topic=topic)
    kept = out.groupBy(*mixing.MARGINS).agg(F.sum(F.col("tokens") * F.col("rate")).alias("w"), F.max("rate").alias("r"))
    total = kept.agg(F.sum("w"), F.max("r")).first()
    assert abs(total[1] - 1) < 1e-12
    for m, t in targets.items():
        got = {r[0]: r[1] / total[0] for r in kept.groupBy(m).agg(F.sum("w")).collect()}
        assert got.keys() == t.keys() and all(abs(got[k] - t[k]) < 1e-6 for k in t)
    share = out.agg(F.sum(F.when(F.col("kept"), F.col("tokens"))) / F.sum(F.col("tokens") * F.col("rate"))).first()[0]
    assert abs(share - 1) < 0.1
    whole = mixing.mix(df)
    assert whole.count() == len(rows)
    mixing.BROADCAST_CELLS, most = 0, mixing.BROADCAST_CELLS
    assert mixing.mix(df).where("kept").count() == whole.where("kept").count()
    mixing.BROADCAST_CELLS = most
    assert whole.where("tokens = 0 and not kept").count() == 0
    assert mixing.sample(df).columns == df.columns
    assert mixing.sample(df.limit(0)).count() == 0
