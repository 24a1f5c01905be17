"""Secret scans: random keys are found whatever letters and slashes they hold; paths of words are not."""

import base64
import math
import random
from collections import Counter

from listing_yield.llm import secret_scans as S


def span_of(key):
    """First to last window of enough entropy."""
    bits = lambda y: sum(-c / len(y) * math.log2(c / len(y)) for c in Counter(y).values())
    hits = [i for i in range(len(key) - S.WINDOW + 1) if bits(key[i: i + S.WINDOW]) >= S.LEAST_BITS["base64"] - 1e-5]
    return (hits[0], hits[-1] + S.WINDOW) if hits else None


def test_random_keys_and_word_paths(spark):
    rng = random.Random(5)
    keys = []
    for n in (40, 64, 88, 128, 256):
        keys += [(base64.urlsafe_b64encode if i % 2 else base64.b64encode)(rng.randbytes(n * 3 // 4)).decode()
                 for i in range(60)]
    keys += ["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=40))
             for _ in range(60)]
    keys += ["-".join("".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=5)) for _ in range(5))
             for _ in range(60)]
    keys = [k for k in keys if any(c.isdigit() for c in k) and span_of(k)]
    assert len(keys) > 400
    words = ["international-conference/proceedings-2024", "/usr/local/share/documentation/2/"]
    texts = [f"see {k} end" for k in [*keys, *words]]
    got = {r.doc_id: [tuple(x) for x in r.spans]
           for r in S.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, k in enumerate(keys):
        a, b = span_of(k)
        assert got[i] == [(a + 4, S.KINDS.index("entropy"), b + 4)], k
    for i, w in enumerate(words, len(keys)):
        assert span_of(w) and got[i] == [], w
