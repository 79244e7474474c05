"""The Katz model against a plain one, and its probabilities' sums."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentiframe.llm import katz
from tests.llm import fixtures


class Plain:
    """The model of the docstring, by dictionaries."""

    def __init__(self, texts):
        self.c1, self.c2 = Counter(), Counter()
        for t in texts:
            tokens = self.tokens(t)
            self.c1.update(tokens)
            self.c2.update(zip(["<s>", *tokens], tokens, strict=False))
        self.n, self.v = sum(self.c1.values()), len(self.c1)
        self.d1, self.d2 = (katz.discounts([sum(x == r for x in c.values()) for r in range(1, katz.CUT + 2)]) for c in (self.c1, self.c2))
        self.after, self.seen = Counter(), {}
        for (h, w), c in self.c2.items():
            self.after[h] += c
            self.seen.setdefault(h, set()).add(w)
        self.unknown = 1 - sum(self.cut(self.d1, c) for c in self.c1.values()) / (self.n + 1)

    @staticmethod
    def tokens(t):
        low = "".join(x.lower() if "A" <= x <= "Z" else x for x in t or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]

    @staticmethod
    def cut(d, c):
        return c * d[c - 1] if c <= len(d) else c

    def p1(self, w):
        return self.cut(self.d1, self.c1[w]) / (self.n + 1) if w in self.c1 else self.unknown

    def p(self, h, w):
        if (h, w) in self.c2:
            return self.cut(self.d2, self.c2[h, w]) / (self.after[h] + 1)
        if h not in self.seen:
            return self.p1(w)
        given = sum(self.cut(self.d2, self.c2[h, x]) for x in self.seen[h]) / (self.after[h] + 1)
        return (1 - given) / (1 - sum(map(self.p1, self.seen[h]))) * self.p1(w)

    def row(self, t):
        tokens = self.tokens(t)
        base = sum(math.log10((self.c1[w] + 1) / (self.n + self.v + 1)) for w in tokens)
        score = sum(math.log10(self.p(h, w)) for h, w in zip(["<s>", *tokens], tokens, strict=False))
        return len(tokens), sum(w in self.c1 for w in tokens), self.n, base, score


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2


def check(spark, rows, **sizes):
    table = spark.createDataFrame(rows, "doc_id long, text string, id long, kind int, h long, c long").repartition(3)
    got = katz.scores(table, held_out(), **sizes).collect()
    plain = Plain([r[1] for r in rows if not held(r[0])])
    want = [(r[0], held(r[0]), *plain.row(r[1])) for r in rows]
    order = lambda r: (str(r[0]), r[2], round(r[6], 3))
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    return plain


def corpus(n, words, seed=1):
    rng = random.Random(seed)
    zipf = lambda: words[min(int(rng.paretovariate(0.8)) - 1, len(words) - 1)]
    return [(i, " ".join(zipf() for _ in range(rng.randint(0, 60))), 9, 9, 9, 9) for i in range(n)]


WORDS = [f"w{i}" for i in range(400)]


@pytest.mark.parametrize("sizes", [{}, {"head": 20, "hot": 30, "least_hot": 8, "bucket_tokens": 60}, {"head": 1, "hot": 1}])
def test_scores_equal_the_plain_model(spark, sizes):
    rows = corpus(250, WORDS) + [(1000 + i, f"only here{i} San Francisco", 9, 9, 9, 9) for i in range(30)]
    plain = check(spark, rows, **sizes)
    assert plain.d1 != [1.0] * katz.CUT or plain.d2 != [1.0] * katz.CUT  # discounts are at work
    vocabulary = [*plain.c1, "never seen"]
    for h in ["<s>", "w0", "w3", "san", "w399", "no such context"]:
        assert sum(plain.p(h, w) for w in vocabulary) == pytest.approx(1, abs=1e-9)


def test_odd_rows(spark):
    check(spark, [(r[0], r[1], 9, 9, 9, 9) for r in fixtures.rows()], head=50)


def test_repeated_rows_and_no_rows(spark):
    row = (3, "a b a b", 9, 9, 9, 9)
    check(spark, [row] * 4 + [(None, None, 9, 9, 9, 9), (None, "B a", 9, 9, 9, 9)])
    check(spark, [row], head=1)
    only_held = next(i for i in range(100) if held(i))
    got = katz.scores(spark.createDataFrame([(only_held, "a b")], "doc_id long, text string"), held_out()).collect()
    assert [tuple(r) for r in got] == [(only_held, True, 3, 0, 0, 0.0, 0.0)]
    assert katz.scores(spark.createDataFrame([], "doc_id long, text string"), held_out()).count() == 0


def test_discounts_are_valid_or_none():
    assert katz.discounts([0] * 6) == [1.0] * 5
    assert katz.discounts([100, 60, 0, 0, 0, 0]) == [1.0] * 5  # one n_2 alone takes all
    d = katz.discounts([1000, 400, 220, 140, 100, 70])
    assert all(0 < x < 1 for x in d)
    assert d[0] == pytest.approx((2 * 400 / 1000 - 6 * 70 / 1000) / (1 - 6 * 70 / 1000))


def test_lookups():
    some = katz.Lookup(np.array([5, -3, 9]), np.array([1, 2, 3]))
    assert some.get(np.array([9, 4, -3, 5, 10])).tolist() == [3, 0, 2, 1, 0]
    assert katz.Lookup(np.zeros(0, np.int64), np.zeros(0, np.int64)).get(np.array([1])).tolist() == [0]
