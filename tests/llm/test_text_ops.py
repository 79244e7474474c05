"""BPE, language, quality rules, classifier and personal data on odd cases."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from sentiframe.llm import bpe, gam, line_crf, pii, rank_language
from tests.llm import fixtures


@pytest.fixture(scope="module")
def vocabulary():
    path, pattern = bpe.public_vocabulary()
    return bpe._vocabulary(bpe.read_ranks(path), pattern)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=bpe.public_vocabulary()[1], mergeable_ranks=vocabulary.ranks, special_tokens={})


def test_bpe_equals_tiktoken(vocabulary, library):
    rng = random.Random(2)
    parts = ["the", "in", "ation", "a", "b", " ", "1", "中", "!!", "  ", "\x00", "\n", "\t", " \n", "é", "😀", "'s", "\u00a0", "\x1c"]
    texts = [t or "" for t in fixtures.texts()] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 50))) for _ in range(800)]
    texts += ["a" * 3000, "ab" * 2000, "=" * 700 + "-" * 1025, "<|endoftext|>", "".join(rng.choice("abcdefgh") for _ in range(4000))]
    codes = vocabulary.encode_texts(texts)
    for text, code in zip(texts, codes, strict=True):
        assert np.frombuffer(code, "<u4").tolist() == library.encode_ordinary(text)
    assert vocabulary.decode(codes) == [t.encode() for t in texts]


def test_bpe_table(spark, library):
    rows = fixtures.rows()
    got = bpe.digests(fixtures.documents(spark), *bpe.public_vocabulary()).collect()
    ids = [np.array(library.encode_ordinary(t or ""), "<u4") for _, t, *_ in rows]
    digest = lambda b: hashlib.sha256(b).hexdigest()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(
        str((r[0], len(x), digest(x.tobytes()), digest((r[1] or "").encode()))) for r, x in zip(rows, ids, strict=True))
    assert bpe.digests(fixtures.documents(spark).limit(0), *bpe.public_vocabulary()).count() == 0


def test_bpe_keeps_columns_of_any_name(spark):
    path, pattern = bpe.public_vocabulary()
    docs = fixtures.documents(spark).withColumns({"c0": F.col("size"), "bytes2": F.col("ids"), "_text": F.col("lang")})
    encoded = bpe.encode(docs, path, pattern, keep=("c0", "bytes2", "_text"))
    assert encoded.columns == ["doc_id", "c0", "bytes2", "_text", "n_tokens", "ids"]
    decoded = bpe.decode(encoded, path)
    both = bpe.round_trip(docs, path, pattern, keep=("c0", "bytes2", "_text"))
    assert sorted(map(str, decoded.collect())) == sorted(map(str, both.collect()))


def brute_ngrams(text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    return Counter(g for w in words for g in [*w] + [(f" {w} ")[i:i + n] for n in (2, 3) for i in range(len(w) + 3 - n)])


def test_ngrams_equal_brute_force():
    for text in [None, "", "1 2", "Ab ab, x", "école É", "a", " a-b "]:
        grams, counts = rank_language.ngrams(text)
        unpack = lambda g: "".join(chr(g >> s & 0x1FFFFF) for s in (42, 21, 0) if g >> s).replace("\x01", " ")
        assert {unpack(g): n for g, n in zip(grams.tolist(), counts.tolist(), strict=True)} == brute_ngrams(text)


def test_language(spark):
    german = "der schnelle braune fuchs springt über den faulen hund und schläft"
    english = "the quick brown fox jumps over the lazy dog and then it sleeps"
    docs = spark.createDataFrame(
        [(i, english if i % 2 else german, "en" if i % 2 else "de") for i in range(40)] + [(90, "dies und der hund", None),
         (91, None, "en"), (92, "", None), (93, "12 !", "de"), (None, "the lazy fox and the dog", "en"), (90, "dies und der hund", None)],
        "doc_id long, text string, lang string")
    profiles = rank_language.learn(docs, F.lit(True))
    got = rank_language.identify(docs, profiles).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == 46 and all(0 <= r["score"] <= 1 for r in got)
    assert [by_id[i]["lang_pred"] for i in (90, 91, 92, 93, None, 1, 2)] == ["de", "und", "und", "und", "en", "en", "de"]
    nothing = rank_language.learn(docs.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in rank_language.identify(docs, nothing).collect()} == {"und"}


def test_out_of_place_distance():
    p = rank_language.Profiles({"x": np.array([5, 6, 7]), "y": np.array([7, 8])}, 3)
    assert p.langs == ["x", "y"] and p.grams.tolist() == [5, 6, 7, 8]
    assert p.ranks.tolist() == [[0, 1, 2, -1], [-1, -1, 0, 1]]


def brute_base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = {i + k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside)


def test_base_counts_equal_brute_force():
    for t in [*fixtures.texts(), "a b c d e a b c d e", "a a a a a a", "#*$ %&|<>", "x\ny\nx\n \n "]:
        assert line_crf.base_counts(t) == brute_base(t)


def brute_viterbi(model, features):
    best = None
    for code in range(2 ** len(features)):
        states = [code >> i & 1 for i in range(len(features))]
        total = sum(model.emit[f].sum() + model.bias for f, s in zip(features, states, strict=True) if s)
        total += sum(model.step[a, b] for a, b in zip(states, states[1:], strict=False))
        if best is None or total > best[0] + 1e-9:
            best = (total, states)
    return best


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(0)
    for _ in range(40):
        model = line_crf.Chain()
        model.emit, model.step, model.bias = rng.normal(size=model.emit.shape), rng.normal(size=(2, 2)), rng.normal()
        n = rng.integers(1, 8)
        features = np.stack([rng.integers(0, k, size=n) for k in line_crf.LEVELS], axis=1) + line_crf.OFFSETS
        total, states = brute_viterbi(model, features)
        assert model.decode(features) == states


def test_posterior_matches_enumeration():
    rng = np.random.default_rng(1)
    scores, step = rng.normal(size=(2, 4)), rng.normal(size=(2, 2))
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool)
    p, steps = line_crf._posterior(scores, mask, step)
    seen = np.zeros((2, 2))
    for row, n in ((0, 4), (1, 2)):
        weights, total = np.zeros(n), 0.0
        pair = np.zeros((2, 2))
        for code in range(2 ** n):
            s = [code >> i & 1 for i in range(n)]
            w = np.exp(sum(scores[row, i] for i in range(n) if s[i]) + sum(step[a, b] for a, b in zip(s, s[1:], strict=False)))
            total += w
            weights += w * np.array(s)
            for a, b in zip(s, s[1:], strict=False):
                pair[a, b] += w
        np.testing.assert_allclose(p[row, :n], weights / total)
        seen += pair / total
    np.testing.assert_allclose(steps, seen)


def test_rules_table(spark):
    docs = fixtures.documents(spark)
    model = line_crf.train(docs, fixtures.labels(spark))
    got = line_crf.apply_rules(docs, model).collect()
    assert len(got) == len(fixtures.rows())
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["content_share"] >= line_crf.SHARE)
    empty = line_crf.train(docs, fixtures.labels(spark).limit(0))
    assert all(r["kept"] != r["base_failed"] for r in line_crf.apply_rules(docs, empty).collect())
    assert line_crf.apply_rules(docs.limit(0), model).count() == 0


def test_junk_lines_are_boilerplate(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = line_crf.apply_rules(docs, line_crf.train(docs, labels)).join(labels, "doc_id")
    good, poor = (got.where(F.col("quality") == q).agg(F.avg(F.col("kept").cast("int")), F.count("*")).head() for q in (1, 0))
    assert good[0] > 0.98 and poor[0] < 0.2


def test_lines_of_mixed_pages(spark):
    """Junk blocks within good lines are marked, on documents that the chain did not learn from."""
    labelled = (spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("quality in (0, 1)").orderBy("doc_id")
        .select("text", "quality").collect())
    held, known = labelled[::5], [r for i, r in enumerate(labelled) if i % 5]
    model = line_crf.fit([line_crf.line_features(r["text"])[0] for r in known], [r["quality"] for r in known])
    shares = [model.content_share(r["text"]) for r in held]
    assert np.mean([(s >= line_crf.SHARE) == bool(r["quality"]) for s, r in zip(shares, held, strict=True)]) > 0.97
    assert sum(0 < s < 1 for s in shares) >= 2
    lines = lambda q: [[x for x in r["text"].split("\n") if x.strip()][:5] for r in held if r["quality"] == q and r["text"]]
    junk = [[x for x in d if line_crf.line_features(x)[1][0] > 2 and model.content_share(x) == 0] for d in lines(0)]
    rng, right, n = random.Random(1), 0, 0
    for _ in range(100):
        a, b, c = rng.choice(lines(1)), rng.choice([d for d in junk if d]), rng.choice(lines(1))
        states = model.decode(line_crf.line_features("\n".join(a + b + c))[0])
        right += sum(map(int.__eq__, states, [1] * len(a) + [0] * len(b) + [1] * len(c)))
        n += len(states)
    assert right / n > 0.95


def test_line_words_are_split_at_six_blanks_alone():
    assert line_crf.line_features("a\x1cb\u00a0c d\x0be")[1] == [3]


def test_classifier_separates_and_is_repeatable(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = gam.train(docs, labels, gam.fold("doc_id", 5) != 0)
    again = gam.train(docs, labels, gam.fold("doc_id", 5) != 0)
    assert all((a == b).all() for a, b in zip(model.single, again.single, strict=True)) and model.pairs.keys() == again.pairs.keys()
    held = gam.score(docs, model, ["doc_id"]).join(labels, "doc_id").where(gam.fold("doc_id", 5) == 0).collect()
    assert np.mean([(r["_score"] >= gam.THRESHOLD) == bool(r["quality"]) for r in held]) > 0.9
    assert zlib.crc32(b"7") % 5 == spark.range(7, 8).select(gam.fold("id", 5)).head()[0]


def test_classifier_on_odd_rows(spark):
    docs = fixtures.documents(spark)
    model = gam.train(docs, fixtures.labels(spark), F.lit(True))
    got = gam.score(docs, model, ["doc_id", "score"]).collect()
    assert len(got) == len(fixtures.rows()) and all(0 <= r["_score"] <= 1 for r in got)
    none = gam.train(docs, fixtures.labels(spark).limit(0), F.lit(True))
    assert {r["_score"] for r in gam.score(docs, none, ["doc_id"]).collect()} == {0.5}
    assert gam.score(docs.limit(0), model, ["doc_id"]).count() == 0


def test_additive_model_learns_a_crossing():
    rng = np.random.default_rng(3)
    x = rng.uniform(size=(3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no single feature tells
    model = gam.fit(x, y)
    assert (1, 0) in model.pairs
    assert np.mean((model.score(x) > 0.5) == y) > 0.9


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        t += int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
    return t % 10 == 0


def brute_spans(t):
    t, out = t or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for k, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 12, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m.group())
            if low <= len(d) <= high and (k == 3 or luhn(d)):
                out.append((m.start(), k, m.end()))
    return [(k, a, b) for a, k, b in sorted(out)]


@pytest.fixture(scope="module")
def scorer(spark):
    return pii.train(spark)


def test_personal_data(spark, scorer):
    rng = random.Random(4)
    parts = ["a", "b.", "@", "-", ".", "1", "22", "333", "+4", "(", ")", " ", "_", "é", "😀", "\n", "4111 1111 1111 1111", "1.2.3.4", "256",
             "0", "a@b.c", "+49 "]
    texts = fixtures.texts() + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["1" * 30_000, "a." * 10_000 + "@", "a@" + "b." * 10_000 + "c", "+1 " * 5_000, "1.2.3.4 " * 1_000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    for r in pii.find(docs, scorer).collect():
        assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == brute_spans(texts[r["doc_id"]])
        assert {tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]}
    assert pii.find(docs.limit(0), scorer).count() == 0


def test_generators_propose_every_form(spark):
    forms = {"phone": ["1-800-555-1234", "1 (800) 555-1234", "07911 123456", "030 1234567", "(030)1234567", "5551234567", "030/1234567-12"],
             "ip": ["fe80::1", "::1", "::ffff:c000:0280", "2001:db8::", "dead::beef"], "card": ["3782.822463.10005"]}
    one = F.explode(pii.proposed(F.col("text"))).alias("c")
    for kind, texts in forms.items():
        docs = spark.createDataFrame([(f"see {t}, then",) for t in texts], "text string")
        got = {(r["text"], r["kind"], r["text"][r["start"]:r["end"]]) for r in docs.select("text", one).select("text", "c.*").collect()}
        assert {(f"see {t}, then", pii.KINDS.index(kind), t) for t in texts} <= got


def test_every_positive_snippet_has_a_candidate(spark):
    kinds = F.transform(pii.proposed(F.col("text")), lambda c: c["kind"])
    missed = pii.snippets(spark).where("label = 1").where(~F.array_contains(kinds, F.col("kind")))
    assert missed.collect() == []


def test_wider_forms_are_selected(spark, scorer):
    texts = ["call 1-800-555-1234 now", "text me on 07911 123456", "phone 030 1234567, please", "call 5551234567", "ping fe80::1", "host ::1 is up",
             "amex 3782.822463.10005", "order 5551234567", "the years 2019-2020", "class dad::add", "isbn 1-234-56789-0", "about 12345678 people"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [texts[r["doc_id"]][s["start"]:s["end"]] for s in r["spans"]] for r in pii.find(docs, scorer).collect()}
    assert [got[i] for i in range(7)] == [["1-800-555-1234"], ["07911 123456"], ["030 1234567"], ["5551234567"], ["fe80::1"], ["::1"],
                                          ["3782.822463.10005"]]
    assert not any(got[i] for i in range(7, 12))


def test_overlaps_equal_brute_force(spark):
    """Spans clear of the base, and the best of those that overlap, as all pairs tell."""
    rng, rows = random.Random(8), []
    for i in range(300):
        span = lambda: (lambda a: (a, a + rng.randint(1, 9)))(rng.randint(0, 400))
        rows.append((i, sorted({span() for _ in range(rng.choice([0, 1, 12, 90]))}),
                     sorted({(*span(), rng.randint(0, 3), rng.choice([0.6, 0.7, 0.8])) for _ in range(rng.choice([0, 1, 12, 150]))})))
    docs = spark.createDataFrame(rows, "id int, base array<struct<start:int,end:int>>, "
                                       "more array<struct<start:int,end:int,kind:int,p:double>>")
    got = {r["id"]: r for r in docs.select("id", pii.clear(F.col("more"), F.col("base")).alias("clear"),
                                           pii.best_of_overlaps(F.col("more")).alias("best")).collect()}
    meet = lambda x, y: x[0] < y[1] and y[0] < x[1]
    rank = lambda x: (-x[3], x[0], -x[1], x[2])
    for i, base, more in rows:
        assert sorted(map(tuple, got[i]["clear"])) == [c for c in more if not any(meet(b, c) for b in base)]
        assert sorted(map(tuple, got[i]["best"])) == [c for c in more if not any(meet(o, c) and rank(o) < rank(c) for o in more)]


def test_a_text_of_many_spans(spark, scorer):
    n = 20_000
    text = " ".join(f"user{i}@mail{i % 7}.example.com 10.0.{i % 200}.{i % 250}," for i in range(n))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.perf_counter()
    found = pii.find(docs, scorer).head()
    assert time.perf_counter() - start < 60
    assert [(s["kind"], s["start"], s["end"]) for s in found["base"]] == brute_spans(text) and len(found["base"]) == 2 * n


def test_added_spans(spark, scorer):
    texts = ["call me at 555-123-4567 or john at gmail dot com", "ping 2001:db8:85a3::8a2e:370:7334", "card 4111.1111.1111.1111",
             "they met at noon dot and left", "order 555-123-4567-12", "the score 10:20:30", "the river and the stone"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [(pii.KINDS[s["kind"]], texts[r["doc_id"]][s["start"]:s["end"]]) for s in r["spans"]] for r in pii.find(docs, scorer).collect()}
    assert got[0] == [("phone", "555-123-4567"), ("email", "john at gmail dot com")]
    assert got[1] == [("ip", "2001:db8:85a3::8a2e:370:7334")] and got[2] == [("card", "4111.1111.1111.1111")]
    assert not any(got[i] for i in (3, 4, 5, 6))
