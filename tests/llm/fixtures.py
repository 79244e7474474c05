"""Small tables with every odd case: nulls, empty and very long texts, ties,
repeated rows, and extra columns whose names clash with the operators' own."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, size long, ids string, "
          "id long, row long, lines string, fp long, base int, spans string, s int, quality int, _score double")


def texts() -> list[str | None]:
    rng = random.Random(5)
    words = ["the", "and", "of", "that", "stream", "river", "stone", "paper", "light", "green", "small", "house"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    base = [prose(rng.randint(12, 80)) for _ in range(30)]
    shared = "This line of text stands in many documents.\n"
    out: list[str | None] = [None, "", " ", "\n\n", "a", "a b", "a b c", "x\x1cy\u00a0z", "ÉCOLE école\nÉCOLE École",
                             "word " * 20_000, "w" * 100_000, "long line " * 3_000 + "\n" + "short", "\r\n".join(["Same line here"] * 4)]
    out += base + [shared + b for b in base[:8]] + base[:5] + [b.upper() for b in base[:3]] + [b + " extra" for b in base[:6]]
    out += ["  This LINE of text stands in many documents. \t\n" + base[9], "1.2.3.4 a.b@c-d.org, +49 (30) 1234567 4111 1111 1111 1111"]
    return out


def rows() -> list[tuple]:
    out = []
    for i, t in enumerate(texts()):
        source = [None, "src", "b", "Ä"][i % 4] if i % 3 else "hot"
        out.append((i, t, ["en", "de", None][i % 3], source, len(t or ""), 9.0, 9, "9", 9, 9, "9", 9, 9, "9", 9, 9, 9.0))
    return [*out, out[14], (None, *out[14][1:]), (None, "the last and stone of it\nA line of its own here", *out[3][2:]), (None, None, *out[0][2:])]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (5, 1, 0)],
                                 "doc_id long, quality int, toxic int")
