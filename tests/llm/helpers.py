"""Small tables with every odd case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows, extra=()):
    """rows: (doc_id, text[, lang[, source]]); extra: names of clashing columns to add."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for c in extra:
        df = df.selectExpr("*", f"'x' as `{c}`")
    return df


def random_text(rng, words, n, newline=0.1):
    out = []
    for _ in range(n):
        out.append(rng.choice(words))
        out.append("\n" if rng.random() < newline else " ")
    return "".join(out).rstrip(" ")


def corpus(seed=0, n=60):
    rng = random.Random(seed)
    words = ["the", "of", "And", "ÉTÉ", "naïve", "x1", "don't", "A-b", "ß", "word"] + [f"w{i}" for i in range(40)]
    rows = [(i, random_text(rng, words, rng.randint(1, 60))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "  \t\n "), (n + 3, rows[0][1]), (n + 4, rows[0][1]), (2, rows[2][1]),
             (n + 5, random_text(rng, words, 3000)), (None, rows[1][1])]
    return rows
