"""The pipeline against brute-force versions of its stages, on a small table with every odd case."""

import os
import random

import corpus_pipeline
from paylake.llm import rules
from tests.llm import test_decontam, test_linededup, test_packing, test_simhash
from tests.llm.helpers import docs_frame, random_text
from tests.llm.test_rules import brute


def write_tables(spark, folder):
    rng = random.Random(21)
    words = [f"word{i}" for i in range(150)] + ["Été", "naïve"]
    rows, labels = [], []
    for i in range(120):
        bad = i % 6 == 0
        t = random_text(rng, words, rng.randint(25, 90), 0.05)
        rows.append((i, t.replace(" ", " $ ") if bad else t, "en", f"s{i % 4}"))
        labels.append((i, int(not bad)))
    for i in range(30):  # copies and near copies of a clean text
        w = rows[1][1].split(" ")
        rows.append((200 + i, " ".join(w), "en", "s1"))
    items = [(k, " ".join(test_decontam.words(rows[k][1])[5:20])) for k in (7, 8)]
    rows += [(300, "Lead in. " + random_text(rng, words, 40) + " " + items[0][1], "en", "s2"), (301, None), (302, ""), (None, rows[4][1]),
             (4, rows[4][1], "en", "s0"), (303, "shared footer line of the site\n" + random_text(rng, words, 40)),
             (304, "shared footer line of the site\n" + random_text(rng, words, 40))]
    docs_frame(spark, rows, ["other"]).write.parquet(os.path.join(folder, "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int").selectExpr("*", "0 as toxic").write.parquet(os.path.join(folder, "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(os.path.join(folder, "benchmark.parquet"))
    return items


def test_each_stage_against_brute_force(spark, tmp_path):
    sf = str(tmp_path)
    items = write_tables(spark, sf)
    docs = spark.read.parquet(sf + "/documents.parquet")
    names = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    plain = lambda df: sorted([(r.doc_id, r.text) for r in df.collect()], key=str)

    kept = stages["quality_rules"](spark, docs, sf)
    assert kept.columns == names
    _, learned = rules.judge(docs, spark.read.parquet(sf + "/labels.parquet"), ("doc_id",))
    assert len(learned) == 1 and len(learned[0]) == 1
    rule = learned[0][0]
    def rejected(t):
        n, chars, symbols, _, repeats, failed = brute(t)
        value = {"words": n, "word_length": chars / max(n, 1), "symbols": symbols / max(n, 1), "repeats": repeats / max(n, 1)}[rule.feature]
        return failed or (value > rule.cut) == rule.above
    want = [(d, t) for d, t in plain(docs) if not rejected(t)]
    assert plain(kept) == want

    lines = stages["line_dedup"](spark, kept, sf)
    assert lines.columns == names
    want = sorted([(d, t) for d, t, *_ in test_linededup.brute(want)], key=str)
    assert plain(lines) == want
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    near = stages["near_duplicates"](spark, lines, sf)
    assert near.columns == names
    order = lambda d: float("inf") if d is None else d
    of = test_simhash.brute_components({order(d): test_simhash.brute_fp(t) for d, t in want})
    firsts = {d: t for d, t in want if of[order(d)] == order(d)}
    assert {d: t for d, t in plain(near)} == firsts and near.count() == len(firsts) < len(want)

    clean = stages["decontamination"](spark, near, sf)
    assert clean.columns == names
    hit = {d for d, _, n, _ in test_decontam.brute(list(firsts.items()), items) if n}
    assert plain(clean) == sorted([(d, t) for d, t in firsts.items() if d not in hit], key=str) and hit

    rows = [(r.doc_id, r.text) for r in clean.collect()]
    test_packing.check(rows, stages["packing"](spark, clean, sf).collect(), 2048)


def test_run_gives_the_last_stage(spark, tmp_path):
    write_tables(spark, str(tmp_path))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {"bin_id", "doc_id", "n_tokens"} <= set(out.columns) and out.count() > 0
