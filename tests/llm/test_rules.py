import random
import re
from collections import Counter

from paylake.llm import rules
from tests.llm.helpers import corpus, docs_frame, random_text

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    wins = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    often = Counter(wins)
    hit = {j for i, x in enumerate(wins) if often[x] > 1 for j in range(i, i + 8)}
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
            n < 20 or 100 * len(hit) > 30 * n)


def odd_rows():
    rng = random.Random(11)
    rows = [r for r in corpus(8)]
    rows += [(100 + i, random_text(rng, ["a", "b"], rng.randint(1, 60), 0.2)) for i in range(60)]
    rows += [(300, "x y z q r s t u " * 500), (301, "one line\n\none line\n one line\none line"), (302, "a | b # c $5 <x> & *%"),
             (303, " ".join(f"u{i}" for i in range(50)) + " " + " ".join(f"u{i}" for i in range(20, 30))), (304, "  é x"),
             (305, " ".join(str(i) for i in range(30000)))]
    return rows


def test_statistics_against_brute_force(spark):
    rows = odd_rows()
    df = docs_frame(spark, rows, ["n_words", "l_h", "l_text", "kept", "rule"])
    got = rules.statistics(df.withColumn("k", rules.F.monotonically_increasing_id()), keep=("text",)).collect()
    want = Counter((t, *brute(t)) for _, t in rows)
    assert Counter((r.k_text, *(r[s] for s in rules.STATS), r.base_failed) for r in got) == want


def labelled(spark, n=400):
    rng = random.Random(12)
    words = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        t = random_text(rng, words, rng.randint(30, 80))
        if bad:
            t = t.replace(" ", " # ") if i % 2 else re.sub(" ", "!!! ", t).upper()
        rows.append((i, t))
        labels.append((i, int(not bad)))
    return rows, labels


def test_learned_list_and_verdict(spark):
    rows, labels = labelled(spark)
    lab = spark.createDataFrame(labels + [(3, None), (None, 0), (9999, 0), (7, 9)], "doc_id long, quality int")
    judged, found = rules.judge(docs_frame(spark, rows, ["kept", "bad", "f_words"]), lab, ("doc_id", "text"))
    assert 1 <= len(found) <= 4
    got = {r.k_doc_id: r.kept for r in judged.collect()}
    wrong = [i for i, good in labels if got[i] != bool(good)]
    assert len(wrong) <= 0.02 * len(labels)
    assert not [i for i in wrong if labels[i][1]]  # clean documents stay


def test_the_expression_is_ordered(spark):
    list_ = [(rules.Condition("words", True, 10.0),), (rules.Condition("words", True, 5.0), rules.Condition("symbols", False, 0.5))]
    df = spark.createDataFrame([(20.0, 0.0), (7.0, 0.0), (7.0, 1.0), (1.0, 0.0)], "f_words double, f_symbols double")
    assert [r[0] for r in df.select(rules.verdict(list_)).collect()] == [1, 2, None, None]


def test_no_labels_and_empty_tables(spark):
    rows, labels = labelled(spark, 40)
    none = spark.createDataFrame([], "doc_id long, quality int")
    judged, found = rules.judge(docs_frame(spark, rows + [(None, None)]), none, ("doc_id",))
    assert found == [] and judged.filter("kept").count() == 40
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    assert rules.judge(docs_frame(spark, []), lab, ("doc_id",))[0].count() == 0
    one_kind = rules.judge(docs_frame(spark, rows), lab.filter("quality = 1"), ("doc_id",))
    assert one_kind[1] == []


def test_native(spark):
    judged, _ = rules.judge(docs_frame(spark, labelled(spark, 40)[0]), spark.createDataFrame([], "doc_id long, quality int"), ("doc_id",))
    plan = rules.statistics(docs_frame(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
