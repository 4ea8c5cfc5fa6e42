import random
import re

from paylake.llm import decontam
from tests.llm.helpers import corpus, docs_frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(rows, items, n=10):
    out = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            v = words(text)
            size = min(n, len(v))
            wins = {tuple(v[i:i + size]) for i in range(len(v) - size + 1)} if v else set()
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in wins:
                    hit.update(range(i, i + size))
                    found.add(str(item))
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def tables(spark):
    rng, rows = random.Random(5), corpus(2)
    items = [(k, " ".join(words(rows[k][1])[3:3 + rng.randint(1, 14)])) for k in range(12)]
    items += [(50, None), (51, ""), (52, "?!"), (53, "zz " * 12), (54, items[0][1]), (0, items[0][1])]
    rows += [(200, "zz " * 30), (201, "É" + "zz " * 9), (202, "ZZ-zz. " * 5)]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as win", "2 as starts")
    return rows, items, docs_frame(spark, rows, ["items", "starts", "body", "n_hit"]), bench


def test_against_brute_force(spark):
    rows, items, df, bench = tables(spark)
    got = decontam.decontaminate(df, bench).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got], key=str) == brute(rows, items)
    assert any(r.contaminated for r in got) and not all(r.contaminated for r in got)


def test_blocks_give_the_same(spark):
    rows, items, df, bench = tables(spark)
    got = decontam.decontaminate(df, bench, max_windows=7).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got], key=str) == brute(rows, items)


def test_removal(spark):
    leak = "one two three four five six seven eight nine ten eleven"
    df = docs_frame(spark, [(1, f"Before, {leak.upper()}! After"), (2, "clean text one two three"), (3, None), (4, "x " * 50000 + leak)])
    bench = spark.createDataFrame([("q", leak)], "item_id string, text string")
    cut = {r.doc_id: r.text for r in decontam.without_contaminated(df, bench, remove="spans").collect()}
    assert cut[1] == "Before, ! After" and cut[2] == "clean text one two three" and cut[3] is None and cut[4] == "x " * 50000
    gone = decontam.without_contaminated(df, bench)
    assert gone.columns == df.columns and sorted(r.doc_id for r in gone.collect()) == [2, 3]


def test_empty_tables(spark):
    rows, items, df, bench = tables(spark)
    assert decontam.decontaminate(df.limit(0), bench).count() == 0
    assert decontam.decontaminate(df, bench.limit(0)).filter("contaminated").count() == 0


def test_a_window_of_many_items_is_spread_over_blocks(spark, monkeypatch):
    """The blocks stay small though most pairs are of one window, and no item is lost."""
    preamble = " ".join(f"p{k}" for k in range(10))
    bench = spark.createDataFrame([(f"i{k:03d}", preamble) for k in range(200)] + [("z", "some other words")], "item_id string, text string")
    docs = docs_frame(spark, [(1, f"x {preamble} y"), (2, "some other words"), (3, "nothing")])
    sizes, scanner = [], decontam._scan
    monkeypatch.setattr(decontam, "_scan", lambda held, at: sizes.append(len(held.value)) or scanner(held, at))
    got = {r.doc_id: r for r in decontam.decontaminate(docs, bench, max_windows=20).collect()}
    assert got[1]["items"] == [f"i{k:03d}" for k in range(200)] and got[1].n_hit == 10
    assert got[2]["items"] == ["z"] and got[3]["items"] == []
    assert len(sizes) == 11 and max(sizes) < 60
