import random

from paylake.llm import langid
from tests.llm.helpers import docs_frame

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu", "ren"], "bb": ["ste", "gri", "pfu", "och", "ein"], "cc": ["é", "eau", "oui", "ç", "la"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def brute_phrases(data, train):
    """Greedy longest matches by substring search over the whole text."""
    count, i, parts = 0, 0, train.split(b"\0")
    while i < len(data):
        n = 1
        while i + n <= len(data) and any(data[i:i + n] in t for t in parts):
            n += 1
        i += max(1, n - 1)
        count += 1
    return count


def test_phrase_counts_against_brute_force():
    rng = random.Random(1)
    sample = [(lang, b"\0".join(text(rng, lang, 30).encode() for _ in range(3))) for lang in SYLLABLES]
    parser = langid.Parser(sample)
    texts = [text(rng, lang, n).encode() for lang in SYLLABLES for n in (1, 5, 400)] + [b"q", b"zzqq kalo", "ж".encode()]
    got = parser.phrases(texts)
    assert got.tolist() == [[brute_phrases(t, train) for _, train in sample] for t in texts]
    # as many tables as it takes, each with an alphabet of its own
    for most in (1, 8000):
        dealt = langid.Parser(sample, most)
        assert len(dealt.tables) > 1 and dealt.phrases(texts).tolist() == got.tolist()


def test_many_languages_and_alphabets():
    rng = random.Random(9)
    letters = "абвгдежз αβγδεζηθ אבגדהוזח かきくけこさしす abcdefgh".split()
    sample = [(f"{k:02d}", "".join(rng.choice(letters[k % 5]) for _ in range(200)).encode()) for k in range(40)]
    parser = langid.Parser(sample, 20_000)
    assert len(parser.tables) > 3
    texts = [sample[k][1][20:120] for k in (0, 7, 39)] + [b""]
    assert parser.phrases(texts).tolist() == [[brute_phrases(t, train) for _, train in sample] for t in texts]
    best, _ = parser.predict(texts[:3])
    assert best.tolist() == [0, 7, 39]


def test_suffix_automaton_has_all_substrings():
    data = b"abcabcaabbcc"
    go = langid.suffix_automaton(data)
    subs = {data[i:j] for i in range(len(data)) for j in range(i + 1, len(data) + 1)}
    def accepts(x):
        s = 0
        for c in x:
            if c not in go[s]:
                return False
            s = go[s][c]
        return True
    assert all(map(accepts, subs)) and not accepts(b"ac") and not accepts(b"ccc")


def test_held_out_accuracy_and_cases(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, lang, rng.randint(3, 80)), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    odd = [(900, None, "aa"), (901, "", None), (902, "123 !?", "bb"), (None, text(rng, "bb", 20), None), (904, text(rng, "cc", 40000), None),
           (5, rows[5][1], rows[5][2])]
    df = docs_frame(spark, rows + odd, ["body", "h", "rank", "lang_pred", "score", "ok"])
    sample = langid.learn(df.filter(~langid.held_out(langid.F.col("doc_id"))))
    assert [lang for lang, _ in sample] == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in langid.identify(df, sample).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert [got[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0
    assert got[None].lang_pred == "bb" and got[904].lang_pred == "cc"
    assert langid.identify(df, sample).count() == len(rows) + len(odd)
    assert langid.identify(df.limit(0), sample).count() == 0
    assert {r.lang_pred for r in langid.identify(df.limit(5), []).collect()} == {"und"}
    one = langid.identify(df.limit(5), sample[:1]).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("aa", 1.0)}


def test_sample_is_bounded_and_ignores_copies(spark):
    rows = [(i, "ka lo mi tu " * 500, "aa") for i in range(500)] + [(600 + i, f"ste gri {'pfu ' * i}", "bb") for i in range(200)]
    sample = dict(langid.learn(docs_frame(spark, rows), texts=4, chars=100))
    assert len(sample["aa"]) <= 100 and len(sample["bb"].split(b"\0")) == 4


def test_ties_go_to_the_first_name(spark):
    df = docs_frame(spark, [(1, "ka lo"), (1, "ka lo")])
    got = langid.identify(df, [("x", b"ka lo"), ("y", b"ka lo")]).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("x", 0.0)] * 2


def test_query_on_held_out_documents(spark):
    from paylake.llm.queries import op1_langid
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    got = op1_langid(spark, "/root/testdata/sf0.001").join(docs, "doc_id").filter("held_out and lang is not null").collect()
    assert got and sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)
