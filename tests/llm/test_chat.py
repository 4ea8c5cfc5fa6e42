import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from paylake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def read(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.selectExpr("*", "1 as turns", "2 as formatted", "3 as conv", "4 as body")
    out = chat.read_back(chat.format_chats(df)).select("*", chat.loss_text(chat.F.col("turns")).alias("loss"))
    return {r.conv_id: r for r in out.collect()}


def test_round_trip_of_control_strings(spark):
    texts = ["", "<|end|>", "\\", "\\l|", "<|", "<", "|>", "a<|sep|>b", "\\\\l\\<|", "<<|role:x|>", "\\### Assistant: </turn> ok", "é\n"]
    rows = [(1, i, ("user", "assistant", "<|a|>", "r|", "\\g|>")[i % 5], t) for i, t in enumerate(texts)]
    got = read(spark, rows, extra=True)[1]
    assert [(t.role, t.text) for t in got.turns] == [(r[2], r[3]) for r in rows]


def test_merging_and_order(spark):
    rows = [(1, 2, "assistant", "c"), (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 3, "assistant", "d"), (1, 4, "user", "e")]
    got = read(spark, rows)[1]
    assert got.formatted == "<|role:user|>a<|sep|>b<|end|><|role:assistant|>c<|sep|>d<|end|><|role:user|>e<|end|>"
    assert [t.text for t in got.turns] == list("abcde") and got.loss == "cd"


def test_nulls_ties_and_repeats(spark):
    rows = [(None, 1, "user", None), (5, None, None, "late"), (5, 1, "user", "b"), (5, 1, "user", "a"), (5, 1, "user", "a")]
    got = read(spark, rows)
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "")]
    assert [(t.role, t.text) for t in got[5].turns] == [("user", "a"), ("user", "a"), ("user", "b"), ("", "late")]
    assert read(spark, []) == {}


def test_long_conversation(spark):
    rows = [(9, i, "user" if i % 3 else "assistant", "t" * (i % 7)) for i in range(20000)]
    got = read(spark, rows)[9]
    assert [(t.role, t.text) for t in got.turns] == [(r[2], r[3]) for r in rows]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "|>", "\\"]), st.text("\\<|>lgé \n", max_size=12)), min_size=1, max_size=8))
def test_any_texts_come_back(spark, turns):
    got = read(spark, [(1, i, r, t) for i, (r, t) in enumerate(turns)])[1]
    assert [(t.role, t.text) for t in got.turns] == turns


def test_query_adds_the_tricky_conversation(spark):
    from paylake.llm.queries import op4_chat
    row = op4_chat(spark, "/root/testdata/sf0.001").filter("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert row.n_turns == 2 and row.loss_chars == len(text)
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
