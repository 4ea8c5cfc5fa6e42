import hashlib
from collections import defaultdict

from paylake.llm import linededup
from tests.llm.helpers import corpus, docs_frame

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    at = defaultdict(set)
    key = lambda x: x.strip(SPACE).translate(LOWER)
    order = lambda d: float("inf") if d is None else d
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                at[key(line)].add(order(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(at.get(key(x), ())) >= 2 and min(at[key(x)]) != order(d))]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rows = corpus(1)
    rows += [(100, " Same Long line \nunique é line one\nSAME long LINE"), (101, "same long line\t\nshort\nshort"), (102, "short"),
             (103, "éééééééééé\nñññññ"), (104, "éééééééééé\nñññññ"), (105, "ÉÉÉÉÉÉÉÉÉÉ")]
    df = docs_frame(spark, rows, ["line_hash", "id", "gone", "k_text", "n_lines"])
    got = linededup.dedup_lines(df).collect()
    assert sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got], key=str) == brute(rows)


def test_hot_line_and_long_text(spark):
    hot = "a line that a third of all documents hold"
    rows = [(i, f"{hot}\nown line number {i} here\n{hot}") for i in range(300)]
    rows.append((1000, "\n".join(f"long text line {i}" for i in range(20000)) + "\n" + hot))
    got = {r.doc_id: r for r in linededup.dedup_lines(docs_frame(spark, rows)).collect()}
    assert got[0].n_dropped == 0 and all(got[i].n_dropped == 2 for i in range(1, 300))
    assert got[1000].n_lines == 20001 and got[1000].n_dropped == 1


def test_stage_keeps_columns_and_empty_table(spark):
    df = docs_frame(spark, [(1, None), (2, "some longer line"), (3, "some longer line\nb")])
    out = linededup.without_shared_lines(df)
    assert out.columns == df.columns
    assert {(r.doc_id, r.text, r.n_chars) for r in out.collect()} == {(1, None, None), (2, "some longer line", 16), (3, "b", 1)}
    assert linededup.dedup_lines(df.limit(0)).count() == 0


def test_threshold(spark):
    rows = [(i, "shared by three of them") for i in range(3)] + [(i, "shared by two of them") for i in (7, 8)]
    got = {r.doc_id: r.n_dropped for r in linededup.dedup_lines(docs_frame(spark, rows), min_docs=3).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 7: 0, 8: 0}


def test_query_digest(spark):
    from paylake.llm.queries import op6_linededup
    row = op6_linededup(spark, "/root/testdata/sf0.001").filter("n_dropped = 0").first()
    doc = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter(f"doc_id = {row.doc_id}").first()
    assert row.kept_sha256 == hashlib.sha256(doc.text.encode()).hexdigest()


def test_missing_ids_are_one_document(spark):
    shared, rows = "a shared line of some length", []
    for k in range(5):
        rows.append((None, f"{shared}\nanother line {k} of this one"))
    rows.append((8, shared))
    got = sorted((r.doc_id, r.n_dropped) for r in linededup.dedup_lines(docs_frame(spark, rows)).collect() if r.doc_id is not None)
    assert got == [(8, 0)]
    assert [r.n_dropped for r in linededup.dedup_lines(docs_frame(spark, rows)).collect() if r.doc_id is None] == [1] * 5
    assert brute(rows) == sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in linededup.dedup_lines(docs_frame(spark, rows)).collect()], key=str)
