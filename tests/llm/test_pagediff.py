import random

import pytest

from paylake.llm import pagediff as P


def pages_frame(spark, rows, extra=()):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in extra:
        df = df.selectExpr("*", f"'x' as `{c}`")
    return df


def texts(spark, rows, extra=(), **options):
    return sorted(((r.page_id, r.text) for r in P.main_text(pages_frame(spark, rows, extra), **options).collect()), key=str)


def longest(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(1500):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 20))] for _ in "ab")
        shared = P.shared_lines(a, b)
        at = iter(b)
        assert shared == sorted(set(shared)) and len(shared) == longest(a, b) and all(a[k] in at for k in shared)


def lines_of(page):
    x = P.Lines(page)
    return x.text, x.outside, x.inside


def kept(page):
    x = P.Lines(page)
    marked = any(i and not o for i, o in zip(x.inside, x.outside))
    return [t for t, o, i in zip(x.text, x.outside, x.inside) if not o and (i or not marked)]


@pytest.mark.parametrize("page,expected", [
    ("<p>a &amp; b&nbsp;&#233;&lt;i&gt;</p><p>c<br>d\n\t e</p>", ["a & b é<i>", "c d e"]),
    ("<article><h1>T</h1><p><b>one<br><p>two</b> <i>x</i>y</article><footer>f</footer>", ["T", "one", "two xy"]),
    ("<nav><ul><li>m</ul></nav><main><p>x<aside>s</aside>y</main><div>out</div>", ["x", "y"]),
    ("<body class='has-sidebar'><div id=sidebar>s<div>s2</div></div><div class='cookieNotice'>n</div><p>text", ["text"]),
    ("<div class=comment-list><article>c</article></div><article>a</article>", ["a"]),
    ("<script>if (a<b) '<p>x</p>'</script><style>p{}</style><!-- <p>c</p> --><p>t</p><textarea><p>q</textarea>", ["t"]),
    ("<form><p>f</p><input value='x'></form><p hidden>h</p><p style='display: none'>d</p><p role=alert>r</p>z", ["z"]),
    ("<article><header><h1>T</h1></header><p>x</article><header>H</header>", ["T", "x"]),
    ("<ul><li class=ad>no<li>yes</ul><table><tr><td>1<td>2</table>", ["yes", "1", "2"]),
    ("a < b <3 <p title='>'>c</p> &am &amp &unknown;", ["a < b <3", "c", "&am & &unknown;"]),
    ("<title>t</title><div class='article-body'><p>in</p></div><p>out</p>", ["in"]),
    ("<p>cut <a href='x", ["cut"]), ("<p>open<script>x", ["open"]), ("<!-- open <p>x", []), ("", []), ("   ", []), ("</p></div>x", ["x"]),
    ("<P CLASS='AD'>no</P><DIV>yes</DIV>", ["yes"]), ("<p>a</p></body></html>", ["a"]),
])
def test_lines_of_markup(page, expected):
    assert kept(page) == expected


def site(k, body, extra=""):
    return f"<div>Home</div><div>News</div><p>{body}</p>{extra}<p>Contact us</p>"


def test_lines_shared_with_the_nearest_page_go(spark):
    rows = [(1, "http://h.org/a/1", site(1, "first text here")), (2, "http://h.org/a/2?x=1", site(2, "second one is here")),
            (3, "http://h.org/b/9", site(3, "third is about more")), (4, "http://other.org/a/1", site(4, "alone on its host")),
            (5, None, site(5, "no url")), (6, "no host", site(6, "no host"))]
    alone = lambda x: f"Home\n\nNews\n\n{x}\n\nContact us"
    assert texts(spark, rows, ["id", "host", "path", "body", "text", "shared", "lines", "page"]) == [
        (1, "first text here"), (2, "second one is here"), (3, "third is about more"), (4, alone("alone on its host")),
        (5, alone("no url")), (6, alone("no host"))]


def test_the_nearest_url_is_the_partner(spark):
    rows = [(1, "http://h.org/a/b/1", "<p>one one</p><p>menu of a</p>"), (2, "http://h.org/a/b/2", "<p>two two</p><p>menu of a</p>"),
            (3, "http://h.org/c/1", "<p>two two</p><p>menu of c</p><p>three three</p>"), (4, "http://h.org/c/2", "<p>four four</p><p>menu of c</p>")]
    # page 3 lies beside 2, with which it shares a line, but 4 is nearer
    assert texts(spark, rows) == [(1, "one one"), (2, "two two"), (3, "two two\n\nthree three"), (4, "four four")]
    assert P.closeness("/a/b/2", "/a/b/1") > P.closeness("/a/b/2", "/a/c/2") > P.closeness("/a/b/2", "/c/1")


def test_copies_and_marked_articles_keep_their_text(spark):
    copy = "<p>the very same text of some length</p><p>and more</p>"
    quoted = "<p>site menu</p><article><p>a shared quotation of some length</p><p>own {}</p></article>"
    rows = [(1, "http://h.org/1", copy), (2, "http://h.org/1", copy), (3, "http://h.org/2", copy),
            (4, "http://q.org/1", quoted.format("one")), (5, "http://q.org/2", quoted.format("two"))]
    whole = "the very same text of some length\n\nand more"
    assert texts(spark, rows) == [(1, whole), (2, whole), (3, whole), (4, "a shared quotation of some length\n\nown one"),
                                  (5, "a shared quotation of some length\n\nown two")]
    # a near copy is no evidence, the page behind it is
    near = [(1, "http://n.org/a1", site(1, "a long text that was changed in one word only, all else is as before and goes on")),
            (2, "http://n.org/a2", site(2, "a long text that was changed in one word only, all else is as before and goes on", "<p>x</p>")),
            (3, "http://n.org/b", site(3, "another text"))]
    assert dict(texts(spark, near))[2].startswith("a long text that was changed") and "Home" not in dict(texts(spark, near))[2]


def test_odd_rows(spark):
    rows = [(None, "http://h.org/1", site(1, "text a")), (None, "http://h.org/2", site(2, "text b")), (7, "http://h.org/3", None),
            (8, "http://h.org/4", ""), (9, "HTTP://u@H.org:80/5", site(9, "text c")), (9, "HTTP://u@H.org:80/5", site(9, "text c"))]
    got = texts(spark, rows)
    assert sorted(t for i, t in got if i is None) == ["text a", "text b"]
    assert [t for i, t in got if i in (7, 8)] == ["", ""] and sum(i == 9 for i, _ in got) == 2
    assert P.main_text(pages_frame(spark, rows).limit(0)).count() == 0


def test_a_hot_host_and_a_very_long_page(spark):
    rows = [(k, f"http://hot.org/p/{k:04d}", f"<p>menu one</p><p>own text {k}</p><p>menu two {k // 2}</p>") for k in range(400)]
    long = "".join(f"<p>line {k}</p>" for k in range(30_000))
    rows += [(1000, "http://long.org/1", f"<p>top</p>{long}<p>end</p>"), (1001, "http://long.org/2", "<p>top</p><p>other text of this page</p><p>end</p>")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = dict(texts(spark, rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # every page has a neighbour of its own section, over the bounds of tasks too
    assert all(got[k] in (f"own text {k}", f"own text {k}\n\nmenu two {k // 2}") for k in range(400))
    assert got[1000] == "\n\n".join(f"line {k}" for k in range(30_000)) and got[1001] == "other text of this page"


def test_neighbours_against_sorting(spark):
    rng = random.Random(3)
    rows = [(f"h{rng.randrange(4)}", f"/{rng.randrange(50)}", k, [k], [1]) for k in range(300)]
    df = spark.createDataFrame(rows, "host string, path string, digest long, lines array<long>, sizes array<int>").repartition(9)
    order = sorted(rows)
    expected = {}
    for k, (host, path, digest, *_) in enumerate(order):
        beside = lambda j: order[j][3] if 0 <= j < len(order) and order[j][0] == host else None
        expected[digest] = (beside(k - 1), beside(k + 1))
    assert {r.digest: (r.prev_lines, r.next_lines) for r in P.neighbours(df).collect()} == expected
