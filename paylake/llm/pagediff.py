"""Main text of HTML pages.

Method: nearest-URL page differencing. Within each host, pages are put in the order of
their URL paths, which makes the nearest URL a neighbour; the visible text lines of a
page and of its nearest neighbour are aligned by a longest common subsequence, and the
shared lines, the template of the site, are deleted.

What neighbours don't share, markup decides: text in elements that are menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles or reader comments by their tag,
role, class or id goes, and on a page that marks its article
(``article``, ``main``, ``itemprop=articleBody``) so does text outside it. Lines inside a marked article
are kept though a neighbour has them too: quotations and copies are the article's own text.
For the same reason a neighbour is not taken as evidence if it is a copy: pages of one host with
the same lines are one page (at the smallest of their URLs), and a neighbour that shares
``copy_share`` of the text or more makes way for the next nearest one.

A line is the text of a block: character references decoded, white space turned into
one space, trimmed.

Scale: what is paired are rows of line hashes (8 bytes a line), not texts. They are
dealt by ranges of (host, path, lines), so a host with a third of all pages is spread over
tasks; a page's neighbours are the rows numbered before and after it, and tasks meet at their
first and last rows by a table of one row per task. The only shuffle of the pages themselves
is the last join with the positions of the lines to delete. An alignment takes memory
in proportion to its lines, and bit-parallel time (lines x lines / 64).
"""

from __future__ import annotations

import html as entities
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paylake.llm.common import bounded_batches
from paylake.session import materialize

COPY_SHARE = 0.8

# HTML element and attribute names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math canvas object select datalist noembed noframes xmp".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
search section summary table tbody td tfoot th thead tr ul""".split())
OUTSIDE = frozenset("head nav header footer aside form fieldset button menu dialog search audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
ARTICLE = frozenset(("article", "main"))
#: An opening tag ends an open element of these names (and what is open inside it).
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",), "p": ("p",)}
#: Elements that ``ENDS`` doesn't look past.
HOLDS = frozenset("ul ol dl table tbody thead tfoot menu div section article main body".split())
# Words of class and id names that say what an element is.
OUTSIDE_WORDS = frozenset("""ad ads advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promotion banner
cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup
sidebar aside nav navbar navigation menu menus breadcrumb breadcrumbs toolbar topbar header masthead footer
comment comments commentlist commentform disqus respond reply replies related recommended recommendations share sharing social
widget widgets pagination pager login search skip""".split())
ARTICLE_CLASSES = frozenset("""article-body article-content articlebody article__body post-body post-content entry-content
story-body""".split())

_TAG = re.compile(r"""</?[A-Za-z][^\s/>]*+(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>""")
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
#: Attributes that :func:`_role` reads.
_TELLING = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _attributes(tag: str, name: str) -> dict[str, str]:
    return {k.lower(): entities.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(tag[1 + len(name):-1])}


def _role(name: str, attributes: dict[str, str]) -> str:
    """``outside``, ``article`` or nothing: what an element says of itself."""
    role = attributes.get("role", "").lower()
    if role in ROLES or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" \
            or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return "outside"
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    if name not in ("html", "body", "main"):
        for x in names:
            words = [w.lower() for w in _WORD.findall(x)]
            # has-sidebar, no-comments: said of the page, not of the element.
            if words and words[0] not in ("has", "with", "no", "without", "is") and not OUTSIDE_WORDS.isdisjoint(words):
                return "outside"
    if role in ("main", "article") or attributes.get("itemprop", "").lower() == "articlebody" \
            or not ARTICLE_CLASSES.isdisjoint(x.lower() for x in names):
        return "article"
    return ""


class Lines:
    """The visible lines of a page: ``text``, whether markup puts them ``outside`` of
    the article, and whether they are ``inside`` an element marked as the article."""

    def __init__(self, page: str):
        self.text: list[str] = []
        self.outside: list[bool] = []
        self.inside: list[bool] = []
        self._parts: list[str] = []
        #: Open elements: name, outside, inside.
        self._open: list[tuple[str, bool, bool]] = [("", False, False)]
        self._names: dict[str, int] = {}
        self._read(page)

    def _end_line(self) -> None:
        line = " ".join("".join(self._parts).split())
        self._parts.clear()
        if line:
            _, outside, inside = self._open[-1]
            self.text.append(line)
            self.outside.append(outside)
            self.inside.append(inside)

    def _pop(self) -> str:
        name = self._open.pop()[0]
        self._names[name] -= 1
        return name

    def _start(self, name: str, tag: str) -> None:
        _, outside, inside = self._open[-1]
        if name in BLOCK:
            self._end_line()
            ends = ENDS.get(name, ("p",))
            if any(self._names.get(x) for x in ends):
                for k in range(len(self._open) - 1, 0, -1):
                    if self._open[k][0] in ends:
                        while len(self._open) > k:
                            self._pop()
                        break
                    if self._open[k][0] in HOLDS:
                        break
            _, outside, inside = self._open[-1]
        if name in VOID or tag.endswith("/>") and name not in BLOCK:
            return
        says = _role(name, _attributes(tag, name)) if len(tag) > len(name) + 2 and _TELLING.search(tag) else ""
        # A header inside the article is the article's own.
        outside = outside or says == "outside" or name in OUTSIDE and not (name == "header" and inside)
        self._open.append((name, outside, inside or name in ARTICLE or says == "article"))
        self._names[name] = self._names.get(name, 0) + 1

    def _end(self, name: str) -> None:
        if name in BLOCK:
            self._end_line()
        if self._names.get(name):
            while self._pop() != name:
                pass

    def _read(self, page: str) -> None:
        at, n, lower = 0, len(page), None
        while at < n:
            tag_at = page.find("<", at)
            if tag_at < 0:
                tag_at = n
            if tag_at > at:
                text = page[at:tag_at]
                self._parts.append(entities.unescape(text) if "&" in text else text)
                if tag_at == n:
                    break
            if page.startswith("<!--", tag_at):
                at = page.find("-->", tag_at + 2) + 3
                at = n if at < 3 else at
                continue
            found = _NAME.match(page, tag_at)
            if not found:
                if page[tag_at + 1:tag_at + 2] in ("!", "?", "/"):
                    at = page.find(">", tag_at) + 1 or n
                else:  # no markup
                    self._parts.append("<")
                    at = tag_at + 1
                continue
            name = found[1].lower()
            whole = _TAG.match(page, tag_at)
            at = whole.end() if whole else page.find(">", tag_at) + 1 or n
            if page[tag_at + 1] == "/":
                self._end(name)
            elif name in RAW:
                if not page.startswith("/>", at - 2):
                    if lower is None:
                        lower = page.lower() if len(page.lower()) == n else page
                    close = lower.find("</" + name, at)
                    # An element without an end holds the rest, but for a title.
                    at = (page.find(">", close) + 1 or n) if close >= 0 else at if name == "title" else n
            else:
                if name == "br":
                    self._parts.append(" ")
                self._start(name, page[tag_at:at])
        self._end_line()


def line_hash(line: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def shared_lines(a: list, b: list) -> list[int]:
    """The positions in ``a`` that a longest common subsequence of ``a`` and ``b`` has."""
    found: list[int] = []
    parts = [(0, len(a), 0, len(b))]
    while parts:
        a0, a1, b0, b1 = parts.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append(a0)
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            found.append(a1 - 1)
            a1, b1 = a1 - 1, b1 - 1
        if a0 == a1 or b0 == b1:
            continue
        if a1 - a0 == 1:
            if a[a0] in b[b0:b1]:
                found.append(a0)
            continue
        middle = (a0 + a1) // 2
        ahead = _lengths(a[a0:middle], b[b0:b1])
        back = _lengths(a[middle:a1][::-1], b[b0:b1][::-1])
        cut = max(range(b1 - b0 + 1), key=lambda k: ahead[k] + back[b1 - b0 - k])
        parts += [(a0, middle, b0, b0 + cut), (middle, a1, b0 + cut, b1)]
    return sorted(found)


def _lengths(a: list, b: list) -> list[int]:
    """For each k, the length of a longest common subsequence of ``a`` and ``b[:k]``: one word
    of bits over ``b`` is updated for each element of ``a``; a zero bit is a step up."""
    at: dict = {}
    for k, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << k
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        if hits := at.get(x):
            common = row & hits
            row = (row + common | row - common) & full
    out = [0]
    for c in reversed(f"{row:0{len(b)}b}" if b else ""):
        out.append(out[-1] + (c == "0"))
    return out


def closeness(path: str, other: str) -> tuple[int, int]:
    """Leading path parts, then leading characters that two paths have in common."""
    same = lambda x, y: next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    return same(path.split("/"), other.split("/")), same(path, other)


def template_lines(path: str, lines: list[int], sizes: list[int], neighbours, copy_share: float = COPY_SHARE) -> list[int]:
    """The positions of the lines shared with the nearest neighbour (path, lines) that is no copy."""
    total = sum(sizes)
    for _, other in sorted(neighbours, key=lambda x: closeness(path, x[0]), reverse=True):
        shared = shared_lines(lines, other)
        if sum(sizes[k] for k in shared) < copy_share * total:
            return shared
    return []


def _hash_lines(batches):
    """Host, path and id pass through; of the page stay its line hashes and lengths."""
    import pyarrow as pa

    for b in batches:
        hashes, sizes = [], []
        for page in b.column(b.num_columns - 1).to_pylist():
            found = Lines(page or "").text
            hashes.append([line_hash(x) for x in found])
            sizes.append([len(x) for x in found])
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32()))],
                                         names=[*b.schema.names[:-1], "lines", "sizes"])


def _align(copy_share: float):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for _, _, path, lines, sizes, p1, l1, p2, l2 in zip(*[c.to_pylist() for c in b.columns]):
                others = [(p, x) for p, x in ((p1, l1), (p2, l2)) if x is not None]
                out.append(template_lines(path, lines, sizes, others, copy_share))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.int32()))],
                                             names=["host", "digest", "shared"])
    return run


def _extract(batches):
    import pyarrow as pa

    for b in batches:
        texts, total, shared_n, outside_n = [], [], [], []
        for page, shared in zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
            found, shared = Lines(page or ""), set(shared or ())
            marked = any(i and not o for i, o in zip(found.inside, found.outside))
            template = {k for k in shared if not (found.inside[k] and not found.outside[k])}
            kept = [k for k in range(len(found.text)) if k not in template and not found.outside[k] and (found.inside[k] or not marked)]
            texts.append("\n\n".join(found.text[k] for k in kept).encode("utf-8", "replace"))
            total.append(len(found.text))
            shared_n.append(len(template))
            outside_n.append(len(found.text) - len(template) - len(kept))
        yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(texts, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()),
                                          pa.array(shared_n, pa.int64()), pa.array(outside_n, pa.int64())],
                                         names=[*b.schema.names[:-2], "text", "n_lines", "n_shared", "n_outside"])


def neighbours(rows: DataFrame) -> DataFrame:
    """``rows`` ``(host, path, digest, ...)``, unique by host and digest, with the ``path`` and ``lines`` of the
    rows before and after in the order of host and path (null at the ends of a host)."""
    ordered = materialize(rows.repartitionByRange("host", "path", "digest").sortWithinPartitions("host", "path", "digest")
                          .withColumn("seq", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()), "page-order")
    # One row per task: where its rows begin and end, and so where the tasks beside it do.
    order = Window.orderBy("part")
    ends = (ordered.groupBy("part").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
            .select("part", "first", "last", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after")))
    linked = (ordered.join(F.broadcast(ends), "part")
              .withColumn("prev", F.when(F.col("seq") == F.col("first"), F.col("before")).otherwise(F.col("seq") - 1))
              .withColumn("next", F.when(F.col("seq") == F.col("last"), F.col("after")).otherwise(F.col("seq") + 1))
              .drop("part", "first", "last", "before", "after"))
    for side in ("prev", "next"):
        beside = ordered.select(F.col("seq").alias(side), F.col("host").alias("host_b"), F.col("path").alias(f"{side}_path"),
                                F.col("lines").alias(f"{side}_lines"))
        linked = linked.join(beside, side, "left")
        same = F.col("host_b") == F.col("host")
        linked = linked.withColumns({c: F.when(same, F.col(c)) for c in (f"{side}_path", f"{side}_lines")}).drop("host_b")
    return linked


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              copy_share: float = COPY_SHARE) -> DataFrame:
    """Rows ``(<id_col>, <url_col>, text, n_lines, n_shared, n_outside)``, one for each input row.

    ``text`` is the main text, its blocks joined by an empty line; of the page's
    ``n_lines`` lines, ``n_shared`` were deleted as shared with the nearest page and
    ``n_outside`` more by what markup says of them.

    - null or empty html, or a page without text: empty ``text``;
    - null url, or one without a host: no neighbours, markup alone decides; so for the only page of a host;
    - ties of nearness: the page before it in the order;
    - repeated rows and copies under other URLs of a host are one page to their neighbours,
      and each row gets that page's result; null and repeated ids are allowed;
    - very long pages are read whole; markup that is cut off or not nested is read as far as it goes;
    - other columns are ignored, whatever their names; an empty table gives none.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    url, page = F.col(url_col).cast("string"), F.col(html_col).cast("string")
    host = F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1), "/+$", "")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.xxhash64(url, page).alias("body"), host.alias("host"),
                        path.alias("path"), page.alias("page"))
    id_kind, url_kind = (rows.schema[c].dataType.simpleString() for c in ("id", "url"))
    hashed = materialize(rows.filter("host <> '' AND page IS NOT NULL").select("id", "body", "host", "path", "page").mapInArrow(
        _hash_lines, f"id {id_kind}, body long, host string, path string, lines array<bigint>, sizes array<int>")
        .withColumn("digest", F.xxhash64("lines")), "page-lines")
    # Pages of a host with the same lines are one.
    different = hashed.groupBy("host", "digest").agg(F.min(F.struct("path", "lines", "sizes")).alias("x")).select("host", "digest", "x.*")
    linked = neighbours(different).select("host", "digest", "path", "lines", "sizes", "prev_path", "prev_lines", "next_path", "next_lines")
    shared = materialize(linked.mapInArrow(_align(copy_share), "host string, digest long, shared array<int>")
                         .filter(F.size("shared") > 0), "page-shared")
    # By row, so that the copies of one page don't meet in one place.
    drops = (hashed.select("id", "body", "host", "digest").join(shared, ["host", "digest"])
             .groupBy("id", "body").agg(F.first("shared").alias("shared")))
    out = (rows.join(drops, rows["id"].eqNullSafe(drops["id"]) & (rows["body"] == drops["body"]), "left")
           .select(rows["id"], rows["url"], rows["page"], drops["shared"])
           .mapInArrow(_extract, f"id {id_kind}, url {url_kind}, text string, n_lines long, n_shared long, n_outside long"))
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
