"""Secret scans.

Method: assignment-aware lexing. Lines with an assignment (``name = value``,
``name: value``, ``"name": "value"``, ``name := value``, ``name => value``, ``<name>value``
or ``name="value"`` attributes) are parsed into pairs of a name and a literal or a
reference. Values may be in brackets, lists or a call's arguments, begin on the next line, go on
over lines or be a YAML block scalar. Constants are propagated: a reference, or a concatenation of literals and
references, stands for the literals that earlier lines gave those names. Literals are
scored by how sensitive the target's name is and by what the literal looks like.

The three base patterns are always reported. A literal found by the method is
reported as ``literal``, at the place of the literal itself (for a propagated constant,
where it was written), unless a base span of kind ``assign`` covers it.

Scale: one pass without a shuffle over whole texts, linear in the text but for the
constants of one document, which are looked up by name.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import bounded_batches

#: The base patterns and the least length that counts (of the group, or of the match).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "literal")

#: How sensitive a part of a name is (a name's parts are split at case changes and separators).
NAME_WEIGHT = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "private": 0.6, "auth": 0.6, "access": 0.4, "key": 0.5, "pass": 0.8,
    "bearer": 0.8, "signature": 0.5, "salt": 0.5, "dsn": 0.5, "api": 0.3, "client": 0.1, "signing": 0.4, "encryption": 0.4,
}
#: Values that stand for a secret without being one.
PLACEHOLDER = re.compile(r"(?:x+|\*+|\.+|change_?me|your[-_ ]?\w*|example\w*|dummy|test|none|null|nil|true|false|todo|<.*|\$\{.*|\{\{.*|%.*)\Z", re.I)
LEAST = 1.1
#: Names of schemes that stand before a token, what several words score, and words of messages (fixed values).
SCHEMES = frozenset(("bearer", "basic", "token", "apikey", "digest"))
PASSPHRASE = 0.2
MESSAGE_WORDS = frozenset("""a an and are be can cannot choose confirm do does enter for forgot from has have here how if in incorrect invalid is it
least must my new no not of on or our please required reset should that the their this to too type use use was we when will with you your""".split())
_NAME = re.compile(r"[A-Za-z_$][\w.$-]*\Z")
_SUBSCRIPT = re.compile(r"""\[\s*["'][^"'\n]+["']\s*\]\Z""")
#: A literal may have a prefix of its language (f, r, b, u, $, @).
_ITEM = re.compile(r"""\s*(?:[fFrRbBuU$@]{1,2}(?=["']))?(?:(?P<q>\"{3}|'{3}|`)(?P<long>(?:\\[\s\S]|(?!(?P=q))[^\\])*)(?P=q)|(?P<r>["'])(?P<lit>(?:\\[\s\S]|(?!(?P=r))[^\\\n])*)(?P=r)|(?P<bare>[^\s"'`,;(){}\[\]<>+]+))""")
#: Before a value: blanks up to it, over a line's end, and what opens a bracket or a call.
_GAP = re.compile(r"[^\S\n]*(?:\\?\r?\n\s*)?")
_OPENS = re.compile(r"(?:new\s+)?(?:[A-Za-z_$][\w.$:]*!?)?[(\[{]")
_BLOCK = re.compile(r"[^\S\n]*[|>][-+0-9]*[^\S\n]*(?:#[^\n]*)?\n")
_BRACKETS = re.compile(r"""\"{3}[\s\S]*?\"{3}|"(?:\\[\s\S]|[^"\\\n])*"|'(?:\\[\s\S]|[^'\\\n])*'|`[^`]*`|[()\[\]{}]""")
#: What a bracket holds: a literal, a name's sign, a bracket, the end of an item.
_INSIDE = re.compile(r"""["'`]|:=|=>|[:=]|[(\[{]|,|[A-Za-z_$][\w.$]*""")
_LOOKUP = re.compile(r"[A-Z][A-Z0-9_]*\Z")
_HINT = re.compile(r"[=:]|<[A-Za-z_$][\w.$-]*>")
_JOIN = re.compile(r"""\s*(?:\\\r?\n\s*)?(?:\+|\.\.?(?=\s*["']))(?:\s*\\\r?\n)?|[^\S\n]*\\\r?\n\s*(?=["'])""")
_SIGN = re.compile(r":=|=>|[:=]+|(?<=\w)>")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def name_weight(name: str) -> float:
    """The sum of the parts' weights; ``api_key`` and ``apiKey`` count as ``apikey`` too."""
    parts = [p.lower() for p in _PART.findall(name)]
    return sum(NAME_WEIGHT.get(p, 0.0) for p in dict.fromkeys(parts)) + (0.3 if "".join(parts).endswith("apikey") else 0.0)


def literal_score(value: str) -> float:
    """From -1 (a placeholder or too short) to about 1, by length, entropy and kinds of characters.

    A value with blanks counts by its words: what follows the name of a scheme (``Bearer``) is scored
    by itself; three words or more make a passphrase, unless some of them are those of a message."""
    words = value.split()
    if len(words) == 2 and words[0].lower().rstrip(":") in SCHEMES:
        return literal_score(words[1])
    if len(words) > 1:
        plain = [w.lower().strip(".,;:!?") for w in words]
        return PASSPHRASE if 3 <= len(words) <= 24 and not MESSAGE_WORDS.intersection(plain) and value[-1] not in ".!?:" else -1.0
    if len(value) < 6 or PLACEHOLDER.match(value):
        return -1.0
    counts = Counter(value)
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, bits / 4.5) * 0.7 + 0.1 * (kinds - 1) + (0.1 if len(value) >= 16 else 0.0)


def _lines(text: str):
    """The start and end of every line that holds an assignment's sign or a ``<name>``."""
    at, size = 0, len(text)
    while at < size:
        m = _HINT.search(text, at)
        if not m:
            return
        hit = m.start()
        start = text.rfind("\n", 0, hit) + 1
        end = text.find("\n", hit)
        end = size if end < 0 else end
        yield start, end
        at = end + 1


def _closing(text: str) -> dict[int, int]:
    """Where each bracket outside of quotes is closed."""
    out, stack = {}, []
    for m in _BRACKETS.finditer(text):
        c = m.group()
        if c in "([{":
            stack.append((c, m.start()))
        elif c in ")]}" and stack and stack[-1][0] == "([{"[")]}".index(c)]:
            out[stack.pop()[1]] = m.start()
    return out


def _value(text: str, at: int, known: dict):
    """The parts (start, end, value) of the value that begins at ``at``, with constants
    propagated over ``+``, and whether it was no literal in quotes and no known reference."""
    parts, plain = [], False
    while True:
        m = _ITEM.match(text, at)
        if not m:
            break
        group = "lit" if m["lit"] is not None else "long"
        if m[group] is not None:
            parts.append((*m.span(group), m[group]))
        elif m["bare"] in known:
            parts += known[m["bare"]]
        elif not parts:
            parts.append((*m.span("bare"), m["bare"]))
            plain = True
        at = m.end()
        more = _JOIN.match(text, at)
        if not more or plain:
            break
        at = more.end()
    # each literal once, however often a constant is built from itself
    return list(dict.fromkeys(parts)), plain, at


def _inside(text: str, opened: int, end: int, call: bool, closing: dict, known: dict):
    """The parts of each item in a bracket. What has a name of its own in there is left to it."""
    items, new, at = [], True, opened + 1
    while m := _INSIDE.search(text, at, end):
        c, at = m.group(), m.end()
        if c == ",":
            new = True
        elif c in (":", "=", ":=", "=>"):
            new, gap = True, _GAP.match(text, at)
            after = gap.end()
            if o := _OPENS.match(text, after):
                if o.end() - 1 not in closing:
                    break
                at = closing[o.end() - 1] + 1
            elif (v := _ITEM.match(text, after, end)) and v["bare"] is None:
                at = v.end()
        elif c in "\"'`" or c in known:
            parts, plain, stop = _value(text, m.start(), known)
            if not parts or plain or stop > end:
                continue
            at = stop
            after = _GAP.match(text, at).end()
            if text[after:after + 1] in (":", "="):  # a name
                continue
            if call and not items and len(parts) == 1 and text[after:after + 1] == "," and _LOOKUP.match(parts[0][2]):
                continue  # the name that a call looks up, before its default
            if new:
                items.append(list(parts))
            else:
                items[-1] += parts
            new = False
    return items


def _name_before(text: str, low: int, stop: int):
    """Where the name before a sign at ``stop`` starts, and the name; it may be a subscript. Not before ``low``."""
    end = stop
    while end > low and text[end - 1].isspace():
        end -= 1
    if end > low and text[end - 1] in "\"'":
        end -= 1
    if end > low and text[end - 1] == "]":
        start = text.rfind("[", low, end)
        return (start, text[start:end]) if start >= 0 and _SUBSCRIPT.match(text, start, end) else None
    start = end
    while start > low and (text[start - 1].isalnum() or text[start - 1] in "_.$-"):
        start -= 1
    while start < end and not (text[start].isascii() and text[start].isalpha() or text[start] in "_$"):
        start += 1
    return (start, text[start:end]) if start < end else None


def _block(text: str, line: int, at: int):
    """The lines of a YAML block scalar: those after ``at`` that are indented more than the line at ``line``."""
    def indent(a):
        return len(text[a:b]) - len(text[a:b].lstrip())

    b = text.find("\n", line)
    least, out = indent(line), []
    while at < len(text):
        b = text.find("\n", at)
        b = len(text) if b < 0 else b
        if text[at:b].strip():
            if indent(at) <= least:
                break
            start = at + indent(at)
            out.append((start, start + len(text[at:b].strip()), text[at:b].strip()))
        at = b + 1
    return out


def pairs(text: str):
    """The (name, parts, bare) of all assignments; parts are (start, end, value)."""
    known: dict[str, list] = {}
    closing = None
    at = 0
    for start, end in _lines(text):
        for m in _SIGN.finditer(text, start, end):
            if m.start() < at or m.group() not in (":", "=", ":=", "=>", ">"):
                continue
            before = _name_before(text, max(at, start), m.start())
            if not before or (m.group() == ">" and text[before[0] - 1:before[0]] != "<"):
                continue
            name = before[1].strip("[]\"' ")
            first, bare = _GAP.match(text, m.end()).end(), False
            opened = _OPENS.match(text, first)
            if m.group() == ":" and (head := _BLOCK.match(text, m.end())):
                items, at2 = [_block(text, start, head.end())], m.end()
            elif opened:
                closing = _closing(text) if closing is None else closing
                o = opened.end() - 1
                items, at2 = _inside(text, o, closing.get(o, end), len(opened.group()) > 1, closing, known), m.end()
            else:
                parts, bare, at2 = _value(text, first, known)
                if first > end and parts:  # on a later line: nothing else may be there, and it may not be a name
                    stop = text.find("\n", at2)
                    rest = text[at2:len(text) if stop < 0 else stop].strip()
                    if rest[:1] in (":", "=") or (bare and (rest not in ("", ",", ";") and not rest.startswith("</") or parts[0][2][-1:] in ":=" or _HINT.search(parts[0][2]))):
                        continue
                items = [parts]
            items = [x for x in items if x]
            if not items:
                if not opened:
                    continue
                # a bracket or call without literals: as before, its name is a bare value
                parts, bare, at2 = _value(text, first, known) if first <= end else ([], False, 0)
                if not parts:
                    continue
                items = [parts]
            if not bare:
                at = max(at, at2)
            if _NAME.match(name):
                if not bare or sum(len(p[2]) for p in items[0]) >= 6:
                    known[name] = [p for x in items for p in x]
            for parts in items:
                yield name, parts, bare


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, ordered by start, then kind as listed."""
    if not text:
        return []
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    assigned = [(s, e) for _, s, e in out]
    out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    found, k = set(), 0
    for name, parts, bare in pairs(text):
        weight = name_weight(name)
        if weight <= 0.3 or weight + literal_score("".join(p[2] for p in parts)) < LEAST + (0.4 if bare else 0.0):
            continue
        found.update((s, e) for s, e, v in parts if v)
    for s, e in sorted(found):
        while k < len(assigned) and assigned[k][1] < e:
            k += 1
        if not (k < len(assigned) and assigned[k][0] <= s):
            out.append(("literal", s, e))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _scan(batches):
    import pyarrow as pa

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for b in batches:
        texts = b.column(1).to_pylist()
        spans = [scan(t) for t in texts]
        hidden = []
        for t, found in zip(texts, spans):
            keep, at = [], 0
            for _, s, e in found:
                if s >= at:
                    keep += [t[at:s], "[secret]"]
                at = max(at, e)
            hidden.append("".join(keep) + t[at:] if found else t)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in f] for f in spans], kind),
             pa.array(hidden, pa.string())], names=["id", "spans", "redacted"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(<id_col>, spans, redacted)``, one for each input row: an array of
    (kind, start, end) in code points, end exclusive, and the text with spans replaced.

    - null and empty texts have no spans; ``redacted`` is as the text came;
    - null ids and repeated rows are answered like any other row;
    - very long texts, names, and constants of any number of literals are read whole;
    - equal starts are ordered by kind as listed in ``KINDS``;
    - other columns are ignored, whatever their names; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    out = rows.mapInArrow(_scan, f"id {kind}, spans array<struct<kind:string,start:long,end:long>>, redacted string")
    return out.withColumnRenamed("id", id_col)
