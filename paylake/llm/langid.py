"""Language identification.

Method: cross-parsing entropy. For each language a suffix automaton holds all
substrings of its labelled text. A document is parsed from left to right into phrases, each
the longest match that the automaton of a language has; the number of phrases times
log2 of the training length, over the document's length, estimates the cross entropy.
The language of the fewest normalised phrases wins.

Texts are compared as UTF-8 after lower-casing, with every run of other characters than
letters and marks as one blank. A batch's texts move through the automata in step, a byte of
each at a time; each is parsed whole. Languages are dealt into tables of bounded size, each over the bytes
that its languages use; the fewest phrases are found over all tables.

Learning uses a bounded sample: per language ``SAMPLE_TEXTS`` distinct texts (those of
the smallest text hash), ``SAMPLE_CHARS`` characters of each. It is the only thing broadcast;
tasks build the automata from it once per worker. Prediction reads every whole text in one
pass without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import bounded_batches, remainder, texts_of

SAMPLE_TEXTS = 48
SAMPLE_CHARS = 1024
#: Times the sample that is looked at to find it.
OVER = 8
#: Bytes that move through the automata at once.
BATCH_BYTES = 8 << 20
UNKNOWN = "und"

_COUNT_BITS = 28  # a transition holds the next state below, the phrases it ends above
#: Transitions in one table of automata: one language has far less.
TABLE = 1 << 26


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " "))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", texts: int = SAMPLE_TEXTS,
          chars: int = SAMPLE_CHARS) -> list[tuple[str, bytes]]:
    """The sample, ``(language, text)`` by language. Rows without a language or a letter
    teach nothing; copies of a text count once. At most ``texts * chars`` characters of
    each language."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("body"))
    rows = rows.filter(F.col("lang").isNotNull() & has_letter(F.col("body")))
    rows = rows.withColumn("h", F.xxhash64("body"))
    # Hashes are evenly spread, so about OVER * texts distinct ones lie below this share of
    # their range; what is ranked doesn't grow with the corpus, and no text is shuffled.
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    below = [(r.lang, min((1 << 63) - 1, int(OVER * texts / max(1, r.n) * (1 << 64)) - (1 << 63))) for r in sizes]
    if not below:
        return []
    below = rows.sparkSession.createDataFrame(below, "lang string, below long")  # a row for each language
    few = (rows.join(F.broadcast(below), "lang").filter(F.col("h") <= F.col("below"))
           .groupBy("lang", "h").agg(F.min(F.substring(normalised(F.col("body")), 1, chars)).alias("body")))
    sample = (few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
              .filter(F.col("rank") <= texts).select("lang", "h", "body").collect())
    by: dict[str, list[bytes]] = {}
    for r in sorted(sample, key=lambda r: (r.lang, r.h)):
        by.setdefault(r.lang, []).append(r.body.encode())
    return [(lang, b"\0".join(parts)) for lang, parts in sorted(by.items())]


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """The transitions of every state; state 0 is the start. Blumer et al.'s construction."""
    go, link, length, last = [{}], [-1], [0], 0
    for c in text:
        cur = len(go)
        go.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[cur] = clone
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = clone
                    p = link[p]
        last = cur
    return go


class Table:
    """Some languages' automata as one table of transitions over bytes. Where a match
    can't go on, the phrase ends and the byte begins the next one at the start."""

    def __init__(self, sample: list[tuple[bytes, list[dict[int, int]]]]):
        import numpy as np

        symbols = sorted({c for text, _ in sample for c in text} - {0})
        self.code = np.full(256, len(symbols), np.int64)  # the last column: bytes that nobody has
        self.code[symbols] = np.arange(len(symbols))
        width, tables, starts, base = len(symbols) + 1, [], [], 0
        for _, go in sample:
            table = np.full((len(go), width), -1, np.int64)
            for s, edges in enumerate(go):
                for c, to in edges.items():
                    if c:  # matches don't run over the end of a training text
                        table[s, self.code[c]] = to
            start = table[0].copy()
            dead = table < 0
            into = np.where(start >= 0, start, 0)
            ends = np.where(start >= 0, 1, 2)  # an unknown byte is a phrase of its own
            step = np.where(dead, into, table) * width + base + (np.where(dead, ends, 0) << _COUNT_BITS)
            step[0] = into * width + base + (np.where(start >= 0, 0, 1) << _COUNT_BITS)
            tables.append(step.ravel())
            starts.append(base)
            base += step.size
        self.step = np.concatenate(tables).astype(np.int64 if base * 8 >= 1 << 31 else np.int32)
        self.start = np.array(starts, np.int32)

    def phrases(self, data, at, sizes):
        """Phrases of the texts (starts and sizes in ``data``, the largest first) in each language."""
        import numpy as np

        data = self.code[data]
        active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")  # texts longer than t
        state = np.repeat(self.start[:, None], len(at), 1).astype(self.step.dtype)
        ended = np.zeros(state.shape, np.int64)
        low = (1 << _COUNT_BITS) - 1
        for t, k in enumerate(active.tolist()):
            v = self.step[state[:, :k] + data[at[:k] + t]]
            ended[:, :k] += v >> _COUNT_BITS
            state[:, :k] = v & low
        return ended + (state != self.start[:, None])  # the phrase at a text's end


class Parser:
    """All languages' automata, in tables."""

    def __init__(self, sample: list[tuple[str, bytes]], most: int = TABLE):
        import numpy as np

        self.langs = [lang for lang, _ in sample]
        self.bits = np.log2([max(2, len(text)) for _, text in sample])
        self.tables, block, used, states = [], [], set(), 0
        for _, text in sample:
            go = suffix_automaton(text)
            if block and (states + len(go)) * (len(used | set(text)) + 1) > most:
                self.tables.append(Table(block))
                block, used, states = [], set(), 0
            block.append((text, go))
            used |= set(text)
            states += len(go)
        if block:
            self.tables.append(Table(block))

    def phrases(self, texts: list[bytes]):
        """How many phrases each text has in each language (texts x languages)."""
        import numpy as np

        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        at = (np.cumsum(sizes) - sizes)[order]
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        if self.tables:
            out[order] = np.concatenate([x.phrases(data, at, sizes[order]) for x in self.tables]).T
        return out

    def predict(self, texts: list[bytes]):
        """Per text the language's index and a score: how far the second best is behind, 0 to 1."""
        import numpy as np

        found = self.phrases(texts) * self.bits / np.maximum([[len(t)] for t in texts], 1)
        best = found.argmin(axis=1)
        if len(self.langs) == 1:
            return best, np.ones(len(texts))
        two = np.partition(found, 1, axis=1)[:, :2]
        return best, np.clip(1 - two[:, 0] / np.maximum(two[:, 1], 1e-300), 0.0, 1.0)


def _predict(held):
    def run(batches):
        import pyarrow as pa

        state = held.value  # a worker's tasks share it
        if "parser" not in state:
            state["parser"] = Parser(state["sample"])
        parser = state["parser"]
        for b in batches:
            texts, ok = texts_of(b, 1), b.column(2).to_pylist()
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            todo, size = [], 0
            for i, t in enumerate(texts):
                if ok[i] and t and parser.langs:
                    todo.append(i)
                    size += len(t)
                if todo and (size >= BATCH_BYTES or i == len(texts) - 1):
                    for j, best, score in zip(todo, *parser.predict([texts[j] for j in todo])):
                        langs[j], scores[j] = parser.langs[best], float(score)
                    todo, size = [], 0
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["id", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, sample: list[tuple[str, bytes]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(<id_col>, lang_pred, score)``, one for each input row.

    ``score`` is 1 minus the ratio of the best to the second best entropy (1 with a single
    language); of equally good languages the first by name wins, with score 0.

    - a null text or one without a letter, or an empty sample: ``und``, score 0;
    - null ids and repeated rows are answered like any other row; very long texts are parsed whole;
    - other columns are ignored, whatever their names; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast({"sample": sample})
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    body = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), normalised(body).alias("body"), has_letter(body).alias("ok"))
    out = rows.mapInArrow(_predict(held), f"id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def held_out(id_col: Column) -> Column:
    """Documents that don't teach: crc32 of the id as text, mod 4, is 2."""
    return remainder(id_col, 4) == 2
