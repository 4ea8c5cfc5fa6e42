"""LM scoring with a probabilistic suffix tree over words.

Method: a state is a context of up to ``DEPTH`` preceding words. Candidates are the
contexts and next words seen at least ``LEAST`` times, however large the corpus; a context
is retained if its next-word distribution diverges from its parent's
(the longest retained proper suffix) by more than its description costs: count times
Kullback-Leibler divergence over half a log of the count per next word. Retained
distributions are smoothed: a discount on each seen next word, the rest of the
mass shared out like the parent's. A text is scored token by token in the longest
retained suffix state. The root is the base model, (c + 1) / (N + V + 1).

Tokens are words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, then one end of text.
Contexts don't reach over a text's beginning.

Scale: words and the sequences of each length are counted over all training texts by
shuffles with map-side counts, and the tree is grown by joins of those tables; it is never
held in one place. What a sequence adds to a token's score is one number: for a retained
context, the log of its share for unseen words, and for a seen next word the difference to
that. So a text's score is its base score and the sum of its sequences' numbers. The most
frequent ``HELD`` at most of those numbers are broadcast, the others are joined. Passes leave
out sequences with an infrequent part by a bitmap for each length, of ``BITS`` bits at most: false
hits cost time and change no result. Counts of sequences go from task to task packed, a row
for each summing part. At most ``1 / HOT`` words exceed
``HOT * N``: the texts are written once as those words' numbers, which all later passes
read; their other words get their counts from a distributed join. Sequences are known by
64-bit hashes (a word by its number, or by a hash of 63 bits).
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from itertools import repeat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import bounded_batches, remainder, texts_of
from paylake.session import materialize, materialize_at, stage_scope

DEPTH = 3
HOT = 2.0 ** -20
LEAST = 8
DISCOUNT = 0.5
#: Sequences whose numbers are broadcast (64 MB), and the most bits of a bitmap of sequences of one length.
HELD = 1 << 22
BITS = 1 << 28
#: Tokens that a task works on at once, and sequences and words that it counts before it
#: passes the counts on.
CHUNK = 400_000
KEYS = 1_200_000
WORDS = 300_000
#: Training tokens for each part of the sequences, and counts that a task holds before it sums them up.
PART = 4_000_000
SUMMED = 1_000_000
#: The end of a text, as a word (no word is empty).
END = b""


def tokens(text: bytes | None) -> list[bytes]:
    return [*(text or b"").lower().split(), END]


def _count_words(batches):
    import pyarrow as pa

    def out(c):
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])

    counts = Counter()
    for b in batches:
        for t in texts_of(b, 0):
            counts.update(tokens(t))
            if len(counts) > WORDS:
                yield out(counts)
                counts.clear()
    yield out(counts)


class Model:
    """The numbered words and what scoring needs of them. Words come by falling count; those
    before ``width`` are frequent enough to be part of a sequence."""

    def __init__(self, words: list[bytes], counts, total: int, distinct: int):
        import numpy as np

        self.words, self.total, self.distinct = words, total, distinct
        self.base = np.log10((counts + 1.0) / (total + distinct + 1))
        self.width = max(1, int((counts >= LEAST).sum()))
        self.index = None

    def ids(self, words: list[bytes]):
        import numpy as np

        if self.index is None:
            self.index = {w: k for k, w in enumerate(self.words)}
        return np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))

    def state(self) -> dict:
        """What makes the model up, as plain data for a broadcast."""
        return {"model": self.__dict__ | {"index": None}}

    @staticmethod
    def of(state: dict) -> "Model":
        """The model of a broadcast state; kept there, since a worker's tasks share it."""
        if "built" not in state:
            state["built"] = Model.__new__(Model)
            state["built"].__dict__.update(state["model"])
        return state["built"]


def _cold_keys(words: list[bytes]):
    """Keys of words without a number: hashes below 0."""
    import hashlib

    import numpy as np

    return np.frombuffer(b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in words), "<i8") | np.int64(-1 << 63)


def _mix(context, word):
    """The key of a sequence from those of its words but the last, and of the last."""
    import numpy as np

    x = context.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for more in (word.view(np.uint64), np.uint64(0)):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = (x ^ (x >> np.uint64(31))) + more
    return x.view(np.int64)


def _marked(bits, keys):
    """Which keys' bits are set."""
    import numpy as np

    at = keys & np.int64(len(bits) * 64 - 1)
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


def _bitmap(keys: DataFrame):
    """The bitmap of a column ``key``: 16 bits or more for each key, up to ``BITS``; a 64th
    of that in rows at most reaches the driver."""
    import numpy as np

    size = min(BITS, max(1 << 16, 1 << (16 * keys.count()).bit_length()))
    out = np.zeros(size // 64, np.uint64)
    at = keys.select(F.col("key").bitwiseAND(F.lit(size - 1)).alias("at"))
    found = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("set")).toArrow()
    out[found.column("word").to_numpy()] |= found.column("set").to_numpy().view(np.uint64)
    return out


def _word_keys(held):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        model = Model.of(held.value)
        for b in batches:
            words = texts_of(b, 0)
            keys = model.ids(words)
            keys[keys < 0] = _cold_keys([words[k] for k in np.flatnonzero(keys < 0).tolist()])
            yield pa.RecordBatch.from_arrays([pa.array(keys), b.column(1)], names=["key", "n"])
    return run


def _sequence_keys(pairs: bool):
    """The keys of sequences ``(ctx, word, n, of, ctx_short)`` and of what is left without their
    first words (of a pair: the last word)."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            ctx, word, n, of, short = (c.to_numpy() for c in b.columns)
            shorter = word if pairs else _mix(short, word)
            yield pa.RecordBatch.from_arrays([pa.array(_mix(ctx, word)), pa.array(ctx), pa.array(shorter), pa.array(n), pa.array(of)],
                                             names=["key", "ctx", "shorter", "n", "of"])
    return run


def _encode(held):
    """Texts to word numbers, once: every later pass reads the numbers. The words
    without one are kept as they are."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        model, row = Model.of(held.value), TaskContext.get().partitionId() << 36
        for b in batches:
            docs = [tokens(t) for t in texts_of(b, 2)]
            if not docs:
                continue
            flat = [w for words in docs for w in words]
            ids = model.ids(flat)
            starts = np.cumsum([0, *map(len, docs)])
            known = np.add.reduceat((ids >= 0).astype(np.int64), starts[:-1])
            cold = [flat[k] for k in np.flatnonzero(ids < 0).tolist()]
            cuts = np.concatenate([[0], np.cumsum(np.diff(starts) - known)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(docs))), b.column(0), b.column(1),
                 pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(cuts), pa.array(cold, pa.binary())),
                 pa.ListArray.from_arrays(pa.array(cuts), pa.array(_cold_keys(cold)))],
                names=["row", "id", "held_out", "ids", "cold", "cold_keys"])
            row += len(docs)
    return run


def _numbers(batches, column: int, chunk: int | None = None):
    """Runs of whole texts with about ``chunk`` numbers: the batch, its rows from and to,
    the numbers in one array, and where each text starts in it."""
    import numpy as np

    for b in batches:
        offsets, values = b.column(column).offsets.to_numpy(), b.column(column).values.to_numpy()
        start = 0
        while start < b.num_rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + (chunk or CHUNK), "right")) - 1)
            yield b, start, stop, values[offsets[start]:offsets[stop]].astype(np.int64), offsets[start:stop + 1] - offsets[start]
            start = stop


def _sequences(b, start: int, stop: int, ids, starts, cold: int, width: int, bits, depth: int):
    """For each length up to ``depth``, the sequences whose two shorter parts the bitmaps
    hold: the places where they end, their keys, whether their length's bitmap holds them (if
    there is one yet), and the keys of their first words and of the last."""
    import numpy as np

    offsets, values = b.column(cold).offsets.to_numpy(), b.column(cold).values.to_numpy()
    words = ids.copy()
    words[ids < 0] = values[offsets[start]:offsets[stop]]
    key, seen = words, (ids >= 0) & (ids < width)
    at = np.flatnonzero(ids < 0)
    seen[at] = _marked(bits[0], words[at])
    yield 1, np.arange(len(ids)), key, seen, None, None
    inside = np.ones(len(ids), bool)
    inside[starts[:-1]] = False
    for m in range(2, depth + 1):
        at = np.flatnonzero(seen[1:] & seen[:-1] & inside[1:]) + 1
        ctx, word = key[at - 1], words[at]
        now = _mix(ctx, word)
        hit = _marked(bits[m - 1], now) if m <= len(bits) else None
        yield m, at, now, hit, ctx, word
        if hit is None:
            return
        key, seen = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
        key[at], seen[at] = now, hit


def _packed(*columns) -> bytes:
    """Integer columns as bytes, those of equal weight together, compressed: sorted and small
    numbers take a fraction of their width."""
    import numpy as np
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns))


def _unpacked(data: bytes, columns: int) -> list:
    import numpy as np
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(p.T).view(np.int64).ravel() for p in planes]


def _summed(ctx, word, n):
    """The sequences once, by their first words, with their counts added up."""
    import numpy as np

    _, first, at = np.unique(_mix(ctx, word), return_index=True, return_inverse=True)
    total = np.bincount(at, n, len(first)).astype(np.int64)
    order = np.argsort(ctx[first], kind="stable")
    return ctx[first[order]], word[first[order]], total[order]


def _count_sequences(held, m: int, parts: int):
    """A task's counts, packed by the part that will sum them: one row for each part and chunk."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def out(found):
            ctx, word = map(np.concatenate, zip(*found))
            ctx, word, n = _summed(ctx, word, np.ones(len(ctx)))
            part = (_mix(word, ctx).view(np.uint64) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            rows = [(p, _packed(*(x[order[a:b]] for x in (ctx, word, n)))) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())],
                                              names=["part", "packed"])

        found, size = [], 0
        for run_of in _numbers(batches, 0):
            *_, (_, _, _, _, ctx, word) = _sequences(*run_of, 1, held.value["width"], held.value["bits"], m)
            found.append((ctx, word))
            size += len(ctx)
            if size >= KEYS:
                yield out(found)
                found, size = [], 0
        if size:
            yield out(found)
    return run


def _sum_sequences(batches):
    """The sequences seen ``LEAST`` times or more. A task's rows are of whole parts; what it holds is
    summed up whenever it has doubled, so it grows with the different sequences only."""
    import numpy as np
    import pyarrow as pa

    held, waiting, size = None, [], 0
    for b in batches:
        for data in b.column(0).to_pylist():
            waiting.append(_unpacked(data, 3))
            size += len(waiting[-1][0])
            if size > max(SUMMED, len(held[0]) if held else 0):
                held, waiting, size = _summed(*map(np.concatenate, zip(*([held] if held else []), *waiting))), [], 0
    if waiting:
        held = _summed(*map(np.concatenate, zip(*([held] if held else []), *waiting)))
    if held:
        often = held[2] >= LEAST
        ctx, word, n = (x[often] for x in held)
        for k in range(0, len(n), 1 << 18):
            yield pa.RecordBatch.from_arrays([pa.array(x[k:k + (1 << 18)]) for x in (ctx, word, n)], names=["ctx", "word", "n"])


def _score(held, depth: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        base, width, bits, keys, values, rest = (held.value[k] for k in ("base", "width", "bits", "keys", "values", "rest"))
        numbered = np.full(len(base), np.nan)  # the held numbers of the words that have one themselves
        own = (keys >= 0) & (keys < len(base))
        numbered[keys[own]] = values[own]
        for b, start, stop, ids, starts in _numbers(batches, 3):
            hot = ids >= 0
            of = np.where(hot, base[np.maximum(ids, 0)], 0.0) if len(base) else np.zeros(len(ids))
            extra, open_at, open_keys = np.zeros(len(ids)), [], []
            for m, at, key, seen, _, _ in _sequences(b, start, stop, ids, starts, 4, width, bits, depth + 1):
                at, key = at[seen], key[seen]
                add = np.full(len(key), np.nan)
                if m == 1:
                    add[key >= 0] = numbered[key[key >= 0]]
                look = np.flatnonzero(key < 0) if m == 1 else np.arange(len(key))
                if len(keys) and len(look):
                    # each key once and in order, which the search is fast for
                    asked, back = np.unique(key[look], return_inverse=True)
                    k = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                    add[look] = np.where(keys[k] == asked, values[k], np.nan)[back]
                known = ~np.isnan(add)
                extra[at[known]] += add[known]
                at, key = at[~known], key[~known]
                left = _marked(rest, key)
                open_at.append(at[left])
                open_keys.append(key[left])
            open_at, open_keys = np.concatenate(open_at), np.concatenate(open_keys)
            order = np.argsort(open_at, kind="stable")
            cuts = np.searchsorted(open_at[order], starts).astype(np.int32)
            sums = [np.add.reduceat(x, starts[:-1]) for x in (hot.astype(np.int64), of, extra)]
            yield pa.RecordBatch.from_arrays([*(c.slice(start, stop - start) for c in b.columns[:3]), pa.array(np.diff(starts).astype(np.int64)), *map(pa.array, sums),
                                              pa.ListArray.from_arrays(pa.array(cuts), pa.array(open_keys[order]))],
                                             names=["row", "id", "held_out", "n_tokens", "hot_known", "hot_base", "extra", "open"])
    return run


def _grow(grams: DataFrame, below: DataFrame, pairs: bool) -> tuple[DataFrame, DataFrame, tuple[str, str]]:
    """The divergence test of the contexts in ``grams (ctx, word, n)``, whose parts are in ``below
    (key, n, lp, short)``: the grams as such a table, with what they ``add`` after a retained
    context; the retained contexts with what they add; and the folders of both."""
    g = (grams.join(below.select(F.col("key").alias("ctx"), F.col("n").alias("of"), "short"), "ctx").select("ctx", "word", "n", "of", "short")
         .mapInArrow(_sequence_keys(pairs), "key long, ctx long, shorter long, n long, of long")
         .join(below.select(F.col("key").alias("shorter"), F.col("lp").alias("parent")), "shorter")
         .select("key", "ctx", "shorter", "n", "of", "parent", ((F.col("n") - DISCOUNT) / F.col("of")).alias("p")))
    g = materialize(g, "sequences-of")
    q, least = F.pow(F.lit(10.0), "parent"), F.lit(1e-12)
    tests = (g.groupBy("ctx").agg(F.first("of").alias("of"), F.count("*").alias("kinds"), F.sum("p").alias("mass"), F.sum(q).alias("parent_mass"),
                                  F.sum(F.col("p") * F.log(F.col("p") / q)).alias("kl"))
             .withColumn("rest", F.greatest(1 - F.col("mass"), least)).withColumn("share", F.col("rest") / F.greatest(1 - F.col("parent_mass"), least)))
    kl = F.col("kl") + F.col("rest") * F.log("share")
    kept = tests.filter(F.col("of") * kl > 0.5 * (F.col("kinds") + 1) * F.log(F.greatest("of", F.lit(2))))
    kept, kept_at = materialize_at(kept.select("ctx", F.col("of").alias("n"), F.log10("share").alias("add")), "contexts")
    lp = F.log10("p")
    out = g.join(kept.select("ctx", F.col("add").alias("la")), "ctx", "left").select(
        "key", "n", F.when(F.col("la").isNull(), F.col("parent")).otherwise(lp).alias("lp"), F.col("shorter").alias("short"),
        (lp - F.col("parent") - F.col("la")).alias("add"))
    out, out_at = materialize_at(out, "sequences")
    return out, kept.select(F.col("ctx").alias("key"), "n", "add"), (out_at, kept_at)


def learn(rows: DataFrame, depth: int = DEPTH) -> tuple[DataFrame, DataFrame, DataFrame, "Model", object]:
    """From ``rows (id, held_out, body)``: all training words' counts (a table ``word, c``),
    the rows in word numbers, the tree as what each sequence adds (a table ``key, n, add``),
    the most frequent words, and the bitmaps of the frequent sequences by length."""
    import numpy as np

    spark = rows.sparkSession
    sc = spark.sparkContext
    train = rows.filter(~F.col("held_out")).select("body")
    counts = train.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))
    with stage_scope(spark) as keep:
        counts, path = materialize_at(counts, "word-counts")
        keep(path)
        total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        hot = counts.filter(F.col("c") >= HOT * total).toArrow()
        order = sorted(zip(hot.column("c").to_pylist(), hot.column("word").to_pylist()), key=lambda x: (-x[0], x[1]))
        model = Model([w for _, w in order], np.array([c for c, _ in order], np.float64), total, distinct)
        kind = rows.schema["id"].dataType.simpleString()
        held = sc.broadcast(model.state())
        encoded, path = materialize_at(rows.mapInArrow(
            _encode(held), f"row long, id {kind}, held_out boolean, ids array<int>, cold array<binary>, cold_keys array<long>"), "encoded")
        keep(path)
        words = counts.filter(F.col("c") >= LEAST).select("word", "c").mapInArrow(_word_keys(held), "key long, n long")
        below = materialize(words.select("key", "n", F.log10((F.col("n") + 1) / F.lit(float(total + distinct + 1))).alias("lp"),
                                         F.lit(0).cast("long").alias("short")), "words")
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART))
        bits, adds = [_bitmap(below.filter("key < 0"))], []
        for m in range(2, depth + 2):
            held = sc.broadcast({"width": model.width if total else 0, "bits": bits})
            found = (encoded.filter(~F.col("held_out")).select("ids", "cold_keys").mapInArrow(_count_sequences(held, m, parts), "part int, packed binary")
                     .repartition(parts, "part").select("packed").mapInArrow(_sum_sequences, "ctx long, word long, n long"))
            # A length's intermediate tables go when the next length has what it needs of them.
            with stage_scope(spark) as last:
                found, _ = materialize_at(found, "frequent")
                held.unpersist()
                below, contexts, folders = _grow(found, below, pairs=m == 2)
                for folder in folders:
                    last(folder)
            bits = [*bits, _bitmap(below)]
            adds += [contexts, below.filter("add is not null").select("key", "n", "add")]
        tree, path = materialize_at(reduce(DataFrame.unionAll, adds).groupBy("key").agg(F.max("n").alias("n"), F.sum("add").alias("add")), "tree")
        keep(path)
    return counts, encoded, tree, model, bits


def _held_from(tree: DataFrame) -> float:
    """The count from which on ``HELD`` sequences at most are that frequent (by steps of an eighth of a doubling)."""
    room, least = HELD, float("inf")
    for step, n in sorted(tree.groupBy(F.floor(8 * F.log2("n")).alias("step")).count().collect(), reverse=True):
        room -= n
        if room < 0:
            break
        least = step
    return least


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_mod: int = 7,
                held_out_rest: int = 2, depth: int = DEPTH) -> DataFrame:
    """Rows ``(<id_col>, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one for each input row.

    Learns from the documents whose crc32 of the id, as text, mod ``held_out_mod`` is not
    ``held_out_rest`` (null id: the empty text) and scores all.

    - null and empty texts are one token, the end; they teach that token if they are training rows;
    - repeated rows teach and are scored as often as they occur;
    - if nothing teaches, N and V are 0 and every probability is 1;
    - other columns are ignored, whatever their names; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    held_out = remainder(F.col(id_col), held_out_mod) == held_out_rest
    rows = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("body"))
    counts, encoded, tree, model, bits = learn(rows, depth)
    often = F.floor(8 * F.log2("n")) >= F.lit(_held_from(tree))
    held = tree.filter(often).select("key", "add").toArrow().sort_by("key")
    tail = tree.filter(~often).select("key", "add")
    held = docs.sparkSession.sparkContext.broadcast({
        "base": model.base, "width": model.width if model.total else 0, "bits": bits, "rest": _bitmap(tail),
        "keys": held.column("key").to_numpy(), "values": held.column("add").to_numpy()})
    kind = rows.schema["id"].dataType.simpleString()
    scored = materialize(encoded.select("row", "id", "held_out", "ids", "cold_keys").mapInArrow(
        _score(held, depth), f"row long, id {kind}, held_out boolean, n_tokens long, hot_known long, hot_base double, extra double, open array<long>"), "scored")
    joined = (scored.select("row", F.explode("open").alias("key")).join(tail, "key")
              .groupBy("row").agg(F.sum("add").alias("more")))
    room = F.lit(float(model.total + model.distinct + 1))
    cold = (encoded.select("row", F.explode("cold").alias("word")).join(counts, "word", "left")
            .groupBy("row").agg(F.sum(F.log10((F.coalesce("c", F.lit(0)) + 1) / room)).alias("cold_base"),
                                F.count("c").alias("cold_known")))
    out = scored.drop("open").join(cold, "row", "left").join(joined, "row", "left")
    base = F.col("hot_base") + F.coalesce("cold_base", F.lit(0.0))
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens",
                      (F.col("hot_known") + F.coalesce("cold_known", F.lit(0))).alias("n_known"),
                      F.lit(model.total).cast("long").alias("train_tokens"), base.alias("base_score"),
                      (base + F.col("extra") + F.coalesce("more", F.lit(0.0))).alias("score"))
