"""SimHash near-duplicates.

Method: 64-bit SimHash fingerprints, searched with BK-trees: a node's children are
keyed by their integer Hamming distance to it, and a search follows only edges
within the radius of its own distance. Trees are built for shards of the
fingerprints, where the shard's members meet, and components grow from links.

Shards: two fingerprints that differ in at most ``radius`` bits agree in at
least one of ``radius + 1`` blocks of bits, so each distinct fingerprint belongs to one
shard per block (with more blocks, to one per choice of blocks that some pair must
agree in); the number of blocks follows the number of fingerprints, so that shards
stay small. A shard over ``TILE`` members is dealt out as pairs of tiles, each a task's
work of at most two tiles, and no pair is lost.

Scale: exact copies fold into one fingerprint by a map-side aggregate before
anything else. Within a tile pair links are folded into one edge per
fingerprint, so a group of near copies never becomes all its pairs. Components are
found by alternating large and small stars over a table of edges in the shared
folder; nothing but counts reaches the driver.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import NULL_ID, bounded_batches, texts_of
from paylake.session import materialize, materialize_at, release

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Members of a shard that one tile holds.
TILE = 4096
#: Rows that a task works on at once, and pairs of a query and a node on its way.
BATCH = 100_000
FRONTIER = 2_000_000


def simhash(words: list[bytes], n: int = SHINGLE) -> int:
    """The fingerprint (unsigned): a bit is 1 if it is set in over half of the shingles' hashes."""
    import numpy as np
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[k:] for k in range(n)))) if len(words) >= n else [b" ".join(words)]
    hashes = np.array([xxh64_intdigest(s, SEED) for s in shingles], ">u8")
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        counts += np.unpackbits(hashes[k:k + (1 << 14)].view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            fps = [simhash((t or b"").lower().split(), shingle) for t in texts_of(b, 2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([f - (1 << 64) if f >> 63 else f for f in fps], pa.int64())],
                names=["id", "body", "fp"])
    return run


class Forest:
    """BK-trees over the fingerprints of many shards, as flat arrays.

    Members are numbered in shard order; the first of a shard is its root. All trees
    grow one level at a time: of the members that stand at the same node with the same
    distance, the first becomes the child under that edge and the others go on there.
    """

    def __init__(self, fps, shard):
        import numpy as np

        self.fps = fps
        new = np.concatenate([[True], shard[1:] != shard[:-1]])
        self.root = np.flatnonzero(new)[np.cumsum(new) - 1]
        items, at = np.flatnonzero(~new), self.root[~new]
        keys, kids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(items):
            edge = at * 65 + np.bitwise_count(fps[items] ^ fps[at])
            uniq, first, inverse = np.unique(edge, return_index=True, return_inverse=True)
            keys.append(uniq)
            kids.append(items[first])
            rest = np.ones(len(items), bool)
            rest[first] = False
            items, at = items[rest], items[first][inverse[rest]]
        keys, kids = np.concatenate(keys), np.concatenate(kids)
        order = np.argsort(keys)
        self.keys, self.kids = keys[order], kids[order]

    def links(self, radius: int):
        """Yields arrays (a, b) of all linked members, each pair once (b before a)."""
        import numpy as np

        n = len(self.fps)
        todo = [(np.arange(k, min(n, k + FRONTIER // 4)), self.root[k:k + FRONTIER // 4]) for k in range(0, n, FRONTIER // 4)]
        while todo:
            q, node = todo.pop()
            d = np.bitwise_count(self.fps[q] ^ self.fps[node]).astype(np.int64)
            hit = (d <= radius) & (node < q)
            if hit.any():
                yield q[hit], node[hit]
            lo = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), "right")
            size = hi - lo
            ends = np.cumsum(size)
            start = 0
            while start < len(q):  # a bounded number of steps at a time
                base = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + FRONTIER, "right")))
                some = size[start:stop]
                into = np.repeat(lo[start:stop] - (ends[start:stop] - some - base), some) + np.arange(some.sum())
                kids, who = self.kids[into], np.repeat(q[start:stop], some)
                earlier = kids < who  # a subtree's members all come after its root
                if earlier.any():
                    todo.append((who[earlier], kids[earlier]))
                start = stop


def unite(label, a, b):
    """Joins the classes of a[i] and b[i]; ``label`` holds each member's smallest member."""
    import numpy as np

    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _search(radius: int):
    """Rows come sorted by shard; each run of whole shards is searched at once."""
    def solve(rows):
        import numpy as np
        import pyarrow as pa

        keys, fps, reps = (np.concatenate(x) for x in zip(*rows))
        _, shard = np.unique(keys, return_inverse=True)
        order = np.lexsort((reps, shard))
        fps, reps, shard = fps[order], reps[order], shard[order]
        forest, label = Forest(fps.view(np.uint64), shard), np.arange(len(fps))
        for a, b in forest.links(radius):
            label = unite(label, a, b)
        far = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(reps[far]), pa.array(reps[label[far]])], names=["a", "b"])

    def run(batches):
        import numpy as np

        held, n = [], 0
        for b in batches:
            key, fp, rep = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            if held and n + len(key) > BATCH:
                other = np.flatnonzero(key != held[-1][0][-1])
                if len(other):  # here ends the shard of the held rows
                    cut = int(other[0])
                    yield solve([*held, (key[:cut], fp[:cut], rep[:cut])])
                    held, n = [], 0
                    key, fp, rep = key[cut:], fp[cut:], rep[cut:]
            if len(key):
                held.append((key, fp, rep))
                n += len(key)
        if held:
            yield solve(held)
    return run


def _blocks(n: int, radius: int) -> tuple[int, int]:
    """How many blocks, and how many of them a shard's members share: two
    fingerprints within the radius agree in all but ``radius`` of the blocks. More are taken
    until shards of evenly spread fingerprints hold 64 or fewer."""
    blocks = radius + 1
    while blocks < 16 and n >> min(62, 64 * (blocks - radius) // blocks) > 64:
        blocks += 1
    return blocks, blocks - radius


def link_edges(reps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (a, b) between the ``rep`` ids of ``reps (fp, rep)`` whose components are those of all links."""
    n = reps.count()
    blocks, same = _blocks(n, radius)
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    part = [F.shiftrightunsigned("fp", cuts[k]).bitwiseAND(F.lit((1 << (cuts[k + 1] - cuts[k])) - 1)) for k in range(blocks)]
    shards = F.array(*[F.xxhash64(F.lit(k), *[part[x] for x in chosen]) for k, chosen in enumerate(combinations(range(blocks), same))])
    members = reps.select("fp", "rep", F.explode(shards).alias("shard"))
    # Written out, so that the join has a shuffle on both sides and AQE may split a hot shard.
    sizes = materialize(members.groupBy("shard").count().filter(F.col("count") > 1), "shard-sizes")
    tiles = F.ceil(F.col("count") / tile).cast("int")
    pairs = members.join(sizes, "shard").withColumn("tiles", tiles).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    pairs = pairs.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    key = F.when(F.col("tiles") == 1, F.col("shard")).otherwise(
        F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other"))).alias("key")
    dealt = pairs.select(key, "fp", "rep").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_search(radius), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``, by alternating large and
    small stars until nothing changes; ``component`` is the smallest node."""
    def star(e: DataFrame, small: bool) -> DataFrame:
        # Large: what is larger than u goes to u's smallest neighbour; small: u and what is smaller does.
        both = e if small else e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        least, folder = materialize_at(least, "least")  # as above: a hub's links may be split
        used.append(folder)
        out = both.join(least, "a")
        if small:
            out = out.select(F.col("b").alias("x"), "m").unionByName(least.select(F.col("a").alias("x"), "m"))
        else:
            out = out.filter(F.col("b") > F.col("a")).select(F.col("b").alias("x"), "m")
        return out.filter(F.col("x") != F.col("m")).select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()

    def sum_up(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    used: list[str] = []
    e, path = materialize_at(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    seen = sum_up(e)
    while seen[0]:
        e2, path2 = materialize_at(star(star(e, False), True), "edges")
        now = sum_up(e2)
        for old in (path, *used):
            release(e.sparkSession, old)
        used.clear()
        e, path = e2, path2
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))


def classify(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """``(id, body, fp)`` of every row (``body``: a hash of the text), and ``(fp, component,
    first)``: each fingerprint's component, named by one of its fingerprints, and the
    smallest id in it. Nodes are fingerprints, since ids may be missing or repeated."""
    bounded_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.xxhash64(text).alias("body"), text.alias("text"))
    fps = materialize(rows.mapInArrow(_fingerprints(shingle), "id long, body long, fp long"), "fingerprints")
    reps = materialize(fps.groupBy("fp").agg(F.min("id").alias("id")), "fingerprint-ids")
    found = components(link_edges(reps.select("fp", F.col("fp").alias("rep")), radius))
    of = materialize(reps.join(found, reps.fp == found.node, "left").select("fp", "id", F.coalesce("component", "fp").alias("component")), "fingerprint-components")
    return fps, of.join(of.groupBy("component").agg(F.min("id").alias("first")), "component").select("fp", "component", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """Rows ``(<id_col>, fp, component_id)``, one for each input row: the fingerprint
    (as a signed long) and the smallest id reachable over links.

    - very long texts are read whole;
    - null and wordless texts have fingerprint zero and link like any other;
    - repeated rows and ties: each row is answered, all with the same component;
    - a null id sorts after every other; its component is null only if no other id is reached;
    - other columns are ignored, whatever their names; an empty table gives no rows.
    """
    fps, classes = classify(docs, id_col, text_col, shingle, radius)
    return fps.join(classes, "fp").select(F.nullif("id", F.lit(NULL_ID)).alias(id_col), "fp",
                                          F.nullif("first", F.lit(NULL_ID)).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` (all columns, whatever their names) without near-duplicates:
    of each component the document of the smallest id, once. A null id sorts after
    every other; of rows with that same id the one of the smallest text hash stays."""
    fps, classes = classify(docs, id_col, text_col, shingle, radius)
    stay = fps.join(classes, "fp").groupBy("component").agg(F.min(F.struct("id", "body")).alias("first")).select("first.*").distinct()
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("body"))
    copies = Window.partitionBy("id", "body").orderBy("id")  # all alike
    return (rows.join(stay, ["id", "body"], "left_semi").withColumn("copy", F.row_number().over(copies))
            .filter("copy = 1").select("row.*"))
