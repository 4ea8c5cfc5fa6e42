"""Quality rules (Spark expressions only).

Method: a learned decision list. Sequential covering grows conjunctions of
threshold conditions that separate documents labelled bad from those labelled good,
prunes each on held-out labelled rows, removes what it covers and goes on. The
list becomes one ordered Spark conditional expression.

Words are ``[^\\x20\\x09-\\x0D]+``. All statistics come from built-in expressions on whole
texts; windows of words are compared by 64-bit hashes of word hashes within one
document.

Scale: the statistics are one pass without a shuffle, written once (with the
document's columns, if asked for). Learning sees per step only counts by (feature,
bin), aggregated over all labelled rows: at most features x (cuts + 1) rows reach the
driver, whatever the size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import SPACE, SPACE_RE, remainder
from paylake.session import materialize

WINDOW = 8
MIN_WORDS = 20
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("words", "word_length", "symbols", "dup_lines", "repeats", "variety", "upper", "marks", "line_words")

#: Learning: quantiles that give the cuts, conditions in a rule, rules in a list,
#: precision that a rule needs on the pruning rows, and bad rows it has to cover there.
QUANTILES = (0.0, 0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)
MAX_CONDITIONS = 4
MAX_RULES = 12
MIN_PRECISION = 0.95
MIN_COVER = 3


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        c = F.col("f_" + self.feature)
        return c > F.lit(self.cut) if self.above else c <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def statistics(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` of ``df``, then the five base statistics (long), the
    learned rules' features (``f_*``, double) and ``base_failed``.

    Null and empty texts have no words: all statistics 0, all features 0.
    """
    space = SPACE.decode()
    t = F.col("l_text")
    df = df.select(*[F.col(c).alias("k_" + c) for c in keep], F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("l_text"))
    kept = [F.col("k_" + c) for c in keep]
    trimmed = F.btrim(t, F.lit(space))
    df = df.select(
        *kept, F.length(t).alias("l_chars"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RE + "+")).alias("l_words"),
        F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(space)) != "").alias("l_lines"),
        F.length(F.regexp_replace(t, SPACE_RE, "")).alias("l_word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, "[#*$%&|<>]", ""))).alias("l_symbols"),
        (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}", ""))).alias("l_upper"),
        (F.length(t) - F.length(F.regexp_replace(t, "[!?]", ""))).alias("l_marks"))
    df = df.select(*kept, F.size("l_words").alias("l_n"), F.transform("l_words", lambda w: F.xxhash64(w)).alias("l_h"),
                   F.size("l_lines").alias("l_line_n"),
                   (F.size("l_lines") - F.size(F.array_distinct("l_lines"))).alias("l_dup"),
                   "l_word_chars", "l_symbols", "l_upper", "l_marks")
    heads = F.slice("l_h", F.lit(1), F.greatest(F.col("l_n") - (WINDOW - 1), F.lit(0)))
    df = df.select("*", F.transform(heads, lambda x, i: F.xxhash64(x, *[F.get(F.col("l_h"), i + k) for k in range(1, WINDOW)])).alias("l_win"),
                   F.size(F.array_distinct("l_h")).alias("l_distinct"))
    # Only where some window repeats: its places, by sorting (window, place).
    df = df.select("*", F.when(F.size(F.array_distinct("l_win")) < F.size("l_win"), F.sort_array(
        F.transform("l_win", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("l_sorted"))
    df = df.select("*", F.sort_array(F.transform(
        F.filter("l_sorted", lambda x, i: x["h"].eqNullSafe(F.get(F.col("l_sorted"), i - 1)["h"])
                 | x["h"].eqNullSafe(F.get(F.col("l_sorted"), i + 1)["h"])), lambda x: x["i"])).alias("l_at"))
    covered = F.aggregate(
        F.transform("l_at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("l_at"), i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    df = df.select(
        *kept, F.col("l_n").cast("long").alias("n_words"), F.col("l_word_chars").cast("long").alias("word_chars"),
        F.col("l_symbols").cast("long").alias("n_symbols"), F.col("l_dup").cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "l_distinct", "l_upper", "l_marks", "l_line_n")
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0).cast("double")
    return df.select(
        *kept, *STATS,
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        F.col("n_words").cast("double").alias("f_words"), ratio("word_chars", "n_words").alias("f_word_length"),
        ratio("n_symbols", "n_words").alias("f_symbols"), ratio("n_dup_lines", "l_line_n").alias("f_dup_lines"),
        ratio("n_repeat_words", "n_words").alias("f_repeats"), ratio("l_distinct", "n_words").alias("f_variety"),
        ratio("l_upper", "word_chars").alias("f_upper"), ratio("l_marks", "n_words").alias("f_marks"),
        ratio("n_words", "l_line_n").alias("f_line_words"))


def _all(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def _uncovered(rules: list[Rule]) -> Column:
    out = F.lit(True)
    for r in rules:
        out = out & ~_all(r)
    return out


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    """Adds the condition of the best information gain until only bad rows are left."""
    rule: Rule = ()
    bins = F.array(*[sum((F.when(F.col("f_" + f) > cut, 1).otherwise(0) for cut in cuts[f]), F.lit(0)) for f in FEATURES])
    binned = rows.select("bad", *["f_" + f for f in FEATURES], bins.alias("bins"))
    while len(rule) < MAX_CONDITIONS:
        counts = (binned.filter(_all(rule)).select("bad", F.posexplode("bins").alias("f", "bin")).groupBy("f", "bin")
                  .agg(F.sum("bad").alias("p"), F.count("*").alias("n")).collect())
        if not counts:
            break
        total = {f: [[0, 0] for _ in range(len(cuts[f]) + 1)] for f in FEATURES}
        for r in counts:
            total[FEATURES[r.f]][r.bin] = [r.p, r.n]
        p0 = sum(p for p, _ in total[FEATURES[0]])
        n0 = sum(n for _, n in total[FEATURES[0]])
        if p0 == 0 or p0 == n0:
            break
        best, gain = None, 1e-9
        for f in FEATURES:
            below = [0, 0]
            for k, cut in enumerate(cuts[f]):
                below = [below[0] + total[f][k][0], below[1] + total[f][k][1]]
                for above, (p, n) in ((False, below), (True, (p0 - below[0], n0 - below[1]))):
                    g = p * (math.log2(p / n) - math.log2(p0 / n0)) if p else 0.0
                    if g > gain:
                        best, gain = Condition(f, above, cut), g
        if best is None:
            break
        rule += (best,)
    return rule


def learn(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> list[Rule]:
    """The decision list (rules that reject, in order) from ``stats`` (with ``id_col``) and labels.

    A row is bad if its label is 0 and good if it is 1; others, null ids and unlabelled
    documents don't take part. Two thirds of the labelled rows (by crc32 of the id) grow
    rules, one third prunes. Without bad rows the list is empty.
    """
    label = (labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("bad")).filter(F.col("bad").isin(0, 1))
             .groupBy("l_id").agg((1 - F.max("bad")).alias("bad")))
    rows = stats.filter(~F.col("base_failed")).select(F.col(id_col).alias("l_id"), *["f_" + f for f in FEATURES])
    rows = materialize(rows.join(label, "l_id").withColumn("prune", remainder(F.col("l_id"), 3) == 0).drop("l_id"), "rule-rows")
    asked = [F.percentile_approx(F.when(F.col("bad") == b, F.col("f_" + f)), list(QUANTILES), 1000).alias(f"{f}_{b}")
             for f in FEATURES for b in (0, 1)]
    found = rows.agg(*asked).first().asDict()
    values = {f: sorted({v for b in (0, 1) for v in found[f"{f}_{b}"] or []}) for f in FEATURES}
    cuts = {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in values.items()}  # midway, for a margin on both sides
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and any(cuts.values()):
        left = rows.filter(_uncovered(rules))
        rule = _grow(left.filter(~F.col("prune")), cuts)
        if not rule:
            break
        heads = [rule[:k] for k in range(1, len(rule) + 1)]
        checks = [x for k, h in enumerate(heads) for x in (
            F.coalesce(F.sum(F.when(_all(h), F.col("bad"))), F.lit(0)).alias(f"p{k}"), F.count_if(_all(h)).alias(f"n{k}"))]
        held = left.filter(F.col("prune")).agg(*checks).first().asDict()
        score = lambda k: (2 * held[f"p{k}"] - held[f"n{k}"]) / held[f"n{k}"] if held[f"n{k}"] else -1.0
        best = max(range(len(heads)), key=lambda k: (score(k), -k))
        if held[f"p{best}"] < MIN_COVER or held[f"p{best}"] < MIN_PRECISION * held[f"n{best}"]:
            break
        rules.append(heads[best])
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The ordered conditional expression: the number of the first rule that holds (from 1), else null."""
    if not rules:
        return F.lit(None).cast("int")
    out = F.when(_all(rules[0]), F.lit(1))
    for k, r in enumerate(rules[1:], 2):
        out = out.when(_all(r), F.lit(k))
    return out.cast("int")


def judge(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...], id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> tuple[DataFrame, list[Rule]]:
    """The columns ``keep``, the statistics, ``rule`` (number of the rejecting rule or
    null) and ``kept``, one row for each input row; and the list.

    - very long texts are read whole;
    - null, empty or short texts fail the base rule and are not kept;
    - repeated ids: each row is judged by its own text; if their labels differ, good wins;
    - no labels, or none of one kind: the list is empty and the base rule decides;
    - other columns are ignored, whatever their names; an empty table gives no rows.
    """
    keep = tuple(dict.fromkeys((*keep, id_col)))
    stats = materialize(statistics(docs, text_col, keep), "quality-statistics")
    rules = learn(stats.withColumnRenamed("k_" + id_col, "l_doc"), labels.select(F.col(id_col).alias("l_doc"), F.col(label_col).alias("quality")), "l_doc", "quality")
    judged = stats.withColumn("rule", verdict(rules)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    return judged, rules
