"""The registered queries: each applies its operator, with production parameters,
to its whole table and derives the contract's columns from the operator's output."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm import (chat, decontam, langid, linededup, packing, pagediff, periodic, pst, rules, secretscan, simhash, spelling,
                         tokencounts)
from paylake.llm.common import read
from paylake.llm.oracle import ORACLE  # noqa: F401

RUN = "struct<start: bigint, length: bigint, period: bigint>"


def op1_langid(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = langid.identify(docs, langid.learn(docs.filter(~langid.held_out(F.col("doc_id")))))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_secrets(spark, sf_dir) -> DataFrame:
    found = secretscan.scan_secrets(read(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = F.filter("spans", lambda x: x["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op3_lm(spark, sf_dir) -> DataFrame:
    return pst.score_texts(read(spark, sf_dir, "documents"))


def op4_chat(spark, sf_dir) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    tricky = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    back = chat.read_back(chat.format_chats(turns.unionByName(added)))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                       F.length(chat.loss_text(F.col("turns"))).cast("long").alias("loss_chars"),
                       F.sha2(chat.loss_text(F.col("turns")), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op5_packing(spark, sf_dir) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op6_linededup(spark, sf_dir) -> DataFrame:
    out = linededup.dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_tokencounts(spark, sf_dir) -> DataFrame:
    return tokencounts.token_counts(read(spark, sf_dir, "documents"))


def op8_quality(spark, sf_dir) -> DataFrame:
    judged, _ = rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), ("doc_id",))
    return judged.select(F.col("k_doc_id").alias("doc_id"), *rules.STATS, "base_failed", "kept")


def op9_simhash(spark, sf_dir) -> DataFrame:
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_decontam(spark, sf_dir) -> DataFrame:
    out = decontam.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def misspelt(doc_id, word: str) -> str:
    """The contract's change of a word: by its hash with the document's id, one in 97 loses a letter."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if h % 97:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def op11_spelling(spark, sf_dir) -> DataFrame:
    return spelling.spelling_groups(spelling.lexicon(read(spark, sf_dir, "documents"), alter=misspelt))


def made_periodic(doc_id, words: list[bytes]) -> list[bytes]:
    """The contract's change of a text: by the hash of its document's id, one in ten repeats a
    part of its words from some word on. A null id changes nothing."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def op12_periodic(spark, sf_dir) -> DataFrame:
    found = periodic.periodic_runs(read(spark, sf_dir, "documents"), alter=made_periodic)
    # Runs come by start, then period, so the first of equal exponents stays.
    best = F.reduce("runs", F.lit(None).cast(RUN), lambda a, x: F.when(
        a.isNull() | (x["length"] * a["period"] > a["length"] * x["period"]), x).otherwise(a))
    listed = F.array_join(F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))), "")
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.expr("best.length * 1000 div best.period").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words"))


def op13_pages(spark, sf_dir) -> DataFrame:
    out = pagediff.main_text(read(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {f.__name__: f for f in (op1_langid, op2_secrets, op3_lm, op4_chat, op5_packing, op6_linededup, op7_tokencounts,
                                   op8_quality, op9_simhash, op10_decontam, op11_spelling, op12_periodic, op13_pages)}
