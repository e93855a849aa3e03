"""Quality rules with cross-document line frequency.

Base rules look at one text. The method then hashes normalised lines, counts per host in how many
documents each occurs, removes lines above the limits and rejects documents that are depleted by it.
Only built-in functions; texts are never shuffled for the counting.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.staging import stage
from statloom.llm.text import SPACE, let, text_key, words

WINDOW = 5


@dataclass(frozen=True)
class Limits:
    """A line is boilerplate of its host when it occurs in at least ``min_docs`` of the host's documents
    and in more than ``max_share_pct`` per cent of them. A document is depleted when fewer than
    ``min_left_words`` words or less than ``min_left_pct`` per cent of its words remain."""

    min_docs: int = 20
    max_share_pct: int = 10
    min_left_words: int = 10
    min_left_pct: int = 30


def repeat_words(tokens: Column) -> Column:
    """Words inside windows of five words that the text has twice or more (first occurrence included).

    Windows are compared by 64-bit hashes. The positions of repeated windows are looked for only when
    the text has any; each then covers five words, less what the next one covers again.
    """

    def windows(h: Column) -> Column:
        last = F.size(h) - WINDOW
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(h[i + k] for k in range(WINDOW))))

    def covered(p: Column) -> Column:
        gaps = F.zip_with(
            F.slice(p, 2, F.size(p)), p, lambda b, a: F.when(b.isNull(), WINDOW).otherwise(F.least(b - a, F.lit(WINDOW)))
        )
        return F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)

    def positions(w: Column) -> Column:
        rows = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(
            rows,
            lambda s: F.filter(
                s,
                lambda e, j: (e["h"] == F.get(s, j - 1)["h"]) | (e["h"] == F.get(s, j + 1)["h"]),
            ),
        )
        return F.sort_array(F.transform(twice, lambda e: e["i"]))

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(let(positions(w), covered))

    hashes = F.transform(tokens, lambda x: F.xxhash64(x))
    found = let(hashes, lambda h: let(windows(h), count))
    return F.when(F.size(tokens) < WINDOW, 0).otherwise(found).cast("long")


def base(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    NULL and blank texts have no words and fail.
    """
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))

    def stats(w: Column) -> Column:
        n = F.size(w).cast("long")
        return F.struct(
            n.alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeat_words(w).alias("n_repeat_words"),
        )

    failed = lambda s: (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])
    return let(let(words(text), stats), lambda s: s.withField("base_failed", failed(s)))


def _lines(text: Column) -> Column:
    """Normalised lines that have a word: lower case, white space runs as one blank, trimmed."""
    return F.filter(_all_lines(text), lambda x: x != "")


def _all_lines(text: Column) -> Column:
    """Normalised lines, one for each line of the text; lines without a word are empty."""
    flat = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\x0B\f\r]+", " ")
    return F.transform(F.split(flat, "\n"), lambda x: F.trim(x))


def without_lines(text: Column, lost: Column) -> Column:
    """The text without the lines whose normalised form has a hash in ``lost``; other lines stay as they are."""
    return let(
        F.transform(_all_lines(text), lambda x: F.xxhash64(x)),
        lambda h: F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(lost, h[i])), "\n"),
    )


def line_candidates(docs: DataFrame, id_col: str, text_col: str, host_col: str, limits: Limits) -> DataFrame:
    """Lines whose rows are above the limits: host, lh and host_docs. Repeated rows of a document count each
    here, so no line that is above the limits by distinct documents is missing.

    Counts are combined in each task before the exchange. NULL is a host of its own. Small counts go before
    the join with the hosts' totals.
    """
    host = F.col(host_col).cast("string")
    counted = (
        docs.select(
            host.alias("host"),
            F.explode(F.array_distinct(F.transform(_lines(F.col(text_col)), lambda x: F.xxhash64(x)))).alias("lh"),
        )
        .groupBy("host", "lh")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= limits.min_docs)
    )
    hosts = docs.groupBy(host.alias("h")).agg(F.count("*").alias("host_docs"))
    return (
        counted.join(hosts, F.col("host").eqNullSafe(F.col("h")))
        .where(100 * F.col("n") > limits.max_share_pct * F.col("host_docs"))
        .select("host", "lh", "host_docs")
    )


def removals(docs: DataFrame, id_col: str, text_col: str, host_col: str, limits: Limits) -> DataFrame:
    """Per document that loses lines: id, tk, n_words, removed_words, lost (hashes of the lines), depleted.

    A document counts once for a line however often it has it and however often its row repeats; rows without
    an id count for none. Only the lines of the candidates are written for that, not the texts. The document
    with the smallest id of a host keeps the line, so that one whole copy of any passage survives. Repeated
    rows (same id and text) share one result.
    """
    candidates = stage(line_candidates(docs, id_col, text_col, host_col, limits)).select(
        F.col("host").alias("f_host"), F.col("lh").alias("f_lh"), "host_docs"
    )
    text = F.col(text_col)
    lines = docs.select(
        F.col(id_col).alias("id"),
        text_key(text).alias("tk"),
        F.col(host_col).cast("string").alias("host"),
        F.size(words(text)).alias("n_words"),
        F.posexplode(F.transform(_lines(text), lambda x: F.struct(F.xxhash64(x).alias("lh"), F.size(F.split(x, " ")).alias("w")))).alias(
            "pos", "line"
        ),
    )
    found = stage(
        lines.join(candidates, (F.col("line.lh") == F.col("f_lh")) & F.col("host").eqNullSafe(F.col("f_host"))).select(
            "id", "tk", "host", "n_words", "pos", "line", "host_docs"
        )
    )
    frequent = (
        found.groupBy(F.col("host").alias("f_host"), F.col("line.lh").alias("f_lh"), "id")
        .agg(F.max("host_docs").alias("host_docs"))
        .groupBy("f_host", "f_lh")
        .agg(F.count("id").alias("n"), F.min("id").alias("first_id"), F.max("host_docs").alias("host_docs"))
        .where((F.col("n") >= limits.min_docs) & (100 * F.col("n") > limits.max_share_pct * F.col("host_docs")))
        .select("f_host", "f_lh", "first_id")
    )
    hit = found.join(
        frequent,
        (F.col("line.lh") == F.col("f_lh"))
        & F.col("host").eqNullSafe(F.col("f_host"))
        & ~F.col("id").eqNullSafe(F.col("first_id")),
    )
    lost = (
        hit.groupBy("id", "tk", "pos")
        .agg(F.max("n_words").alias("n_words"), F.max("line.w").alias("w"), F.max("line.lh").alias("lh"))
        .groupBy("id", "tk")
        .agg(
            F.max("n_words").cast("long").alias("n_words"), F.sum("w").cast("long").alias("removed_words"),
            F.collect_set("lh").alias("lost"),
        )
    )
    left = F.col("n_words") - F.col("removed_words")
    depleted = (left < limits.min_left_words) | (100 * left < limits.min_left_pct * F.col("n_words"))
    return lost.withColumn("depleted", depleted)


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limits: Limits = Limits(),  # noqa: B008
) -> DataFrame:
    """One row per document: its id, the base figures, removed_words and kept.

    NULL or blank texts have no words, fail and are not kept. Repeated rows get one row each, with equal
    figures. An empty table gives an empty result; other columns of ``docs`` are not read.
    """
    lost = removals(docs, id_col, text_col, host_col, limits).select(
        F.col("id").alias("l_id"), F.col("tk").alias("l_tk"), "removed_words", "depleted"
    )
    stats = docs.select(
        F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"), base(F.col(text_col)).alias("s")
    )
    joined = stats.join(lost, F.col("id").eqNullSafe(F.col("l_id")) & (F.col("tk") == F.col("l_tk")), "left")
    return joined.select(
        F.col("id").alias(id_col),
        "s.*",
        F.coalesce("removed_words", F.lit(0)).alias("removed_words"),
        (~F.col("s.base_failed") & ~F.coalesce("depleted", F.lit(False))).alias("kept"),
    )


def keep_good(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limits: Limits = Limits(),  # noqa: B008
    chars_col: str = "n_chars",
) -> DataFrame:
    """The documents that pass, with all their columns: the text without the lines above the limits, and
    ``chars_col``, if there is such a column, as its new length. Documents that lose nothing stay as they are.
    Only the keys of documents that lose lines, with the hashes of these, are written and joined; their
    true size decides how Spark joins them."""
    lost = removals(docs, id_col, text_col, host_col, limits)
    lost = stage(lost.select(F.col("id").alias("__id"), F.col("tk").alias("__tk"), F.col("lost").alias("__lost"), F.col("depleted").alias("__gone")))
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"), base(F.col(text_col)).alias("s"),
    )
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("tk") == F.col("__tk"))
    kept = packed.where("not s.base_failed").select("doc", "id", "tk").join(lost, same, "left").where("not coalesce(__gone, false)")
    old = F.col("doc").getField(text_col)
    kept = kept.withColumn("clean", F.when(F.col("__lost").isNotNull(), without_lines(old, F.col("__lost"))).otherwise(old))

    def out(c: str) -> Column:
        value = F.col("doc").getField(c)
        if c == text_col:
            value = F.col("clean")
        elif c == chars_col:
            value = F.when(F.col("__lost").isNotNull(), F.length("clean").cast(docs.schema[c].dataType)).otherwise(value)
        return value.alias(c)

    return kept.select(*map(out, docs.columns))
