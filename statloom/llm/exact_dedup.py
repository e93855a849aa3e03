"""Exact deduplication in two passes with a Bloom filter.

Pass 1 sets ``PROBES`` bits per text in a blocked Bloom filter and keeps the bits that more than one
text sets. Pass 2 shuffles only the rows all of whose bits were set twice; every other row is unique
and goes straight through. The second pass compares SHA-256 digests, so the filter never decides alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.staging import stage
from statloom.llm.text import text_key, without_space

BLOCK_BITS = 32768  # bits of one bitmap of bitmap_construct_agg
PROBES = 2
BITS_PER_ROW = 24
#: The filter is broadcast up to this size; a larger one is joined by block, whatever its size.
BROADCAST_BYTES = 32 << 20


def _probe(sha: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a digest and its bits there, each from other digits of the digest."""
    block = F.conv(F.substring(sha, 1, 12), 16, 10).cast("long") % F.lit(blocks)
    digits = [F.conv(F.substring(sha, 13 + 4 * k, 4), 16, 10).cast("long") for k in range(PROBES)]
    return block, [d % F.lit(BLOCK_BITS) for d in digits]


def repeated_bits(digests: DataFrame, blocks: int) -> DataFrame:
    """The filter: per block a bitmap of the bits that two rows or more set. Slots are counted in each
    task before the exchange, so a text with many copies is one row of it."""
    block, bits = _probe(F.col("sha"), blocks)
    slots = digests.select(F.explode(F.array_distinct(F.array(*(block * BLOCK_BITS + b for b in bits)))).alias("slot"))
    twice = slots.groupBy("slot").agg(F.count("*").alias("n")).where("n > 1")
    return twice.groupBy(F.expr(f"slot div {BLOCK_BITS}").alias("f_block")).agg(
        F.expr(f"bitmap_construct_agg(slot % {BLOCK_BITS})").alias("f_bits")
    )


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.substring(bitmap, F.lit(1) + F.shiftright(bit, 3).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (bit % 8).cast("int")) == 1


def _suspects(rows: DataFrame, bloom: DataFrame, blocks: int, broadcast_bytes: int) -> DataFrame:
    """``rows`` (with a column ``sha``) and a flag: all bits of the row were set twice."""
    if blocks * (BLOCK_BITS // 8 + 64) <= broadcast_bytes:
        bloom = F.broadcast(bloom)
    block, bits = _probe(F.col("sha"), blocks)
    hit = F.lit(True)
    for bit in bits:
        hit &= F.coalesce(_is_set(F.col("f_bits"), bit), F.lit(False))
    names = [F.col(f"`{c}`") for c in rows.columns]
    return rows.join(bloom, block == F.col("f_block"), "left").select(*names, hit.alias("suspect"))


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("id"),
        text_key(text).alias("tk"),
        F.length(F.coalesce(text, F.lit(""))).cast("long").alias("n_chars"),
        F.sha2(without_space(text), 256).alias("sha"),
        F.monotonically_increasing_id().alias("row"),
    )


def _filter(docs: DataFrame, id_col: str, text_col: str, bits_per_row: int) -> tuple[DataFrame, DataFrame, int]:
    """Digests, written once; the filter; its number of blocks, which follows the number of rows."""
    digests = stage(_digests(docs, id_col, text_col))
    blocks = max(1, -(-digests.count() * bits_per_row // BLOCK_BITS))
    return digests, stage(repeated_bits(digests, blocks)), blocks


def _exact(suspects: DataFrame) -> DataFrame:
    """Second pass over the suspects: best row and size of each group by its whole digest. Groups are
    combined in each task and written; the join back has an exchange of its own on either side, so Spark
    can split it where a group is hot."""
    rank = F.struct((-F.col("n_chars")).alias("c"), F.col("id").isNull().alias("z"), F.col("id"), F.col("row"))
    groups = suspects.groupBy(F.col("sha").alias("g_sha")).agg(F.min(rank).alias("best"), F.count("*").alias("n"))
    best = stage(groups.where("n > 1").select("g_sha", "n", F.col("best.id").alias("best_id"), F.col("best.row").alias("best_row")))
    single = F.col("n").isNull()
    return suspects.join(best, F.col("sha") == F.col("g_sha"), "left").select(
        "id", "tk", "n_chars", "sha", F.coalesce("n", F.lit(1)).alias("group_size"),
        F.when(single, F.col("id")).otherwise(F.col("best_id")).alias("keep_id"),
        (single | (F.col("row") == F.col("best_row"))).alias("kept"),
    )


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits_per_row: int = BITS_PER_ROW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256 and n_chars.

    Texts are equal without white space; NULL counts as empty, and empty texts equal each other. Of
    equal texts the row with the most code points of the original text stays, then the smallest id
    (NULL ids last); of rows that repeat in both, one stays. The table may be empty; other columns are
    not read.
    """
    digests, bloom, blocks = _filter(docs, id_col, text_col, bits_per_row)
    marked = _suspects(digests, bloom, blocks, broadcast_bytes)
    alone = marked.where("not suspect").select(
        "id", "tk", "n_chars", "sha", F.lit(1).cast("long").alias("group_size"),
        F.col("id").alias("keep_id"), F.lit(True).alias("kept"),
    )
    return alone.union(_exact(marked.where("suspect"))).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"), "n_chars"
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits_per_row: int = BITS_PER_ROW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rows that stay, with all their columns. Rows the filter clears are never shuffled; suspects
    are matched with the keys (id and text digest) of the rows that the second pass drops. Rows that
    repeat in id and text are reduced to one."""
    digests, bloom, blocks = _filter(docs, id_col, text_col, bits_per_row)
    exact = _exact(_suspects(digests, bloom, blocks, broadcast_bytes).where("suspect"))
    dropped = stage(
        exact.where("group_size > 1")
        .groupBy(F.col("id").alias("d_id"), F.col("tk").alias("d_tk"))
        .agg(F.count("*").alias("d_n"), F.max("kept").alias("d_kept"))
        .where("not d_kept or d_n > 1")
    )
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"),
        F.sha2(without_space(F.col(text_col)), 256).alias("sha"),
    )
    marked = _suspects(packed, bloom, blocks, broadcast_bytes)
    same = F.col("id").eqNullSafe(F.col("d_id")) & (F.col("tk") == F.col("d_tk"))
    doubt = marked.where("suspect")
    once = doubt.join(dropped.where("d_kept"), same, "left_semi").dropDuplicates(["id", "tk"])
    kept = marked.where("not suspect").select("doc").union(
        doubt.join(dropped, same, "left_anti").select("doc")
    ).union(once.select("doc"))
    return kept.select("doc.*")
