"""Mixing sources to target weights by weighted fair queueing.

Every source shuffles its documents and gives each a virtual finish time: the tokens of the source up
to and including it, divided by the source's target. Documents are then taken in the order of finish
time, over all sources, until the total budget is used. A source whose target exceeds its size goes
round a second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm.staging import stage
from statloom.llm.text import hex32, text_key, word_count

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
EPOCHS = 2
SEED = "mix"
#: Rows that one window of a source holds on average.
SLICE_ROWS = 10_000
#: Cells per level when the budget's end is looked for.
GRID = 1024


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """Tokens to take of each source: source, source_size, target.

    Sources by code point, NULL last, get the weights in turn and share ``budget`` times all sizes. A
    target stops at ``epochs`` times its source's size; the excess is shared again by weight. Sorted by
    cap per weight the capped sources come first: a source is free from the first one whose cap exceeds
    its part of what the sources before it leave.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.array(*(F.lit(w) for w in weights))
    w = sizes.select(
        "source", "source_size",
        F.element_at(turn, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long").alias("weight"),
        (F.col("source_size") * epochs).alias("cap"),
    )
    ratio = F.col("cap") / F.col("weight")
    by_cap = Window.orderBy(ratio, F.col("source").isNull(), F.col("source"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.lit(float(budget)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    heirs = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    w = w.withColumn("level", left / heirs).withColumn("rank", F.row_number().over(by_cap))
    free = F.when(ratio > F.col("level"), F.struct("rank", "level"))
    level = F.min(free).over(everything)["level"]
    target = F.when(level.isNull() | (ratio <= level), F.col("cap").cast("double")).otherwise(F.col("weight") * level)
    return w.select("source", "source_size", target.alias("target"))


def _cut(rows: DataFrame, total: float) -> tuple | None:
    """Last copy, in the order of the mix, with which the running size stays within the budget.

    Finish times are cut into a fixed grid; sizes are summed per cell, and the cell in which the budget
    ends is cut again. The last of these cells holds about one row in GRID**2, over which one window
    runs. What reaches the driver are the sums of one grid, never rows of the data.
    """
    at = F.col("finish")
    cell = F.least(F.floor(at * GRID), F.lit(2 * GRID)).cast("long")
    fine = F.when(cell < 2 * GRID, F.floor((at * GRID - cell) * GRID)).otherwise(F.floor(F.log1p(at) * GRID)).cast("long")
    left, where = total, F.lit(True)
    lower = F.lit(False)
    for grid in (cell, fine):
        sums = rows.where(where).groupBy(grid.alias("cell")).agg(F.sum("size").alias("size")).orderBy("cell").collect()
        full = None
        for r in sums:
            if r["size"] > left:
                full = r["cell"]
                break
            left -= r["size"]
        if full is None:
            lower = lower | where
            where = F.lit(False)
            break
        lower = lower | (where & (grid < full))
        where = where & (grid == full)
    order = [F.col(c) for c in ("finish", "key", "id", "epoch")]
    running = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = rows.where(where).withColumn("running", running).where(F.col("running") <= left)
    pick = lambda df: df.select(F.max(F.struct(*order)).alias("m")).first()["m"]
    return pick(within) or pick(rows.where(lower))


def shares(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: id, source, tk, size, source_size, target, copies, taken, finish.

    The shuffle is the order of an MD5 digest of seed, id and text, so reruns agree. Running sums of a
    source are taken in slices of its shuffled order, with the sums of the earlier slices added: a hot
    source is many windows. NULL texts and texts without words have size 0 and are never taken; NULL is
    a source of its own. Repeated rows are separate documents.
    """
    text = F.col(text_col)
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    slim = stage(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), text_key(text).alias("tk"),
            word_count(text).alias("size"), key.alias("key"),
        )
    )
    per_source = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    goal = targets(per_source, weights, budget, epochs).select(
        F.col("source").alias("t_source"), F.col("source_size").alias("t_size"), "target"
    )
    goal = stage(per_source.join(goal, F.col("source").eqNullSafe(F.col("t_source")))).select(
        "t_source", "n", F.col("t_size").alias("source_size"), "target"
    )
    sliced = slim.join(goal, F.col("source").eqNullSafe(F.col("t_source"))).withColumn(
        "slice", F.floor(hex32(F.col("key")) * F.ceil(F.col("n") / SLICE_ROWS) / F.lit(1 << 32))
    )
    earlier = Window.partitionBy("s_source").orderBy("s_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy(F.col("source").alias("s_source"), F.col("slice").alias("s_slice"))
        .agg(F.sum("size").alias("s_size"))
        .withColumn("start", F.coalesce(F.sum("s_size").over(earlier), F.lit(0)))
    )
    inside = Window.partitionBy("source", "slice").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = stage(
        sliced.join(starts, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("slice") == F.col("s_slice")))
        .withColumn("cum", F.col("start") + F.sum("size").over(inside))
        .select("id", "source", "tk", "size", "key", "source_size", "target", "cum")
    )
    ends = lambda e: F.try_divide((F.col("source_size") * e + F.col("cum")).cast("double"), F.col("target"))
    copies = placed.where("size > 0").select(
        "id", "key", "size",
        F.explode(F.array(*(F.struct(ends(e).alias("finish"), F.lit(e).alias("epoch")) for e in range(epochs)))).alias("c"),
    ).select("id", "key", "size", "c.*")
    total = goal.agg(F.sum("target")).first()[0] or 0.0
    cut = _cut(copies, total)
    if cut is None:
        n = F.lit(0)
    else:
        last = F.struct(*(F.lit(v).cast(t).alias(c) for (c, v), t in zip(cut.asDict().items(), ("double", "string", dict(placed.dtypes)["id"], "int"), strict=True)))
        mine = lambda e: F.struct(ends(e).alias("finish"), F.col("key"), F.col("id"), F.lit(e).alias("epoch"))
        n = sum(((mine(e) <= last).cast("long") for e in range(epochs)), F.lit(0).cast("long"))
    n = F.when(F.col("size") > 0, n).otherwise(0).cast("long")
    return placed.withColumn("copies", n).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "tk", "size", "source_size", "target",
        "copies", (F.col("copies") * F.col("size")).alias("taken"), ends(0).alias("finish"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", ordered: bool = True, **settings) -> DataFrame:
    """The mixed documents with all their columns, each as often as it is taken; in the order of the
    mix (a range sort by finish time) unless ``ordered`` is false. Rows that repeat in id, text and
    source are told apart by their number, so none is lost or doubled."""
    share = (
        shares(docs, id_col, text_col, source_col, **settings)
        .where("copies > 0 or size = 0")
        .groupBy(F.col(id_col).alias("s_id"), F.col("tk").alias("s_tk"), F.col(source_col).alias("s_source"))
        .agg(F.sort_array(F.collect_list(F.struct("copies", "finish")), asc=False).alias("s"))
    )
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col(id_col).alias("id"),
        text_key(F.col(text_col)).alias("tk"), F.col(source_col).cast("string").alias("source"),
    )
    joined = packed.join(
        share,
        F.col("id").eqNullSafe(F.col("s_id")) & (F.col("tk") == F.col("s_tk")) & F.col("source").eqNullSafe(F.col("s_source")),
    )
    number = F.row_number().over(Window.partitionBy("s_id", "s_tk", "s_source").orderBy("s_tk"))
    taken = joined.withColumn("mine", F.get("s", number - 1)).where("mine.copies > 0")
    rounds = taken.select("doc", "mine.finish", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mine.copies"))).alias("epoch"))
    out = rounds.orderBy("epoch", "finish") if ordered else rounds
    return out.select("doc.*")
