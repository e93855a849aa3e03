"""Near-duplicate documents by min-max hashing.

Every permutation gives two signature values, the minimum and the maximum of the shingle hashes under
it, so half the hash evaluations fill a signature of the same length. Bands of the signature propose
candidates, two bits of every value reject most of those without a link before any text moves, and every
link is confirmed on the whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm.components import components
from statloom.llm.hashing import mixed, prefix_hashes, span_hash
from statloom.llm.staging import stage
from statloom.llm.text import text_key

SHINGLE_WORDS = 5
SIMILARITY_PCT = 80
#: 128 permutations give 256 values: 42 bands of 6. A pair at 0.8 is missed with probability 3e-6.
PERMUTATIONS = 128
BAND_ROWS = 6
#: A bucket of more members that its hub has not joined is compared as a whole, in blocks.
CROWD = 16
#: Shingles of the members of one block; a task holds two blocks.
BLOCK_SHINGLES = 1 << 17
#: Standard deviations by which the estimate of a pair may fall short of the similarity asked for.
SLACK = 4.2

_CHUNK = 8192
_WIDE = 4096
_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text; A-Z count as a-z. A text of fewer
    words is one shingle; a text without words has none."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_FOLD), np.uint8)
    edge = np.diff(np.concatenate([[True], _BLANK[data], [True]]).astype(np.int8))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.zeros(0, np.uint64)
    word = span_hash(prefix_hashes(data), start, stop)
    width = min(width, len(word))
    total = np.full(len(word) - width + 1, width, np.uint64)
    for k in range(width):
        total = mixed(total * np.uint64(0xD6E8FEB86659FD93) + word[k : len(word) - width + 1 + k])
    return np.unique(total)


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    values = (seeds >> np.uint64(32)).astype(np.uint32)
    return values[:n] | np.uint32(1), values[n:]


def signature(hashes: np.ndarray, permutations: int) -> np.ndarray:
    """Minimum and maximum of a shingle set under every permutation, one after the other."""
    factor, shift = _permutations(permutations)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    low, high = np.full(permutations, 0xFFFFFFFF, np.uint32), np.zeros(permutations, np.uint32)
    for i in range(0, len(x), _CHUNK):
        h = (x[i : i + _CHUNK, None] ^ shift) * factor
        np.minimum(low, h.min(axis=0), out=low)
        np.maximum(high, h.max(axis=0), out=high)
    return np.stack([low, high], axis=1).ravel().astype(np.uint64)


def bands(values: np.ndarray, rows: int) -> np.ndarray:
    """Band keys of a signature: hashes of ``rows`` neighbouring values."""
    count = len(values) // rows
    key = np.arange(1, count + 1, dtype=np.uint64)
    for k in range(rows):
        key = mixed(key * np.uint64(0xD6E8FEB86659FD93) + values[k : count * rows : rows])
    return key


def sketch(values: np.ndarray) -> np.ndarray:
    """Two bits of every value of a signature, 32 values a word."""
    bits = np.zeros(-(-len(values) // 32) * 32, np.uint64)
    bits[: len(values)] = mixed(values + np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(62)
    return np.bitwise_or.reduce(bits.reshape(-1, 32) << np.arange(0, 64, 2, dtype=np.uint64), axis=1)


def most_apart(permutations: int, similarity_pct: int, slack: float = SLACK) -> int:
    """Values of two sketches that differ at most where the sets are similar enough: the mean and
    ``slack`` standard deviations. Values that differ agree in their two bits by a chance of a quarter."""
    n, p = 2 * permutations, 0.75 * (1 - similarity_pct / 100)
    return int(n * p + slack * (n * p * (1 - p)) ** 0.5)


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int, permutations: int, rows: int) -> DataFrame:
    """Per row: id, tk, row, n_shingles, two digests of the set, its band keys and the words s0, s1, … of
    its sketch (keys are empty and words zero without shingles)."""
    words = -(-2 * permutations // 32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3)
            for first in range(0, batch.num_rows, 256):
                sets = [shingles(t.as_py(), width) for t in texts[first : first + 256]]
                values = [signature(s, permutations) if len(s) else s for s in sets]
                keys = [bands(v, rows) if len(v) else v for v in values]
                sketches = np.array([sketch(v) if len(v) else np.zeros(words, np.uint64) for v in values], np.uint64)
                ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
                part = batch.slice(first, len(sets))
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:3],
                        pa.array([len(s) for s in sets], pa.int64()),
                        _long(np.array([np.bitwise_xor.reduce(s, initial=0) for s in sets], np.uint64)),
                        _long(np.array([mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64)),
                        pa.ListArray.from_arrays(ends, _long(np.concatenate(keys))),
                        *(_long(np.ascontiguousarray(w)) for w in sketches.T),
                    ],
                    names=["id", "tk", "row", "n_shingles", "d1", "d2", "bands", *(f"s{k}" for k in range(words))],
                )

    text = F.col(text_col).cast("string")
    slim = docs.select(
        F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"), F.monotonically_increasing_id().alias("row"), text.alias("text")
    )
    kind = dict(slim.dtypes)["id"]
    return slim.mapInArrow(run, f"id {kind}, tk long, row long, n_shingles long, d1 long, d2 long, bands array<long>" + "".join(f", s{k} long" for k in range(words)))


def confirmed(pairs: DataFrame, width: int, similarity_pct: int) -> DataFrame:
    """Of the pairs (a, b, a_text, b_text) those whose whole shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[int, tuple[int, np.ndarray]] = {}

        def known(side: int, node: int, batch: pa.RecordBatch, k: int) -> np.ndarray:
            """Shingles of one side of a pair; rows of one node follow each other on at least one side."""
            if side not in last or last[side][0] != node:
                last[side] = node, shingles(batch.column(2 + side)[k].as_py(), width)
            return last[side][1]

        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for k, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                one, other = known(0, a, batch, k), known(1, b, batch, k)
                both = len(np.intersect1d(one, other, assume_unique=True))
                ok[k] = 100 * both >= similarity_pct * (len(one) + len(other) - both)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(ok))

    return pairs.select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long")


def _apart(sketched: list[str]) -> Column:
    """In how many values two sketches differ."""
    odd = F.lit(0x5555555555555555)
    total = F.lit(0)
    for s in sketched:
        both = F.col(s).bitwiseXOR(F.col(f"h_{s}"))
        total = total + F.bit_count(both.bitwiseOR(F.shiftrightunsigned(both, 1)).bitwiseAND(odd))
    return total


def _near(similarity_pct: int, apart: Column, sketched: list[str]) -> Column:
    """Whether set sizes allow a link at all and sketches do not rule it out."""
    fits = 100 * F.least("size", "h_size") >= similarity_pct * F.greatest("size", "h_size")
    return fits & (_apart(sketched) <= apart)


def _with_hubs(members: DataFrame, near: Column, sketched: list[str]) -> DataFrame:
    """Members of buckets but for the hub of each, with it and whether the two may have a link. The hub is the
    most central node: the original of many edited copies shares more buckets with them than they share
    among each other."""
    lead = F.max(F.struct("central", "node", "size", *sketched)).alias("lead")
    hubs = members.groupBy(F.col("bucket").alias("h_bucket")).agg(lead).select(
        "h_bucket", F.col("lead.node").alias("hub"), F.col("lead.size").alias("h_size"),
        *(F.col(f"lead.{s}").alias(f"h_{s}") for s in sketched),
    )
    met = members.join(hubs, (F.col("bucket") == F.col("h_bucket")) & (F.col("node") != F.col("hub")))
    return met.select("bucket", "node", "size", *sketched, "hub", near.alias("near"))


def _mixed(state: DataFrame) -> DataFrame:
    """Members of the buckets that still join different labels, with their number ``n``."""
    buckets = state.groupBy(F.col("bucket").alias("k")).agg(
        F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")
    )
    return state.join(buckets.where("lo <> hi").select("k", "n"), F.col("bucket") == F.col("k")).drop("k")


def _pairs_within(members: DataFrame, near: Column, sketched: list[str]) -> DataFrame:
    """All pairs of members of one bucket with different labels that may have a link."""
    other = members.select(
        F.col("bucket").alias("h_bucket"), F.col("node").alias("hub"), F.col("size").alias("h_size"), F.col("label").alias("h_label"),
        *(F.col(s).alias(f"h_{s}") for s in sketched),
    )
    same = (F.col("bucket") == F.col("h_bucket")) & (F.col("node") < F.col("hub")) & (F.col("label") != F.col("h_label"))
    return members.join(other, same & near).select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()


def _shared(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of one list with every set of the other."""
    lengths = np.array([len(s) for s in [*one, *other]])
    code = np.unique(np.concatenate([*one, *other]), return_inverse=True)[1]
    owner, common = np.repeat(np.arange(len(lengths)), lengths), np.bincount(code)[code] > 1
    code, owner = np.unique(code[common], return_inverse=True)[1], owner[common]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    total = np.zeros((len(one), len(other)), np.float32)
    cuts = np.searchsorted(code, np.arange(0, code[-1] + _WIDE + 1, _WIDE)) if len(code) else []
    for first, stop in zip(cuts[:-1], cuts[1:], strict=True):
        has = np.zeros((len(lengths), _WIDE), np.float32)
        has[owner[first:stop], code[first:stop] % _WIDE] = 1
        total += has[: len(one)] @ has[len(one) :].T
    return total.astype(np.int64)


def _joined(one: list[np.ndarray], other: list[np.ndarray], similarity_pct: int) -> np.ndarray:
    """Per set of both lists the first one that it is connected with over links from list to list."""
    both = _shared(one, other)
    sizes = np.array([len(s) for s in one])[:, None] + np.array([len(s) for s in other])
    linked = 100 * both >= similarity_pct * (sizes - both)
    root = np.arange(len(one) + len(other))
    while True:
        a, b = root[: len(one)], root[len(one) :]
        a = np.minimum(a, np.where(linked, b, len(root)).min(axis=1))
        b = np.minimum(b, np.where(linked, a[:, None], len(root)).min(axis=0))
        now = np.concatenate([a, b])
        if (now == root).all():
            return root
        root = now


def _blocks(inside: DataFrame) -> DataFrame:
    """Members of crowded buckets dealt to blocks: node, size, label, block. A node goes with the largest
    bucket that it is in, whose nodes are cut by size."""
    homes = inside.groupBy("node", "size", "label").agg(F.max(F.struct("n", "bucket"))["bucket"].alias("home"))
    running = F.sum("size").over(Window.partitionBy("home").orderBy("size", "node").rowsBetween(Window.unboundedPreceding, -1))
    cut = F.floor(F.coalesce(running, F.lit(0)) / BLOCK_SHINGLES)
    return homes.select("node", "size", "label", F.xxhash64("home", cut).alias("block"))


def _block_links(inside: DataFrame, texts: DataFrame, width: int, similarity_pct: int) -> DataFrame:
    """Links (a, b) that connect all members of crowded buckets with a link between them. Two blocks that meet
    in a bucket are compared once, set by set, unless no sizes fit or one label is left."""
    blocks = stage(_blocks(inside))
    bounds = blocks.groupBy("block").agg(
        F.min("size").alias("lo"), F.max("size").alias("hi"), F.min("label").alias("first"), F.max("label").alias("last")
    )
    met = inside.select("bucket", "node").join(blocks.select("node", "block"), "node").select("bucket", "block").distinct()
    met = stage(met.join(bounds, "block"))
    other = met.select(F.col("bucket").alias("o_bucket"), *(F.col(c).alias(f"o_{c}") for c in ("block", "lo", "hi", "first", "last")))
    fits = (100 * F.col("hi") >= similarity_pct * F.col("o_lo")) & (100 * F.col("o_hi") >= similarity_pct * F.col("lo"))
    joins = F.least("first", "o_first") < F.greatest("last", "o_last")
    same = (F.col("bucket") == F.col("o_bucket")) & (F.col("block") <= F.col("o_block"))
    pairs = stage(met.join(other, same & fits & joins).select(F.col("block").alias("x"), F.col("o_block").alias("y")).distinct())
    rows = texts.join(blocks.select("node", "block"), "node")

    def compare(table: pa.Table) -> pa.Table:
        nodes, side = table.column("node").to_numpy(), table.column("side").to_numpy()
        sets = [shingles(t.as_py(), width) for t in table.column("text")]
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(two):
            two = one
        order = np.concatenate([one, two])
        root = order[_joined([sets[k] for k in one], [sets[k] for k in two], similarity_pct)]
        far = nodes[root] != nodes[order]
        a, b = nodes[root][far], nodes[order][far]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    sides = (("x", F.lit(True)), ("y", F.col("x") < F.col("y")))
    dealt = [
        pairs.where(some).join(rows, F.col(c) == F.col("block")).select("x", "y", F.lit(k).alias("side"), "node", "text")
        for k, (c, some) in enumerate(sides)
    ]
    return dealt[0].union(dealt[1]).groupBy("x", "y").applyInArrow(compare, "a long, b long").distinct()


def _labels(links: DataFrame) -> DataFrame:
    """Per linked node the smallest node within two links: nodes of one label are surely connected."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = stage(both.groupBy("a").agg(F.least(F.min("a"), F.min("b")).alias("m")))
    next_ = both.join(low.select(F.col("a").alias("u"), "m"), F.col("b") == F.col("u"))
    return next_.groupBy(F.col("a").alias("l_node")).agg(F.min("m").alias("l"))


def _labelled(state: DataFrame, links: DataFrame) -> DataFrame:
    return state.join(_labels(links), F.col("node") == F.col("l_node"), "left").select(
        *state.columns, F.coalesce("l", "node").alias("label")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    similarity_pct: int = SIMILARITY_PCT,
    permutations: int = PERMUTATIONS,
    band_rows: int = BAND_ROWS,
    exhaustive: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, tk, row, n_shingles, component_id, first.

    Rows with equal sets form one class, and one row of each class stands for it. ``component_id`` is
    the smallest id reached over links of classes; ``first`` marks one row of each component, that of
    the smallest id (NULL ids last). Texts without words are linked with nothing; repeated rows are one
    class; an empty table gives an empty result. Other columns are not read.

    Members of a crowded bucket are compared by their whole sets, block by block, so that only texts of blocks
    and links move. ``exhaustive`` compares hubs with members, and all members of a smaller bucket that hubs
    have not connected, whatever their sketches.
    """
    sketched = [f"s{k}" for k in range(-(-2 * permutations // 32))]
    apart = F.lit(most_apart(permutations, similarity_pct))
    if exhaustive:
        apart = F.lit(32 * len(sketched))
    rows = stage(signatures(docs, id_col, text_col, width, permutations, band_rows))
    place = F.struct(F.col("id").isNull().alias("z"), F.col("id"), F.col("row"))
    worded = rows.where("n_shingles > 0")
    heads = stage(worded.groupBy("d1", "d2", "n_shingles").agg(F.min("row").alias("node")))
    sets = worded.join(heads.select(F.col("node").alias("h")), F.col("row") == F.col("h"), "left_semi")
    buckets = sets.select(F.col("row").alias("node"), F.col("n_shingles").alias("size"), F.explode("bands").alias("bucket"))
    shared = buckets.groupBy(F.col("bucket").alias("k")).agg(F.count("*").alias("n")).where("n > 1")
    shared = buckets.join(shared, F.col("bucket") == F.col("k"))
    central = F.sum("n").over(Window.partitionBy("node"))
    words = rows.select(F.col("row").alias("s_node"), *sketched)
    members = stage(
        shared.select("bucket", "node", "size", central.alias("central"))
        .join(words, F.col("node") == F.col("s_node"))
        .drop("s_node")
    )

    nodes = members.select("node").distinct()
    wanted = rows.join(nodes, F.col("row") == F.col("node"), "left_semi").select(
        F.col("row").alias("node"), F.col("id").alias("w_id"), F.col("tk").alias("w_tk")
    )
    texts = stage(
        docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk"), F.col(text_col).cast("string").alias("text"))
        .join(wanted, F.col("id").eqNullSafe(F.col("w_id")) & (F.col("tk") == F.col("w_tk")))
        .select("node", "text")
        .dropDuplicates(["node"])
    )
    # Each bucket's hub is compared with its other members and leaves it; a bucket where one label is left has
    # no more to find. All pairs of the others are compared, in blocks where a bucket is crowded: every pair of
    # a bucket was compared, is connected or is ruled out.
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))

    def linked(pairs: DataFrame) -> DataFrame:
        return stage(confirmed(pairs.join(left, "a").join(right, "b"), width, similarity_pct))

    links: DataFrame | None = None
    near = _near(similarity_pct, apart, sketched)
    state = stage(_with_hubs(members, near, sketched))
    if not state.isEmpty():
        pairs = state.where("near").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
        tried = stage(pairs.distinct())
        links = linked(tried)
        state = stage(_mixed(stage(_labelled(state.drop("hub", "near"), links))))
        inside, rest = state.where(F.col("n") > CROWD), state.where(F.col("n") <= CROWD)
        if not inside.isEmpty():
            links = links.union(stage(_block_links(inside, texts, width, similarity_pct)))
        if not rest.isEmpty():
            links = links.union(linked(_pairs_within(rest, near, sketched).join(tried, ["a", "b"], "left_anti")))
    roots = None if links is None else components(links)
    classes = heads.select(F.col("d1").alias("c1"), F.col("d2").alias("c2"), F.col("n_shingles").alias("cn"), F.col("node").alias("head"))
    same = (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")) & (F.col("n_shingles") == F.col("cn"))
    placed = rows.select("id", "tk", "row", "n_shingles", "d1", "d2").join(classes, same, "left")
    root: Column = F.col("head")
    if roots is not None:
        placed = placed.join(roots, F.col("head") == F.col("node"), "left")
        root = F.coalesce("root", "head")
    placed = stage(placed.select("id", "tk", "row", "n_shingles", F.coalesce(root, "row").alias("comp")))
    best = stage(placed.groupBy(F.col("comp").alias("g")).agg(F.min(place).alias("best")))
    return placed.join(best, F.col("comp") == F.col("g")).select(
        F.col("id").alias(id_col), "tk", "row", "n_shingles", F.col("best.id").alias("component_id"),
        (F.col("row") == F.col("best.row")).alias("first"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One document of each group, with all its columns: the one of the smallest id. Rows that repeat in
    id and text are reduced to one. Only keys of dropped rows are matched with the documents."""
    found = near_duplicates(docs, id_col, text_col, **settings)
    dropped = stage(
        found.groupBy(F.col(id_col).alias("d_id"), F.col("tk").alias("d_tk"))
        .agg(F.count("*").alias("d_n"), F.max("first").alias("d_first"), F.max("n_shingles").alias("d_size"))
        .where("d_size > 0 and (not d_first or d_n > 1)")
    )
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tk")
    )
    same = F.col("id").eqNullSafe(F.col("d_id")) & (F.col("tk") == F.col("d_tk"))
    once = packed.join(dropped.where("d_first"), same, "left_semi").dropDuplicates(["id", "tk"])
    return packed.join(dropped, same, "left_anti").select("doc").union(once.select("doc")).select("doc.*")
