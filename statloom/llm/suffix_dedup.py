"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Two windows of ``DEPTH`` bytes are equal exactly when the suffixes that start there agree in their first
``DEPTH`` bytes, so suffixes are ordered only that deep, by most-significant-digit passes that split groups
of equal digits and drop every suffix that is alone.

Of all suffixes of a document only sampled ones are sorted: every window chooses the ``DIGIT`` bytes inside
it that have the smallest hash (the leftmost of equal ones). Equal windows choose equal bytes at equal
places, so all windows that share their choice are one item of the first passes:

1. digit of ``DIGIT`` bytes: a bitmap of the digits that occur twice clears most items in the scan itself;
2. all bytes of the item's windows together: items of equal bytes are repeated as a whole;
3. the remaining items, one per distinct content, split into their windows: groups of equal windows.

Digits are compared by 64-bit hashes, each pass inside the group of the pass before.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.hashing import mixed, powers, prefix_hashes, span_hash
from statloom.llm.staging import stage
from statloom.llm.text import text_key

DEPTH = 200
DIGIT = 64
BLOCK_BITS = 32768
BITS_PER_ITEM = 8
#: The bitmap is broadcast up to this size; a larger one is joined by block.
BROADCAST_BYTES = 32 << 20
#: Contents of a digit that one task compares; larger groups are compared by a grouped count instead.
GROUP_ITEMS = 2000


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every ``width`` neighbours, by doubling spans."""
    out, span = values, 1
    while 2 * span <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def items(data: np.ndarray, depth: int, digit: int) -> tuple[np.ndarray, ...]:
    """Items of a document: first window, number of windows, place of the digit in the first window, hash
    of the digit, hash of all bytes of the windows."""
    none = tuple(np.zeros(0, np.int64) for _ in range(3)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    if len(data) < depth:
        return none
    prefix = prefix_hashes(data)
    _, down = powers(len(prefix))
    raw = (prefix[digit:] - prefix[:-digit]) * down[: len(data) - digit + 1]
    h = (raw >> np.uint64(32)).astype(np.uint32)
    width = depth - digit + 1
    low = _sliding(h, width, np.minimum)
    pad = np.zeros(width - 1, np.uint32)
    chosen = np.flatnonzero(_sliding(np.concatenate([pad, low, pad]), width, np.maximum) == h)
    owner = np.searchsorted(chosen, np.arange(len(low)))
    wrong = np.flatnonzero(h[chosen[owner]] != low)
    while len(wrong):
        owner[wrong] += 1
        wrong = wrong[h[chosen[owner[wrong]]] != low[wrong]]
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    count = np.diff(first, append=len(low))
    place = chosen[owner[first]] - first
    content = span_hash(prefix, first, first + count - 1 + depth)
    content = mixed(content + (place * 256 + count).astype(np.uint64))
    return first, count, place, mixed(raw[chosen[owner[first]]]), content


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def suffix_items(docs: DataFrame, id_col: str, text_col: str, depth: int, digit: int) -> DataFrame:
    """Items of every document: k1, k2 (its key), at (first window, place and count), digit, content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                found = [items(_bytes(t.as_py()), depth, digit) for t in part.column(2)]
                owner = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
                start, count, place, d, c = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(owner), part.column(1).take(owner), pa.array(start << 16 | place << 8 | (count - 1)), _long(d), _long(c)],
                    names=["k1", "k2", "at", "digit", "content"],
                )

    text = F.col(text_col)
    keyed = docs.select(F.xxhash64(F.col(id_col)).alias("k1"), text_key(text).alias("k2"), text.cast("string").alias("text"))
    return keyed.mapInArrow(run, "k1 long, k2 long, at long, digit long, content long")


def repeated_digits(found: DataFrame, n_bytes: int, stride: int, broadcast_bytes: int) -> DataFrame:
    """Pass 1: the items whose digit may occur twice. Digits are counted by slot, combined in each task;
    the bitmap of the slots used twice follows the size of the texts, with about one item per
    ``stride`` bytes. A smaller or larger number of items only changes how many unique ones stay."""
    blocks = max(1, -(-n_bytes * BITS_PER_ITEM // (stride * BLOCK_BITS)))
    slot = F.pmod(F.col("digit"), F.lit(blocks * BLOCK_BITS))
    twice = found.select(slot.alias("slot")).groupBy("slot").agg(F.count("*").alias("n")).where("n > 1")
    bitmap = stage(
        twice.groupBy(F.expr(f"slot div {BLOCK_BITS}").alias("block")).agg(F.expr(f"bitmap_construct_agg(slot % {BLOCK_BITS})").alias("bits"))
    )
    if blocks * (BLOCK_BITS // 8 + 64) <= broadcast_bytes:
        bitmap = F.broadcast(bitmap)
    bit = slot % BLOCK_BITS
    byte = F.substring(F.col("bits"), F.lit(1) + F.shiftright(bit, 3).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (bit % 8).cast("int")) == 1
    probed = found.join(bitmap, F.expr(f"pmod(digit, {blocks * BLOCK_BITS}L) div {BLOCK_BITS}") == F.col("block"))
    return probed.where(is_set).select(*found.columns)


def _unpacked(at: Column, depth: int) -> tuple[Column, Column]:
    """Bytes that the windows of an item cover."""
    start = F.shiftright(at, 16)
    return start, start + (at % 256) + F.lit(depth)


def _windows(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    same = (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2"))
    return texts.join(wanted.withColumnsRenamed({"k1": "w1", "k2": "w2"}), same)


def _contents(texts: DataFrame, wanted: DataFrame, depth: int) -> DataFrame:
    """The bytes of the wanted items, cut out of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part, out = batch.slice(first, 256), []
                for z, at in zip(part.column("z"), part.column("at").to_pylist(), strict=True):
                    data = zlib.decompress(z.as_py())
                    out.append([data[a >> 16 : (a >> 16) + a % 256 + depth] for a in at])
                owner = pa.array(np.repeat(np.arange(len(out)), [len(o) for o in out]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("k1").take(owner), part.column("k2").take(owner),
                        part.column("at").flatten(), part.column("digit").flatten(), part.column("alone").flatten(),
                        pa.array([x for o in out for x in o], pa.binary()),
                    ],
                    names=["k1", "k2", "at", "digit", "alone", "content"],
                )

    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "digit", "alone")).alias("w"))
    lists = lists.select("k1", "k2", F.col("w.at").alias("at"), F.col("w.digit").alias("digit"), F.col("w.alone").alias("alone"))
    joined = _windows(texts, lists).select("k1", "k2", "z", "at", "digit", "alone")
    return joined.mapInArrow(run, "k1 long, k2 long, at long, digit long, alone boolean, content binary")


def _split(part: pa.RecordBatch | pa.Table, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of the items of a batch: row of the item, start in its document, hash (with the digit)."""
    at = part.column("at").to_numpy()
    count = at % 256 + 1
    owner = np.repeat(np.arange(len(at)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    size = count + depth - 1
    first = (np.cumsum(size) - size)[owner] + inside
    data = np.frombuffer(b"".join(part.column("content").to_pylist()), np.uint8)
    digit = part.column("digit").to_numpy().view(np.uint64)[owner]
    return owner, (at >> 16)[owner] + inside, mixed(span_hash(prefix_hashes(data), first, first + depth) + mixed(digit))


def _compare_groups(contents: DataFrame, depth: int) -> DataFrame:
    """Pass 3 where the contents of a digit are few: spans of repeated windows.

    Items come sorted by digit; a batch is compared at once, and the items of its last digit wait for
    the next batch.
    """

    def spans(part: pa.Table) -> pa.RecordBatch:
        owner, start, window = _split(part, depth)
        _, which, count = np.unique(window, return_inverse=True, return_counts=True)
        alone = part.column("alone").to_numpy()
        hit = (count[which] > 1) & alone[owner]
        joined = hit[1:] & hit[:-1] & (owner[1:] == owner[:-1])
        begin, end = hit.copy(), hit.copy()
        begin[1:] &= ~joined
        end[:-1] &= ~joined
        rows = pa.array(owner[begin])
        return pa.RecordBatch.from_arrays(
            [
                *(part.column(c).combine_chunks().take(rows) for c in ("k1", "k2")),
                pa.array(start[begin]), pa.array(start[end] + depth),
            ],
            names=["k1", "k2", "start", "stop"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if held is None else pa.concat_tables([held, part])
            digit = part.column("digit").to_numpy()
            whole = int(np.argmax(digit == digit[-1])) if len(digit) else 0
            held = part.slice(whole).combine_chunks()
            if whole:
                yield spans(part.slice(0, whole).combine_chunks())
        if held is not None and held.num_rows:
            yield spans(held)

    placed = contents.repartition("digit").sortWithinPartitions("digit")
    return placed.mapInArrow(run, "k1 long, k2 long, start long, stop long")


def _compare_counts(contents: DataFrame, depth: int) -> DataFrame:
    """Pass 3 for digits of very many contents: windows are rows, counted in each task before the exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                owner, start, window = _split(part, depth)
                rows = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(rows) for c in ("k1", "k2", "digit", "alone")), pa.array(start), _long(window)],
                    names=["k1", "k2", "digit", "alone", "start", "window"],
                )

    rows = contents.mapInArrow(run, "k1 long, k2 long, digit long, alone boolean, start long, window long")
    twice = rows.groupBy(F.col("digit").alias("t1"), F.col("window").alias("t2")).agg(F.count("*").alias("n")).where("n > 1")
    hit = rows.where("alone").join(twice, (F.col("digit") == F.col("t1")) & (F.col("window") == F.col("t2")), "left_semi")
    return hit.select("k1", "k2", "start", (F.col("start") + depth).alias("stop"))


def _cut(joined: DataFrame, id_kind: str, with_bytes: bool) -> DataFrame:
    def cut(z: pa.Scalar, starts: list[int] | None, stops: list[int] | None) -> tuple:
        data = np.frombuffer(zlib.decompress(z.as_py()), np.uint8)
        if not starts:
            return len(data), 0, 0, hashlib.sha256(data).hexdigest(), data.tobytes() if with_bytes else None
        change = np.zeros(len(data) + 1, np.int32)
        np.add.at(change, np.array(starts, np.int64), 1)
        np.add.at(change, np.array(stops, np.int64), -1)
        gone = np.cumsum(change)[:-1] > 0
        kept = data[~gone].tobytes()
        runs = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
        return len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept if with_bytes else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                spans = zip(part.column("start").to_pylist(), part.column("stop").to_pylist(), strict=True)
                rows = [cut(z, a, b) for z, (a, b) in zip(part.column("z"), spans, strict=True)]
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *columns], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
                )

    return joined.select("id", "z", "start", "stop").mapInArrow(
        run, f"id {id_kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def _zipped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents with their key, the text as compressed bytes, placed by key: the one exchange of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                z = [zlib.compress(_bytes(t.as_py()), 1) for t in part.column(3)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(z, pa.binary())], names=["id", "k1", "k2", "z"])

    text = F.col(text_col)
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("k1"), text_key(text).alias("k2"), text.cast("string").alias("text"))
    return keyed.mapInArrow(run, f"id {dict(keyed.dtypes)['id']}, k1 long, k2 long, z binary").repartition("k1", "k2")


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = DEPTH,
    digit: int = DIGIT,
    group_items: int = GROUP_ITEMS,
    broadcast_bytes: int = BROADCAST_BYTES,
    with_bytes: bool = True,
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes, or
    NULL without ``with_bytes``).

    Every byte covered by a window of ``depth`` bytes that starts anywhere else too is removed, judged on
    the input. Texts are UTF-8; NULL counts as empty; shorter texts lose nothing. Repeated rows repeat
    each other. Windows never cross documents. Other columns are not read.
    """
    if not 0 < depth - digit < 255:
        raise ValueError("a window may exceed its digit by 1 to 254 bytes")
    n_bytes = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    found = suffix_items(docs, id_col, text_col, depth, digit)
    found = stage(repeated_digits(found, n_bytes, (depth - digit + 2) // 2, broadcast_bytes))
    mark = F.xxhash64("k1", "k2", "at")
    contents = found.groupBy("digit", "content").agg(F.count("*").alias("n"), F.min(mark).alias("head"))
    contents = stage(contents)
    groups = stage(
        contents.groupBy(F.col("digit").alias("g")).agg(F.count("*").alias("kinds"), F.min("n").alias("least"), F.max("n").alias("most"))
        .where("kinds > 1 and least = 1").select("g", "kinds")
    )
    kinds = contents.join(groups, F.col("digit") == F.col("g"), "left").where("n > 1 or kinds > 1")
    kinds = stage(kinds.select(F.col("digit").alias("g1"), F.col("content").alias("g2"), "n", "head", "kinds"))
    placed = stage(
        found.join(kinds, (F.col("digit") == F.col("g1")) & (F.col("content") == F.col("g2")))
        .withColumn("is_head", F.col("kinds").isNotNull() & (mark == F.col("head")))
        .where("n > 1 or is_head")
        .select("k1", "k2", "at", "digit", "n", "kinds", "is_head")
    )
    texts = _zipped(docs, id_col, text_col)
    wanted = placed.where("is_head").select("k1", "k2", "at", "digit", (F.col("n") == 1).alias("alone"), "kinds")
    small = _contents(texts, wanted.where(F.col("kinds") <= group_items), depth)
    spans = _compare_groups(small, depth)
    large = wanted.where(F.col("kinds") > group_items)
    if not large.isEmpty():
        spans = spans.union(_compare_counts(_contents(texts, large, depth), depth))
    start, stop = _unpacked(F.col("at"), depth)
    whole = placed.where("n > 1").select("k1", "k2", start.alias("start"), stop.alias("stop"))
    lists = whole.union(spans).groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "stop")).alias("s"))
    lists = lists.select(F.col("k1").alias("w1"), F.col("k2").alias("w2"), F.col("s.start").alias("start"), F.col("s.stop").alias("stop"))
    joined = texts.join(lists, (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")), "left")
    kind = dict(docs.select(F.col(id_col).alias("id")).dtypes)["id"]
    return _cut(joined, kind, with_bytes).withColumnRenamed("id", id_col)
