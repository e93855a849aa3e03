"""Best-fit packing of tokenised documents, certified by lower bounds.

Pieces are dealt at random to partitions of a bounded number of pieces, and each partition is packed
best-fit decreasing. Dual feasible functions give a lower bound of its bins: a partition that meets its
bound is optimal and stays. Partitions with a gap put the pieces of their unfilled bins together, deal
them anew and pack again; a round counts only if it needs fewer bins.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.staging import stage

CAPACITY = 4096
END_ID = 1
#: Pieces of a partition; its arrays stay at a few megabytes whatever the input.
PART_PIECES = 50_000
ROUNDS = 3
#: Words whose ids a Python worker remembers before it starts again.
KNOWN_WORDS = 1_000_000
#: New words that are encoded as one text; where one word ends is seen from the tokens.
JOINED_WORDS = 500
#: Bytes of text that are encoded at once; a longer text is encoded alone.
BATCH_BYTES = 1 << 22


#: Letters, then ASCII marks but for the apostrophe: the tokenizer cuts such a word in two at most.
_PLAIN = re.compile(r"([^\W\d_]*)([!-&(-/:-@\[-`{-~]*)")


def _pieces(word: str) -> int:
    """Into how many parts, each ending a word, the tokenizer cuts a plain word; 0 for other words."""
    if word.isascii() and word.isalpha():
        return 1
    found = _PLAIN.fullmatch(word)
    if not found:
        return 0
    letters, marks = found.groups()
    if letters and not (letters.lower().isalpha() and unicodedata.is_normalized("NFC", letters)):
        return 0
    return bool(letters) + bool(marks)


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of the spans ``[start, start + size)`` one after the other."""
    stop = np.cumsum(size)
    return np.arange(stop[-1] if len(stop) else 0) + np.repeat(start - stop + size, size)


def _text_ends(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of texts that follow each other, and the position before the first and after every text."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def _words(data: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of texts, without the blank or line feed that ends them, and how many there are up to the end of
    every text."""
    blank = (data == 32) | (data == 10)
    last = blank.copy()
    last[ends[1:][np.diff(ends) > 0] - 1] = True
    stop = np.flatnonzero(last)
    upto = np.searchsorted(stop, ends[1:])
    offsets = np.concatenate([[0], stop + 1 - np.cumsum(blank[stop])])
    return pa.LargeStringArray.from_buffers(len(stop), pa.py_buffer(offsets), pa.py_buffer(data[~blank])), upto


class Encoder:
    """Token ids of texts. The tokenizer drops white space and looks at nothing across it, so a text's
    ids are those of its words one after the other; Arrow numbers the words of many texts at once, and
    ids of words met before are looked up."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[v for k, v in vocabulary.items() if k.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _learn(self, words: pa.Array) -> None:
        new = words.to_pylist()
        parts = np.array([_pieces(w) for w in new], np.int64)
        length, found = np.zeros(len(new), np.int64), []
        easy, hard = np.flatnonzero(parts), [np.flatnonzero(parts == 0)]
        for first in range(0, len(easy), JOINED_WORDS):
            some = easy[first : first + JOINED_WORDS]
            text = " ".join([new[k] for k in some.tolist()])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            last = np.cumsum(parts[some])
            if len(ends) != last[-1]:
                hard.append(some)
                continue
            length[some] = np.diff(ends[last - 1], prepend=0)
            found.append((some, ids))
        rest = np.concatenate(hard)
        single = [e.ids for e in self.tokenizer.encode_batch_fast([new[k] for k in rest.tolist()], add_special_tokens=False)]
        length[rest] = [len(i) for i in single]
        found.append((rest, np.array([x for i in single for x in i], np.uint32)))
        stop = np.cumsum(length)
        flat = np.empty(stop[-1] if len(stop) else 0, np.uint32)
        for which, ids in found:
            flat[_ragged(stop[which] - length[which], length[which])] = ids
        last = self.ends[-1] if len(self.ends) else 0
        self.ends = np.concatenate([self.ends, last + stop])
        self.ids = np.concatenate([self.ids, flat])
        self.words = pa.concat_arrays([self.words, words])

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, and how many there are up to the end of every text."""
        if len(self.words) > KNOWN_WORDS:
            self._forget()
        words, upto = _words(data, ends)
        coded = words.dictionary_encode()
        place = pc.index_in(coded.dictionary, value_set=self.words)
        new = place.is_null()
        numbers = place.fill_null(0).to_numpy().astype(np.int64)
        if place.null_count:
            numbers[new.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(place.null_count)
            self._learn(coded.dictionary.filter(new))
        stop = self.ends[numbers]
        start = np.where(numbers > 0, self.ends[numbers - 1], 0)
        which = coded.indices.to_numpy()
        size = (stop - start)[which]
        return self.ids[_ragged(start[which], size)], np.concatenate([[0], np.cumsum(size)])[upto]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One encoder per Python worker, kept from task to task."""
    return Encoder(path)


def token_pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Per piece of a document: id, doc_row, piece, start, length, ids, ids_crc32. All pieces of one input
    row, and no others, share ``doc_row``. NULL counts as empty: one piece that holds the end id alone.
    Texts are encoded whole; only documents over ``capacity`` ids are cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            texts = batch.column(2).fill_null("")
            data, ends = _text_ends(texts)
            first = 0
            while first < len(texts):
                after = max(first + 1, int(np.searchsorted(ends, ends[first] + BATCH_BYTES, side="right")) - 1)
                ids, upto = encoder.encode(data[ends[first] : ends[after]], ends[first : after + 1] - ends[first])
                ids = np.insert(ids, upto, end_id).astype("<u4", copy=False)
                tokens = np.diff(upto, prepend=0) + 1
                pieces = -(-tokens // capacity)
                owner = np.repeat(np.arange(len(tokens)), pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                length = np.minimum(capacity, tokens[owner] - piece * capacity)
                cuts = np.concatenate([[0], np.cumsum(length)])
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                rows = pa.array(first + owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(piece.astype(np.int32)),
                        pa.array(piece * capacity),
                        pa.array(length),
                        pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.view("<i4"))),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["id", "doc_row", "piece", "start", "length", "ids", "ids_crc32"],
                )
                first = after

    slim = docs.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("doc_row"), F.col(text_col).cast("string").alias("text")
    )
    kind = dict(slim.dtypes)["id"]
    return slim.mapInArrow(run, f"id {kind}, doc_row long, piece int, start long, length long, ids array<int>, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int, steps: int = 24) -> int:
    """Bins that any packing needs: the largest bound of two families of dual feasible functions (the
    plain sum is among them), in whole numbers."""
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    number, volume = np.cumsum(count), np.cumsum(count * size)
    # Threshold e: what exceeds capacity - e fills a bin, what is below e counts nothing.
    e = np.arange(capacity // 2 + 1)
    large = number[-1] - number[capacity - e]
    middle = volume[capacity - e] - np.where(e > 0, volume[e - 1], 0)
    best = int(np.max(large + -(-middle // capacity)))
    for k in range(1, steps):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int(np.dot(count, value)) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every item, and the number of bins. A bit set of the free sizes in use finds
    the tightest bin that still holds an item."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    with_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, total = 0, 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        fitting = used >> need
        if fitting:
            free = need + (fitting & -fitting).bit_length() - 1
            b = with_free[free].pop()
            if not with_free[free]:
                used ^= 1 << free
        else:
            free, b = capacity, total
            total += 1
        bins[item], offsets[item] = b, capacity - free
        rest = free - need
        if rest:
            with_free[rest].append(b)
            used |= 1 << rest
    return bins, offsets, total


_PACKED = ["sequence_id", "offset", "fill", "gap"]


def _pack_parts(pieces: DataFrame, parts: int, round_no: int, capacity: int) -> DataFrame:
    """Pack every partition on its own: sequence, offset, fill of the sequence, gap of the partition."""

    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        bins, offsets, total = best_fit_decreasing(lengths, capacity)
        gap = total - lower_bound(lengths, capacity)
        first = (round_no << 56) + (table.column("part")[0].as_py() << 24)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)[bins]
        columns = [first + bins, offsets, fill, np.full(len(bins), gap, np.int64)]
        for name, column in zip(_PACKED, columns, strict=True):
            table = table.append_column(name, pa.array(column, pa.int64()))
        return table.drop_columns(["part"])

    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("row", F.lit(round_no)), F.lit(parts)).cast("long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("part").applyInArrow(pack, schema + "".join(f", {c} long" for c in _PACKED))


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    part_pieces: int = PART_PIECES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Per piece: id, doc_row, piece, start, length, ids, ids_crc32, sequence_id, offset.

    A sequence holds at most ``capacity`` tokens, gapless from offset 0: the ids of its pieces, in the
    order of their offsets. Repeated rows are packed each on its own and differ in ``doc_row``. NULL texts
    are empty documents of one token; an empty table gives no sequences. Other columns are not read.

    Ids are written once; packing and its further rounds move row numbers and lengths only, and the places
    are joined to the ids at the end.
    """
    pieces = stage(
        token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id).withColumn("row", F.monotonically_increasing_id())
    )
    parts = max(1, -(-pieces.count() // part_pieces))
    done, names = [], ["row", "length"]
    current = stage(_pack_parts(pieces.select(*names), parts, 0, capacity))
    for round_no in range(1, rounds + 1):
        loose = current.where((F.col("gap") > 0) & (F.col("fill") < capacity))
        before = loose.agg(F.count("*").alias("n"), F.countDistinct("sequence_id").alias("bins")).first()
        if not before["n"]:
            break
        again = stage(_pack_parts(loose.select(*names), max(1, -(-before["n"] // part_pieces)), round_no, capacity))
        if again.agg(F.countDistinct("sequence_id")).first()[0] >= before["bins"]:
            break
        done.append(current.where((F.col("gap") == 0) | (F.col("fill") == capacity)))
        current = again
    for closed in done:
        current = current.union(closed)
    places = current.select("row", "sequence_id", "offset")
    return pieces.join(places, "row").select(
        F.col("id").alias(id_col), "doc_row", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset"
    )


def digests(packed: DataFrame) -> DataFrame:
    """Packed pieces with ``ids_crc32`` computed from the ids that they hold, in place of these."""
    kept = [f for f in packed.schema if f.name not in ("ids", "ids_crc32")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat, ends = ids.values.to_numpy().astype("<u4", copy=False), ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(crc, pa.int64())], names=[*(f.name for f in kept), "ids_crc32"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return packed.drop("ids_crc32").mapInArrow(run, f"{schema}, ids_crc32 long")
