"""Phrases whose words belong together, counted with burstable tries.

A phrase can only be frequent if its words and all its pairs of neighbouring words are: these are counted
first, by hash, and a bitmap of the frequent ones ends every sequence where it cannot go on. The bitmap has a
bounded size and errs only by letting a sequence go on, so no phrase is lost and all counts are exact.

A task then counts the word sequences at every position of its texts in a trie: shallow levels of word ids, with
hash containers below that burst into a further level when they grow. When a trie is full, whole subtrees
are spilled as sorted runs. Spark deals the runs out by ranges of their prefix and merges them in order, so
the counts of all phrases with one beginning meet, and a prefix with very many rows is cut into several
ranges. Scores, containment and ranks are joins and windows over the few frequent phrases.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm.hashing import mixed, prefix_hashes, span_hash
from statloom.llm.staging import stage

LONGEST = 4
LEAST = 30
TOP = 2000
SCALE = 2_000_000
CONTAINED_PCT = 80
UNKNOWN = "und"
#: Sequences in a trie before subtrees are spilled, and those of a container before it bursts.
TRIE_ITEMS = 200_000
BURST_ITEMS = 4096
#: Bits of the bitmap of frequent words and pairs for each of them, and at most (32 MB).
KEY_BITS = 16
MAX_BITS = 1 << 28
#: Bytes of text that enter a trie at once.
TEXT_BYTES = 1 << 19

_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_KIND = np.zeros(256, np.int8)
_KIND[[32, 9]] = 1
_KIND[[*b".,;:!?", *range(10, 14)]] = 2
_ID_BITS = 21


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the joined texts (A-Z as a-z), and of every word its start, stop, text and the number of
    words from it to the end of its piece, ``LONGEST`` at most. Pieces end at ``.,;:!?``, line ends, vertical
    tabs and form feeds; words are parted by blanks and tabs."""
    data = np.frombuffer(b"\n".join(texts).translate(_FOLD), np.uint8)
    kind = _KIND[data]
    edge = np.diff(np.concatenate([[False], kind == 0, [False]]).astype(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.concatenate([[0], np.cumsum(kind == 2)])[start]
    length = np.ones(len(start), np.int64)
    for k in range(1, LONGEST):
        length[: len(start) - k] += piece[k:] == piece[: len(piece) - k]
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    return data, start, stop, np.searchsorted(begin, start, side="right") - 1, length


class Trie:
    """Counts of word sequences per group: the group and first word lead to a container or to a burst node.

    A container maps the other words, packed into one number, to a count; a burst node maps the second word
    to containers of the words after it. Ids of absent words are 0.
    """

    def __init__(self, burst: int = BURST_ITEMS) -> None:
        self.burst = burst
        self.items = 0
        self.root: dict[int, dict] = {}
        self.sizes: dict[int, int] = {}
        self.nodes: set[int] = set()

    def add(self, heads: list[int], rests: list[int], counts: list[int]) -> None:
        """Add sequences; ``heads`` name group and first word, ``rests`` pack the further words."""
        root, nodes, shift = self.root, self.nodes, 2 * _ID_BITS
        for head, rest, count in zip(heads, rests, counts, strict=True):
            table = root.get(head)
            if table is None:
                table = root[head] = {}
                self.sizes[head] = 0
            if head in nodes:
                second = rest >> shift
                inner = table.get(second)
                if inner is None:
                    inner = table[second] = {}
                table = inner
            found = table.get(rest)
            if found is None:
                table[rest] = count
                self.items += 1
                self.sizes[head] += 1
                if len(table) > self.burst and head not in nodes:
                    self._burst(head)
            else:
                table[rest] = found + count

    def _burst(self, head: int) -> None:
        table: dict[int, dict] = {}
        for rest, count in self.root[head].items():
            table.setdefault(rest >> (2 * _ID_BITS), {})[rest] = count
        self.root[head] = table
        self.nodes.add(head)

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Take out whole subtrees, the largest first, until ``keep`` sequences are left: heads, rests, counts."""
        heads: list[int] = []
        sizes: list[int] = []
        rests: list[int] = []
        counts: list[int] = []
        for head in sorted(self.sizes, key=self.sizes.__getitem__, reverse=True):
            if self.items <= keep:
                break
            table = self.root.pop(head)
            for inner in table.values() if head in self.nodes else (table,):
                rests.extend(inner.keys())
                counts.extend(inner.values())
            heads.append(head), sizes.append(self.sizes[head])
            self.items -= self.sizes.pop(head)
            self.nodes.discard(head)
        return np.repeat(np.array(heads, np.int64), sizes), np.array(rests, np.uint64), np.array(counts, np.int64)


class _Words:
    """Word ids of a task by the hash of the word, 1 and up in the order they come."""

    def __init__(self) -> None:
        self.ids: dict[int, int] = {}
        self.texts: list[bytes] = [b""]

    def number(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        if not len(start):
            return np.zeros(0, np.int64)
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        raw, ids = data.tobytes(), self.ids
        out = np.empty(len(unique), np.int64)
        for k, (h, a, b) in enumerate(zip(unique.tolist(), start[first].tolist(), stop[first].tolist(), strict=True)):
            found = ids.get(h)
            if found is None:
                found = ids[h] = len(self.texts)
                self.texts.append(raw[a:b])
            out[k] = found
        return out[inverse]


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list[str], list[bytes]]]:
    """Languages and texts of a batch in groups of about ``TEXT_BYTES``; a longer text is one."""
    langs, texts, total, first = batch.column(0).to_pylist(), [], 0, 0
    for k, text in enumerate(batch.column(1)):
        texts.append((text.as_py() or "").encode("utf-8", "surrogatepass"))
        total += len(texts[-1])
        if total >= TEXT_BYTES or k == len(langs) - 1:
            yield langs[first : k + 1], texts
            texts, total, first = [], 0, k + 1


def _lang_hashes(langs: list[str]) -> np.ndarray:
    seeds = {x: int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest()) for x in set(langs)}
    return np.array([seeds[x] for x in langs], np.uint64)


def _keys(hashes: np.ndarray, length: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words in their language, positions of the words with a successor in their piece, and the
    hashes of these pairs."""
    single, at = mixed(hashes + lang), np.flatnonzero(length > 1)
    return single, at, mixed(single[at] * np.uint64(0xD6E8FEB86659FD93) + hashes[np.minimum(at + 1, len(hashes) - 1)])


def _is_set(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the keys are in a bitmap of blocks of 4096 bytes, whose bits count from the lowest of each byte on."""
    place = keys & np.uint64(len(bitmap) * 8 - 1)
    return ((bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def _given(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    text, lang = F.col(text_col).cast("string"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN))
    return docs.select(lang.alias("lang"), text.alias("text"))


def frequent_keys(docs: DataFrame, text_col: str, lang_col: str, least: int) -> DataFrame:
    """Hashes of the words and of the pairs of neighbouring words that occur ``least`` times or more in a
    language. They are summed per chunk of text before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for langs, texts in _chunks(batch):
                data, start, stop, owner, length = word_spans(texts)
                if not len(start):
                    continue
                hashes = span_hash(prefix_hashes(data), start, stop)
                single, _, pairs = _keys(hashes, length, _lang_hashes(langs)[owner])
                for keys in (single, pairs):
                    unique, count = np.unique(keys, return_counts=True)
                    columns = [pa.array(unique.view(np.int64)), pa.array(count.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "n"])

    counted = _given(docs, text_col, lang_col).mapInArrow(run, "key long, n int")
    return counted.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key")


def bitmap_of(keys: DataFrame, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bitmap of hashes modulo its size, ``max_bits`` at most whatever their number."""
    bits, wanted = 1 << 15, min(max_bits, KEY_BITS * keys.count())
    while bits < wanted:
        bits *= 2
    slots = keys.select(F.pmod("key", F.lit(bits)).alias("slot"))
    blocks = slots.groupBy(F.expr("slot div 32768").alias("block")).agg(F.expr("bitmap_construct_agg(slot % 32768)").alias("bits"))
    out = np.zeros((bits >> 15, 4096), np.uint8)
    for row in blocks.collect():
        out[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


_RUN = "lang string, path string, words int, n long"


def sorted_runs(
    docs: DataFrame, text_col: str, lang_col: str, frequent: np.ndarray, trie_items: int, burst: int
) -> DataFrame:
    """Runs of (lang, path, words, n): the ``words`` words, ``LONGEST`` at most, that follow each other from a
    position on within a piece, as far as they and their pairs are in the bitmap ``frequent``, joined by blanks,
    with the number of such positions that a trie counted. Words that are not in it begin no path: how many
    they are is a row of 0 words."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, words, langs, bitmap = Trie(burst), _Words(), {}, sent.value
        others: Counter = Counter()

        def emit(keep: int) -> Iterator[pa.RecordBatch]:
            head, rest, count = trie.spill(keep)
            names = list(langs)
            # Ids by the order of their words: a run is sorted by language and words.
            vocabulary = pa.array(words.texts, pa.binary())
            order = pc.sort_indices(vocabulary).to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            mask = np.uint64((1 << _ID_BITS) - 1)
            ids = [head & ((1 << _ID_BITS) - 1)]
            ids += [((rest >> np.uint64(k * _ID_BITS)) & mask).astype(np.int64) for k in (2, 1, 0)]
            group = head >> _ID_BITS
            by = np.lexsort([*(place[i] for i in reversed(ids)), group])
            for at in range(0, len(by), 1 << 16):
                some = by[at : at + (1 << 16)]
                parts = [vocabulary.take(pa.array(i[some], mask=i[some] == 0)) for i in ids]
                path = pc.binary_join_element_wise(*parts, b" ", null_handling="skip")
                size = np.sum([i[some] > 0 for i in ids], axis=0).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.string()).take(pa.array(group[some])),
                        path.cast(pa.string()),
                        pa.array(size),
                        pa.array(count[some]),
                    ],
                    names=["lang", "path", "words", "n"],
                )

        for batch in batches:
            for named, texts in _chunks(batch):
                if len(words.texts) + sum(map(len, texts)) > (1 << _ID_BITS) - 8:
                    # Ids may not fit: what was counted so far goes out with the old ones.
                    yield from emit(0)
                    words = _Words()
                data, start, stop, owner, length = word_spans(texts)
                if not len(start):
                    continue
                hashes = span_hash(prefix_hashes(data), start, stop)
                single, at, pairs = _keys(hashes, length, _lang_hashes(named)[owner])
                kept = _is_set(bitmap, single)
                follows = np.zeros(len(start) + LONGEST, bool)
                follows[at] = _is_set(bitmap, pairs)
                word = np.zeros(len(start), np.int64)
                word[kept] = words.number(data, start[kept], stop[kept], hashes[kept])
                if len(words.texts) >= 1 << _ID_BITS:
                    raise ValueError("a single text has more than two million different words")
                rest, goes = np.zeros(len(word), np.uint64), kept.copy()
                for j in range(1, LONGEST):
                    next_ = np.zeros(len(word), np.int64)
                    next_[: len(word) - j] = word[j:]
                    goes &= follows[j - 1 : j - 1 + len(word)] & (next_ > 0)
                    rest |= np.where(goes, next_, 0).astype(np.uint64) << np.uint64((LONGEST - 1 - j) * _ID_BITS)
                group = np.array([langs.setdefault(x, len(langs)) for x in named], np.int64)[owner]
                others.update(dict(enumerate(np.bincount(group[~kept]).tolist())))
                head, rest = ((group << _ID_BITS) | word)[kept], rest[kept]
                by = np.lexsort([rest, head])
                head, rest = head[by], rest[by]
                if not len(head):
                    continue
                new = np.flatnonzero(np.concatenate([[True], (head[1:] != head[:-1]) | (rest[1:] != rest[:-1])]))
                count = np.diff(np.append(new, len(head)))
                for first in range(0, len(new), trie_items):
                    some = new[first : first + trie_items]
                    trie.add(head[some].tolist(), rest[some].tolist(), count[first : first + trie_items].tolist())
                    if trie.items > trie_items:
                        yield from emit(trie_items // 4)
        yield from emit(0)
        names = list(langs)
        columns = [[names[g] for g in others], [None] * len(others), [0] * len(others), list(others.values())]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["lang", "path", "words", "n"])

    return _given(docs, text_col, lang_col).mapInArrow(run, _RUN)


def merged(runs: DataFrame, least: int) -> DataFrame:
    """Phrases (lang, phrase, words, n) that occur ``least`` times or more, of 1 to ``LONGEST`` words.

    Ranges of paths in order: all paths with one beginning follow each other, so a phrase is counted in
    passing, without a table. Phrases inside a range are whole; only those that its first and last row begin
    with may go on in its neighbours and are added up afterwards.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of each length the phrase that is open, its count, and whether the range began with it.
        open_: list[list | None] = [None] * LONGEST
        began = True

        def closed(k: int, last: bool) -> list[tuple]:
            found = open_[k]
            open_[k] = None
            return [(*found[0], k + 1, found[1])] if found and (found[1] >= least or found[2] or last) else []

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "phrase", "words", "n"])

        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            langs, paths = batch.column(0), batch.column(1).cast(pa.binary())
            words, counts = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            offsets = np.frombuffer(paths.buffers()[1], np.int32)[paths.offset : paths.offset + size + 1].astype(np.int64)
            data = np.frombuffer(paths.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            offsets -= offsets[0]
            codes = langs.dictionary_encode()
            number = np.cumsum(np.concatenate([[0], np.diff(codes.indices.to_numpy()) != 0]))
            # Where the k-th word of each path ends: before its k-th blank, or at the end of the path.
            blank = np.flatnonzero(data == 32)
            before = np.searchsorted(blank, offsets[:-1])
            prefix = prefix_hashes(data)
            out: list[tuple] = []
            for k in range(LONGEST):
                rows = np.flatnonzero(words > k)
                if not len(rows):
                    continue
                end = np.where(words > k + 1, blank[np.minimum(before + k, max(len(blank) - 1, 0))] if len(blank) else 0, offsets[1:])[rows]
                hashes = span_hash(prefix, offsets[:-1][rows], end)
                new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (number[rows][1:] != number[rows][:-1])])
                at = np.flatnonzero(new)
                sums = np.add.reduceat(counts[rows], at)
                text = lambda i: data[offsets[rows[i]] : end[i]].tobytes().decode("utf-8", "surrogatepass")
                head = (langs[int(rows[0])].as_py(), text(0))
                if open_[k] is not None and open_[k][0] == head:
                    open_[k][1] += int(sums[0])
                else:
                    out += closed(k, False)
                    open_[k] = [head, int(sums[0]), began]
                if len(at) > 1:
                    out += closed(k, False)
                    for j in (np.flatnonzero(sums[1:-1] >= least) + 1).tolist():
                        out.append((langs[int(rows[at[j]])].as_py(), text(at[j]), k + 1, int(sums[j])))
                    open_[k] = [(langs[int(rows[at[-1]])].as_py(), text(at[-1])), int(sums[-1]), False]
            # Any phrase may have begun before the range as long as its first row is not passed.
            began = False
            yield table(out)
        yield table([r for k in range(LONGEST) for r in closed(k, True)])

    dealt = runs.where("words > 0").repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    pieces = dealt.mapInArrow(run, "lang string, phrase string, words int, n long")
    whole = pieces.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    return whole.where(F.col("n") >= least)


def _cut(words: Column, first: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    contained_pct: int = CONTAINED_PCT,
    top: int = TOP,
    trie_items: int = TRIE_ITEMS,
    burst: int = BURST_ITEMS,
) -> DataFrame:
    """Per language the best ``top`` phrases: lang, rank, phrase, a, l, r, n, score, words, cut.

    a counts the phrase, l and r its parts at the cut of the lowest score, n all words of the language; the
    score is floor(``SCALE`` * a / (l + r)). Phrases inside a longer candidate that is nearly as frequent are
    left out. Every text and every occurrence counts; NULL texts are empty, NULL languages ``und``. Repeated
    rows count each. An empty table gives an empty result. Other columns are not read.
    """
    keys = stage(frequent_keys(docs, text_col, lang_col, least))
    runs = stage(sorted_runs(docs, text_col, lang_col, bitmap_of(keys), trie_items, burst))
    frequent = stage(merged(runs, least))
    totals = runs.groupBy(F.col("lang").alias("t_lang")).agg(F.sum("n").alias("total"))
    candidates = frequent.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    cuts = candidates.select("lang", "phrase", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "words", "a", "k", _cut(F.col("w"), F.lit(1), F.col("k")).alias("left"),
        _cut(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k")).alias("right"),
    )
    part = lambda p: frequent.select(F.col("lang").alias(f"{p}_lang"), F.col("phrase").alias(f"{p}_phrase"), F.col("n").alias(p))
    scored = cuts.join(part("l"), (F.col("lang") == F.col("l_lang")) & (F.col("left") == F.col("l_phrase")))
    scored = scored.join(part("r"), (F.col("lang") == F.col("r_lang")) & (F.col("right") == F.col("r_phrase")))
    score = F.expr(f"(cast({SCALE} as decimal(10,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = (
        scored.withColumn("score", score)
        .groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    )

    longer = candidates.where("words > 2").select(
        "lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")
    )
    longer = longer.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at"))
    inside = longer.groupBy(F.col("lang").alias("i_lang"), _cut(F.col("w"), F.col("at"), F.col("size")).alias("i_phrase")).agg(
        F.max("a").alias("inside")
    )
    kept = best.join(inside, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("i_phrase")), "left").where(
        F.coalesce(100 * F.col("inside").cast("decimal(20,0)") < contained_pct * F.col("a").cast("decimal(20,0)"), F.lit(True))
    )
    in_order = Window.partitionBy("lang").orderBy(F.col("m.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= top)
    return ranked.join(totals, F.col("lang") == F.col("t_lang")).select(
        "lang", F.col("rank").cast("long"), "phrase", "a", F.col("m.l").alias("l"), F.col("m.r").alias("r"),
        F.col("total").alias("n"), F.col("m.score").cast("long").alias("score"), "words", F.col("m.k").alias("cut"),
    )
