"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A document is a bag of sentences. A logistic model over hashed words gives every sentence a probability, and
noisy-or joins them: a document is toxic unless none of its sentences is. The model is trained from the
document labels alone, through the noisy-or, and then says which sentences offend.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.hashing import mixed, prefix_hashes, span_hash
from statloom.llm.staging import stage

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Lengths in characters of the beginnings of words that are features.
PREFIXES = (4, 5, 6, 7)
#: A sentence is pointed out from this probability on.
SENTENCE_THRESHOLD = 0.5

_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LETTER = np.ones(256, bool)
_LETTER[:128] = False
_LETTER[[*range(48, 58), *range(97, 123)]] = True
_END = np.zeros(256, bool)
_END[[10, 13, 33, 46, 63]] = True


@dataclass(frozen=True)
class Settings:
    """``train_docs`` bounds the labelled rows that are learned from, those of the smallest id hashes;
    nothing else depends on the size of the input. ``prior`` is the share of toxic sentences at the start."""

    train_docs: int = 8000
    bits: int = 18
    least_docs: int = 8
    steps: int = 200
    rate: float = 0.1
    decay: float = 1.0
    prior: float = 0.002


@dataclass(frozen=True)
class Bags:
    """Sentences of some texts: the text and the byte span of each, and features with their sentence."""

    text: np.ndarray
    first: np.ndarray
    stop: np.ndarray
    slot: np.ndarray
    owner: np.ndarray


def sentences(texts: list[str | None], bits: int) -> Bags:
    """Sentences and hashed features of texts.

    Words are runs of letters and digits (A-Z as a-z; all bytes beyond ASCII count as letters); features are
    words and beginnings of words of ``PREFIXES`` characters, each once per sentence: a stem offends in all
    its forms. A sentence ends at ``.``, ``!``, ``?`` or a line end; what holds no word is no sentence. Spans
    reach from the first word to the end of the last one, in the text's UTF-8 bytes.
    """
    parts = [(t or "").encode("utf-8", "surrogatepass").translate(_FOLD) for t in texts]
    data = np.frombuffer(b"\n".join(parts), np.uint8)
    begin = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
    edge = np.diff(np.concatenate([[False], _LETTER[data], [False]]).astype(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    none = np.zeros(0, np.int64)
    if not len(start):
        return Bags(none, none, none, none, none)
    ends = np.concatenate([[0], np.cumsum(_END[data])])[start]
    head = np.flatnonzero(np.diff(ends, prepend=-1))
    owner = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(start))))
    prefix = prefix_hashes(data)
    hashes, of = [span_hash(prefix, start, stop)], [owner]
    character = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    at = np.searchsorted(character, start)
    for n in PREFIXES:
        end = character[np.minimum(at + n, len(character) - 1)]
        longer = end < stop
        hashes.append(mixed(span_hash(prefix, start[longer], end[longer]) + np.uint64(n)))
        of.append(owner[longer])
    slot = (np.concatenate(hashes) >> np.uint64(64 - bits)).astype(np.int64)
    once = np.sort((np.concatenate(of).astype(np.int64) << bits) | slot)
    once = once[np.concatenate([[True], once[1:] != once[:-1]])]
    first, last = start[head], stop[np.append(head[1:], len(start)) - 1]
    text = np.searchsorted(begin, first, side="right") - 1
    return Bags(text, first - begin[text], last - begin[text], once & ((1 << bits) - 1), once >> bits)


def batches_of(texts: list[str | None], size: int = 1 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """Texts in groups of about ``size`` characters, with the number of the first; a longer text is one."""
    first, total = 0, 0
    for k, text in enumerate(texts):
        total += len(text or "") + 1
        if total >= size or k == len(texts) - 1:
            yield first, texts[first : k + 1]
            first, total = k + 1, 0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def sentence_scores(bags: Bags, weights: np.ndarray, base: float) -> np.ndarray:
    """Probability of each sentence."""
    return _sigmoid(base + np.bincount(bags.owner, weights=weights[bags.slot], minlength=len(bags.text)))


def noisy_or(p: np.ndarray, text: np.ndarray, count: int) -> np.ndarray:
    """Per text the probability that at least one sentence is toxic; a text without sentences is not."""
    return -np.expm1(np.bincount(text, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=count))


def train(bags: list[tuple[np.ndarray, np.ndarray, int]], labels: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights of the slots and the offset, from bags (slots, owners, sentences) and their labels.

    Gradient of the mean log likelihood through the noisy-or, over all bags at once, with steps by running
    moments of the gradient (Adam). The gradient of a bag's log odds by a sentence's score is the sentence's
    probability over the document's for a toxic bag: sentences that explain the label share it. Features of
    fewer than ``least_docs`` bags are left out, so no document is explained by words of its own, and
    weights decay towards zero. Without bags of both classes nothing is learned.
    """
    weights, base = np.zeros(1 << settings.bits), float(np.log(settings.prior / (1 - settings.prior)))
    if not 0 < labels.sum() < len(labels):
        return weights, base
    seen = np.zeros(len(weights), np.int64)
    for slots, _, _ in bags:
        seen[np.unique(slots)] += 1
    used = np.flatnonzero(seen >= settings.least_docs)
    column = np.full(len(weights), -1, np.int64)
    column[used] = np.arange(len(used))
    counts = np.array([n for _, _, n in bags], np.int64)
    first = np.cumsum(counts) - counts
    slot = column[np.concatenate([s for s, _, _ in bags])]
    owner = np.concatenate([o + f for (_, o, _), f in zip(bags, first, strict=True)])[slot >= 0]
    slot = slot[slot >= 0]
    doc = np.repeat(np.arange(len(bags)), counts)
    toxic = (labels == 1)[doc]
    # Both classes pull equally at the start, up to a bound, whatever their shares.
    heavy = min(4.0, (len(labels) - labels.sum()) / labels.sum())
    w, moment, square = np.zeros(len(used) + 1), np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    w[-1] = base
    for step in range(1, settings.steps + 1):
        p = _sigmoid(w[-1] + np.bincount(owner, weights=w[slot], minlength=len(doc)))
        whole = np.maximum(noisy_or(p, doc, len(bags)), 1e-9)[doc]
        pull = np.where(toxic, heavy * p * (1 - whole) / whole, -p) / len(bags)
        up = np.append(np.bincount(slot, weights=pull[owner], minlength=len(used)), pull.sum())
        up[:-1] -= settings.decay * w[:-1] / len(bags)
        moment = 0.9 * moment + 0.1 * up
        square = 0.999 * square + 0.001 * up * up
        rate = settings.rate * (1 - (step - 1) / settings.steps)
        w += rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    weights[used] = w[:-1]
    return weights, float(w[-1])


def fold(id_: Column) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, settings: Settings) -> tuple[np.ndarray, float]:
    """Model from the labelled rows outside the held-out fold.

    The sample is chosen on ids alone, one label per id (rows whose id has both labels teach nothing). Its
    texts become hashed features where they are read; these meet in one task, bounded by ``train_docs``, and
    only the weights that are not zero come back. Of rows that repeat an id one is learned from.
    """
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (fold(F.col(id_col)) != HELD_OUT))
    one = usable.groupBy(F.col(id_col).alias("l_id")).agg(
        F.min(F.col(label_col).cast("int")).alias("label"), F.max(F.col(label_col).cast("int")).alias("other")
    )
    chosen = stage(
        one.where("label = other").drop("other").orderBy(F.xxhash64("l_id"), "l_id").limit(settings.train_docs)
    )
    slim = docs.select(F.col(id_col).alias("d_id"), F.col(text_col).cast("string").alias("text"))
    rows = slim.join(chosen, F.col("d_id") == F.col("l_id")).select("l_id", "text", "label")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sentences([t.as_py()], settings.bits) for t in batch.column(1)]
            columns = [
                batch.column(0),
                batch.column(2),
                pa.array([f.slot.tolist() for f in found], pa.list_(pa.int64())),
                pa.array([f.owner.tolist() for f in found], pa.list_(pa.int64())),
                pa.array([len(f.text) for f in found], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["l_id", "label", "slots", "owner", "n"])

    kind = dict(chosen.dtypes)["l_id"]
    made = rows.mapInArrow(bags, f"l_id {kind}, label int, slots array<long>, owner array<long>, n long")
    # Repeated ids are brought to one row before anything meets in one task.
    single = made.groupBy("l_id").agg(F.min(F.struct("n", "slots", "owner", "label")).alias("bag"))
    sample = single.select(F.lit(0).alias("g"), "l_id", "bag.label", "bag.slots", "bag.owner", "bag.n")

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by("l_id")
        columns = [table.column(c).combine_chunks() for c in ("slots", "owner")]
        each = zip(*columns, table.column("n").to_pylist(), strict=True)
        given = [(s.values.to_numpy(), o.values.to_numpy(), n) for s, o, n in each]
        weights, base = train(given, table.column("label").to_numpy(), settings)
        used = np.flatnonzero(weights)
        return pa.table({"slot": [used.tolist()], "weight": [weights[used].tolist()], "base": [base]})

    model = sample.groupBy("g").applyInArrow(learn, "slot array<long>, weight array<double>, base double").collect()
    weights, base = np.zeros(1 << settings.bits), float(np.log(settings.prior / (1 - settings.prior)))
    if model:
        weights[np.array(model[0]["slot"], np.int64)], base = model[0]["weight"], model[0]["base"]
    return weights, base


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    settings: Settings = Settings(),  # noqa: B008
) -> DataFrame:
    """One row per document: id, held_out, score, predicted, n_sentences, offending.

    ``offending`` lists the sentences whose own probability reaches ``SENTENCE_THRESHOLD`` with it and their
    byte spans (first byte, byte after the last) in the text. Only the text enters a score. NULL and empty
    texts and those without a word have no sentence and score 0. NULL ids are not held out; repeated rows get
    equal results; without labels of both classes every sentence has the prior. An empty table gives an empty
    result. Other columns are not read.
    """
    weights, base = fit(docs, labels, id_col, text_col, label_col, settings)
    weights = weights.astype(np.float32)
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    bits = settings.bits
    span = pa.struct([("first", pa.int64()), ("stop", pa.int64()), ("probability", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value.astype(np.float64)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            scores, counts = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            found: list[list[tuple]] = [[] for _ in texts]
            for at, some in batches_of(texts):
                bags = sentences(some, bits)
                p = sentence_scores(bags, table, base)
                scores[at : at + len(some)] = noisy_or(p, bags.text, len(some))
                counts[at : at + len(some)] = np.bincount(bags.text, minlength=len(some))
                for k in np.flatnonzero(p >= SENTENCE_THRESHOLD).tolist():
                    found[at + int(bags.text[k])].append((int(bags.first[k]), int(bags.stop[k]), float(p[k])))
            columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.list_(span))], names=["id", "score", "n_sentences", "offending"]
            )

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = (
        f"id {dict(slim.dtypes)['id']}, score double, n_sentences long, "
        "offending array<struct<first: long, stop: long, probability: double>>"
    )
    return slim.mapInArrow(run, schema).select(
        F.col("id").alias(id_col), (fold(F.col("id")) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_sentences", "offending",
    )
