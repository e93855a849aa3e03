"""Quality classifier with supervised subword embeddings.

Words and character n-grams are hashed to learned vectors; a document is their average, and a softmax
layer gives the class. Vectors and layer are trained together by stochastic gradient descent in numpy, on
a bounded sample of labelled rows. Scoring is linear in the features: the two-class layer turns every
vector into one number, so a task needs one table of numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.hashing import prefix_hashes, span_hash
from statloom.llm.staging import stage

FOLDS, HELD_OUT = 3, 1
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


@dataclass(frozen=True)
class Settings:
    """``train_docs`` bounds the labelled rows that are learned from (those of the smallest id hashes);
    everything else does not depend on the size of the input."""

    train_docs: int = 4000
    bits: int = 16
    dim: int = 8
    grams: tuple[int, ...] = (3, 4)
    epochs: int = 6
    rate: float = 0.5
    seed: int = 7


def features(text: str | None, settings: Settings) -> np.ndarray:
    """Hash slots of the words of a text and of the byte n-grams inside them or at their edges (a run of
    white space is one blank there); repeats count again. A word bigram of one word twice is slot 0."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    blank = _BLANK[data]
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.zeros(0, np.int64)
    shift = np.uint64(64 - settings.bits)
    word = span_hash(prefix_hashes(data), start, stop)
    again = np.zeros(int((word[1:] == word[:-1]).sum()), np.int64)
    out = [(word >> shift).astype(np.int64), again]
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    flat, white = np.where(blank, np.uint8(32), data)[keep].astype(np.uint32), blank[keep]
    flat, white = np.concatenate([[np.uint32(32)], flat]), np.concatenate([[True], white])
    for n in settings.grams:
        if len(flat) < n:
            continue
        size = len(flat) - n + 1
        code = np.full(size, n, np.uint32)
        inner = np.zeros(size, bool)
        for k in range(n):
            code = code * np.uint32(0x01000193) ^ flat[k : k + size]
            if 0 < k < n - 1:
                inner |= white[k : k + size]
        code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        out.append((code[~inner] >> np.uint32(32 - settings.bits)).astype(np.int64))
    return np.concatenate(out)


def train(texts: list[str], labels: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Log odds of class 1 that each slot adds (to be averaged), and the offset.

    Without rows of both classes nothing is learned: all scores follow the share of class 1.
    """
    slots = 1 << settings.bits
    ones = float((labels == 1).sum())
    prior = float(np.log((ones + 0.5) / (len(labels) - ones + 0.5)))
    if not 0 < ones < len(labels):
        return np.zeros(slots), prior
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1 / settings.dim, 1 / settings.dim, (slots, settings.dim))
    layer, offset = np.zeros((2, settings.dim)), np.array([0.0, prior])
    docs = []
    for t in texts:
        slot, count = np.unique(features(t, settings), return_counts=True)
        docs.append((slot, count / max(1, count.sum())))
    steps, done = settings.epochs * len(docs), 0
    for _ in range(settings.epochs):
        for i in rng.permutation(len(docs)):
            rate = settings.rate * (1 - done / steps)
            done += 1
            slot, share = docs[i]
            mean = share @ vectors[slot]
            odds = layer @ mean + offset
            p = np.exp(odds - odds.max())
            error = -p / p.sum()
            error[int(labels[i])] += 1
            back = error @ layer
            layer += rate * np.outer(error, mean)
            offset += 0.01 * rate * error
            # The squared length of the shares makes one step move the document's mean, however long it is.
            vectors[slot] += rate * np.outer(share / (share @ share + 1e-9), back) if len(slot) else 0
    gain = layer[1] - layer[0]
    return vectors @ gain, float(offset[1] - offset[0])


def fold(id_: Column) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, settings: Settings) -> tuple[np.ndarray, float]:
    """Model from the labelled rows outside the held-out fold. The sample is chosen on ids alone; its
    texts meet in one task, bounded by ``train_docs``, and only the table of numbers comes back."""
    ids = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (fold(F.col(id_col)) != HELD_OUT))
    chosen = ids.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("label"))
    chosen = stage(chosen.orderBy(F.xxhash64("l_id"), "l_id", "label").limit(settings.train_docs))
    sample = docs.join(chosen, F.col(id_col) == F.col("l_id")).select(
        F.lit(0).alias("g"), "l_id", F.col(text_col).cast("string").alias("text"), "label"
    )

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("l_id", "ascending"), ("label", "ascending"), ("text", "ascending")])
        table = table.slice(0, 2 * settings.train_docs)
        odds, offset = train(table.column("text").to_pylist(), table.column("label").to_numpy(), settings)
        return pa.table({"odds": pa.array([odds.tolist()], pa.list_(pa.float64())), "base": [offset]})

    model = sample.groupBy("g").applyInArrow(learn, "odds array<double>, base double").collect()
    if not model:
        return np.zeros(1 << settings.bits), 0.0
    return np.array(model[0]["odds"]), model[0]["base"]


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    settings: Settings = Settings(),  # noqa: B008
) -> DataFrame:
    """One row per document: id, held_out, score (0 to 1, higher: class 1 likelier), predicted.

    Only the text enters a score. NULL and blank texts get the offset alone. NULL ids are not held out.
    Repeated rows get equal scores; without labels every score is 0.5.
    """
    odds, base = fit(docs, labels, id_col, text_col, label_col, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.full(batch.num_rows, base)
            for k, text in enumerate(batch.column(1)):
                slots = features(text.as_py(), settings)
                if len(slots):
                    total[k] += odds[slots].mean()
            p = 1 / (1 + np.exp(-np.clip(total, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=["id", "score"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = slim.mapInArrow(run, f"id {dict(slim.dtypes)['id']}, score double")
    return scored.select(
        F.col("id").alias(id_col), (fold(F.col("id")) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
