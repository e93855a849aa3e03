"""Toxicity, collocations and hard negatives against plain Python on small tables."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.llm import collocations, hard_negatives, toxicity

ODD = [None, "", "  \t", "...", "a", "b" * 50_000, "x\u00e9 \U0001f600 \ud7ff. y"]


# --- toxicity -------------------------------------------------------------------------


def _labelled(n=300):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(60)]
    docs, labels = [], []
    for i in range(n):
        lines = [[rng.choice(words) for _ in range(6)] for _ in range(4)]
        toxic = i % 3 == 0
        if toxic:
            lines[rng.randrange(4)][rng.randrange(6)] = "Vile"
        docs.append((i, ". ".join(" ".join(x) for x in lines)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxic_sentences_are_found_from_document_labels(spark):
    docs, labels = _labelled()
    odd = [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "Vile thing"), (1, docs[1][1])]
    table = spark.createDataFrame([(i, t, 0.5, "x") for i, t in docs + odd], "doc_id long, text string, score double, l_id string")
    marks = spark.createDataFrame([*labels, (None, 1), (7, 1), (5000, None)], "doc_id long, toxic int")
    out = toxicity.score(table, marks).collect()
    assert len(out) == len(docs) + len(odd)
    truth, text = dict(labels), dict(docs + odd)
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth and r["doc_id"] != 7]
    assert len(held) > 40 and all(r["predicted"] == truth[r["doc_id"]] for r in held)
    for r in out:
        for s in r["offending"]:
            assert "vile" in text[r["doc_id"]].encode()[s["first"] : s["stop"]].decode().lower()
    assert sum(len(r["offending"]) for r in held) == sum(truth[r["doc_id"]] for r in held)
    by_id = {r["doc_id"]: r for r in out}
    assert all(by_id[1000 + i]["score"] == 0 and by_id[1000 + i]["n_sentences"] == 0 for i in range(4))
    assert not by_id[None]["held_out"] and by_id[None]["predicted"] == 1
    same = [r["score"] for r in out if r["doc_id"] == 1]
    assert len(same) == 2 and same[0] == same[1]


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b. c"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["doc_id"]: r["score"] < 0.01 for r in toxicity.score(docs, none).collect()} == {1: True, 2: True}
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.score(docs.limit(0), one).count() == 0


def test_gradient_follows_the_noisy_or():
    """Analytic steps of the log likelihood against differences of it."""
    bags = toxicity.sentences(["ab cd. ef", "gh"], 10)
    w = np.linspace(-1, 1, 1 << 10)

    def p(base):
        return toxicity.noisy_or(toxicity.sentence_scores(bags, w, base), bags.text, 2)

    s, e = toxicity.sentence_scores(bags, w, 0.3), 1e-6
    up = (np.log(p(0.3 + e)) - np.log(p(0.3 - e))) / (2 * e)
    want = np.bincount(bags.text, weights=s * ((1 - p(0.3)) / p(0.3))[bags.text], minlength=2)
    assert np.allclose(up, want, rtol=1e-4)
    assert list(bags.text) == [0, 0, 1] and list(zip(bags.first, bags.stop, strict=True)) == [(0, 5), (7, 9), (0, 2)]


# --- collocations ---------------------------------------------------------------------


def _brute(rows, least, pct, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in cand.items():
            inside = any(
                len(q) > len(p) and 100 * b >= pct * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in cand.items()
            )
            if inside:
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("items, burst", [(200_000, 4096), (60, 5)])
def test_collocations_against_counting(spark, items, burst):
    """With a small trie every container bursts and subtrees are spilled all the time."""
    rng = random.Random(11)
    words = ["Of", "the", "\u00e9t\u00e9", "x\x01y", "na\U0001f600", "Z", "q-q"]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ", "]) for _ in range(rng.randrange(40)))
        rows.append((rng.choice(["en", "fr", None, ""]), text))
    rows += [("en", "hot pair " * 500), ("en", t)] if (t := "hot pair") else []
    rows += [(None, t) for t in ODD] + rows[:20]
    table = spark.createDataFrame([(a, b, 1, "p") for a, b in rows], "lang string, text string, n int, phrase string").repartition(5)
    for top in (2000, 7):
        got = collocations.collocations(table, least=6, top=top, trie_items=items, burst=burst)
        got = got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
        assert sorted(map(tuple, got)) == _brute(rows, 6, 80, top)


def test_ranges_with_very_many_partitions_count_whole(spark):
    """Phrases that go on in the next range are added up."""
    runs = spark.createDataFrame(
        [("en", f"a b c{i % 7} d{i % 3}", 4, 1) for i in range(500)] + [("en", "a", 1, 5), ("fr", "a b", 2, 9)],
        "lang string, path string, words int, n long",
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["lang"], r["phrase"]): r["n"] for r in collocations.merged(runs, 9).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got["en", "a"] == 505 and got["en", "a b"] == 500 and got["fr", "a"] == got["fr", "a b"] == 9
    assert {p: n for (_, p), n in got.items() if p.count(" ") == 2} == {f"a b c{i}": 72 if i < 3 else 71 for i in range(7)}
    assert sum(n for (_, p), n in got.items() if p.count(" ") == 3) == 500


def test_collocations_of_nothing(spark):
    table = spark.createDataFrame([(None, None)], "lang string, text string")
    assert collocations.collocations(table).count() == 0
    assert collocations.collocations(table.limit(0)).count() == 0


# --- hard negatives -------------------------------------------------------------------


def _brute_negatives(rows, every):
    score = lambda a, b: int(sum(x * y for x, y in zip(a, b)))  # noqa: E731, B905
    out = []
    for i, label, v in rows:
        if i % every:
            continue
        found = sorted((-score(v, w), j) for j, m, w in rows if m == label and j != i)[:5]
        for s, j in found:
            near = sorted((-score(v, w), k) for k, m, w in rows if m != label)
            near = [(t, k) for t, k in near if 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(i, j, n, k, -s, -t) for n, (t, k) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["clusters", "copies", "huge"])
def test_hard_negatives_against_all_pairs(spark, kind):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(400):
        v = centres[i % 6] + 0.3 * rng.normal(size=8)
        if kind == "copies" and i % 3 == 0:
            v = centres[0]
        rows.append((i, int(rng.integers(0, 4)), (v * (1e6 if kind == "huge" else 1)).tolist()))
    whole = [(i, m, [int(np.floor(256 * x)) for x in v]) for i, m, v in rows]
    bad = [(None, 1, [0.1] * 8), (1000, None, [0.1] * 8), (1050, 1, None), (1100, 1, [float("nan")] * 8), (1150, 2, [0.1, None]), (1200, 2, [float("inf")])]
    if kind == "clusters":
        bad += [rows[40], rows[41]]  # repeated rows count once
        short = (2000, 1, [0.5, 0.25])
        whole.append((2000, 1, [128, 64] + [0] * 6))
        bad.append(short)
    table = spark.createDataFrame([(*r, "x", 0) for r in rows + bad], "vec_id long, label int, embedding array<double>, id string, score int")
    out = hard_negatives.mine(table, F.col("id") % 20 == 0, chunk_rows=64, sample_rows=300)
    assert sorted(map(tuple, out.collect())) == _brute_negatives(whole, 20)


def test_ranges_rule_out_leaves_but_no_partner():
    rng = np.random.default_rng(4)
    x = np.floor(256 * (rng.normal(size=(20, 8))[rng.integers(0, 20, 3000)] + 0.05 * rng.normal(size=(3000, 8))))
    root, leaves, _ = hard_negatives.build(x[:1000])
    ranges = {}
    for node, point, child, lo, hi in hard_negatives._ranges(root, x):
        a, b = ranges.get((node, point, child), (lo, hi))
        ranges[node, point, child] = (min(a, lo), max(b, hi))
    at, q = hard_negatives._leaves(root, x), x[:40]
    best = np.sort(q @ x.T, axis=1)
    low, high = best[:, -20], 0.95 * best[:, -1]
    alive = hard_negatives.survivors(root, leaves, ranges, q, low, high)
    inside = (q @ x.T >= low[:, None]) & (q @ x.T <= high[:, None])
    for r in range(len(q)):
        assert alive[r, np.unique(at[inside[r]])].all()
    assert alive.mean() < 0.6


def test_hard_negatives_of_nothing(spark):
    table = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(table, F.col("id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(50, 1, [])], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(one, F.col("id") % 50 == 0).count() == 0


def test_hard_negatives_leave_vectors_where_they_are(spark, monkeypatch):
    plans, stage = [], hard_negatives.stage

    def recorded(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df)

    monkeypatch.setattr(hard_negatives, "stage", recorded)
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", 8 * 8, raising=False)  # blocks of about eight anchors
    monkeypatch.setattr(hard_negatives, "TASK_VALUES", 8 * 3, raising=False)
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 3)), (rng.normal(size=8) / 3).tolist()) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    out = hard_negatives.mine(table, F.col("id") % 20 == 0, sample_rows=200)
    whole = [(i, m, [int(np.floor(256 * x)) for x in v]) for i, m, v in rows]
    assert sorted(map(tuple, out.collect())) == _brute_negatives(whole, 20)
    assert len(plans) > 3 and not any("Join" in p or ("Exchange" in p and "data#" in p) for p in plans)


@pytest.mark.parametrize("few", [0, 16])
def test_windows_of_a_query_share_its_scores(monkeypatch, few):
    rng = np.random.default_rng(6)
    for name, n in (("HITS", 500), ("TILE_ROWS", 32), ("TILE_QUERIES", 8), ("FEW_LABELS", few)):
        monkeypatch.setattr(hard_negatives, name, n)
    x = rng.integers(-4, 5, (600, 4)).astype(np.int16)
    ids, labels = rng.integers(0, 300, 600), rng.integers(0, 3, 600)  # ties, and ids that come twice
    block = hard_negatives.Block(np.arange(40), np.sort(rng.integers(0, 3, 40)), rng.integers(-4, 5, (40, 4)).astype(np.int16), np.zeros(40, int))
    alive = rng.random((40, 2)) < 0.8
    lo, hi = rng.integers(-20, 10, (40, 3)), rng.integers(0, 30, (40, 3))
    cells, tile = [], hard_negatives._Search._tile
    monkeypatch.setattr(hard_negatives._Search, "_tile", lambda self, score, *rest: (cells.append(score.size), tile(self, score, *rest)))
    for same in (True, False):
        cells.clear()
        search = hard_negatives._Search(block, lo.copy(), hi, np.packbits(alive.T, axis=1), 3, same)
        for i in range(0, 600, 100):
            part = i + np.argsort(labels[i : i + 100], kind="stable")
            search.look(i // 100 % 2, ids[part], labels[part], x[part])
        found = search.result()
        at, window, place = hard_negatives.best(*found, lo, hi, 3)
        got = sorted(zip(found[0][at], window, place, found[1][at], found[2][at], strict=True))
        want = []
        for q, w in np.ndindex(40, 3):
            near = {}
            for r in range(600):
                score = int(block.vectors[q].astype(int) @ x[r].astype(int))
                if alive[q, r // 100 % 2] and (labels[r] == block.labels[q]) == same and ids[r] != q and lo[q, w] <= score <= hi[q, w]:
                    near[ids[r]] = max(score, near.get(ids[r], score))
            want += [(q, w, n, -s, i) for n, (s, i) in enumerate(sorted((-s, i) for i, s in near.items())[:3])]
        assert got == sorted(want)
        pairs = np.array([alive[:, r // 100 % 2] & ((labels[r] == block.labels) == same) for r in range(600)]).sum()
        assert sum(cells) == (alive.sum() * 300 if not same and not few else pairs)


def test_chunks_keep_enough_of_equal_rows():
    rng = np.random.default_rng(7)
    ids, labels, leaf = rng.integers(0, 60, 500), rng.integers(0, 2, 500), rng.integers(0, 2, 500)
    x = rng.integers(0, 2, (500, 2)).astype(np.int16)
    held = [tuple(c[i : i + 100] for c in (leaf, ids, labels, (x[:, 0] // 2).astype(np.uint64), x)) for i in range(0, 500, 100)]  # digests that collide
    got = []
    for n, first, chunk, label, data in hard_negatives._chunks(held, 7, 4):
        assert len(chunk) <= 7 and (np.diff(label) >= 0).all()
        got += [(n, first, m, tuple(v), i) for i, m, v in zip(chunk, label, hard_negatives._wide(data, len(chunk), 2).tolist(), strict=True)]
    first = {i: f for n, f, m, v, i in got}
    every = {}
    for n, m, v, i in zip(leaf, labels, x.tolist(), ids, strict=True):
        every.setdefault((n, m, tuple(v)), set()).add(i)
    for (n, m, v), all_ids in every.items():
        kept = {i for a, f, b, w, i in got if (a, b, w) == (n, m, v)}
        assert kept <= all_ids and sorted(all_ids)[:4] == sorted(kept)[:4]
    assert all(f == first[i] for n, f, m, v, i in got)
