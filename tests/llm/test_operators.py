"""Operators against plain Python, with NULLs, empty and long texts, ties, repeated rows and odd columns."""

from __future__ import annotations

import random

import numpy as np
import pytest

from statloom.llm import exact_dedup, license_scan, minhash, mixing, packing, quality_rules, suffix_dedup
from statloom.llm.components import components
from tests.llm import brute

SCHEMA = "doc_id long, text string, source string, id string, tk long, doc string, sha string, __id long, bits int"


def table(spark, rows):
    """Rows (doc_id, text, source) with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, s, "x", 1, None, "y", 2, 3) for i, t, s in rows], SCHEMA)


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdéñ") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    say = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    shared, out = say(60), []
    for i in range(n):
        kind, text = i % 7, say(rng.randint(12, 120))
        if kind == 1 and out:
            text = out[rng.randrange(len(out))][1] or ""
        elif kind == 2 and out:
            w = (out[rng.randrange(len(out))][1] or "a").split(" ")
            w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        elif kind == 3:
            text = f"{say(5)}\n{shared}\n{say(8)}"
        elif kind == 4:
            text = "\n".join([say(4)] * 3 + [say(6)]) + "  " + " ".join(["again"] * rng.randint(1, 300))
        out.append((i, text, rng.choice(["a", "b", None])))
    odd = [None, "", " \t\n", "one", "ONE", "two words", "Two  Words", "# * $ <a|b> &%", "x" * 5000, "\x0b\x0c a\rb"]
    return out + [(100 + k, t, "a" if k % 2 else None) for k, t in enumerate(odd)]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, corpus())


@pytest.fixture(scope="module")
def nothing(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def repeated(spark):
    text = "some words that come again and again in this small text of more than ten words"
    return table(spark, [(1, text, "a"), (1, text, "a"), (None, text, "a"), (None, text, None), (2, None, "a"), (2, None, "a")])


def test_base_rules(docs):
    got = {r["doc_id"]: r.asDict() for r in quality_rules.judge(docs).collect()}
    for i, text, _ in corpus():
        assert {k: got[i][k] for k in brute.base(text)} == brute.base(text), i


def test_long_text_rules(spark):
    text = " ".join(f"w{i % 30_011}" for i in range(40_000))
    row = quality_rules.judge(table(spark, [(1, text, "a")])).first()
    assert {k: row[k] for k in brute.base(text)} == brute.base(text)


@pytest.mark.parametrize("limits", [quality_rules.Limits(), quality_rules.Limits(3, 5, 10, 60)])
def test_quality_verdict(spark, limits):
    line = "this very line stands in many documents of one host only"
    rows = corpus() + [(200 + i, f"{line}\n{'own ' * (i % 4)}", "b") for i in range(25)]
    want = [rows[k][0] for k in brute.keepers(rows, limits)]
    docs = table(spark, rows)
    assert sorted(r[0] for r in quality_rules.judge(docs, limits=limits).where("kept").select("doc_id").collect()) == sorted(want)
    kept = quality_rules.keep_good(docs, limits=limits)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_lines_above_the_limits_leave_the_text(spark):
    own = lambda i: f"  These words of document {i} are its own,\n\nand there are more than ten of them in {i} "
    text = lambda i: f"Share  this PAGE\n{own(i)}\n share this page"
    rows = [(i, text(i), "host", len(text(i)), "x") for i in range(25)]
    rows += [(100, text(100), "other", len(text(100)), "x"), (101, "Share this page\nshare this page\nfour words of own", "host", 54, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, `a.b` string")
    kept = quality_rules.keep_good(docs)
    assert kept.schema == docs.schema
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept.collect()}
    want = {i: own(i) for i in range(1, 25)} | {0: text(0), 100: text(100)}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def test_repeated_rows_are_one_document_of_a_line(spark):
    line = "this line stands in two documents that repeat many times"
    own = "and these are more than ten words of the one document which has number"
    rows = [(i, f"{line}\n{own} {i}", "host") for i, n in ((1, 15), (2, 10)) for _ in range(n)]
    rows += [(None, f"{line}\n{own} none", "host")] * 5
    got = quality_rules.judge(table(spark, rows)).collect()
    assert len(got) == 30 and all(r["removed_words"] == 0 and r["kept"] for r in got)
    rows += [(i, f"{line}\n{own} {i}", "host") for i in range(3, 21)]
    got = quality_rules.judge(table(spark, rows)).collect()
    assert {(r["doc_id"], r["removed_words"]) for r in got} == {(None, 10), (1, 0), *((i, 10) for i in range(2, 21))}
    clean = {r["doc_id"]: r["text"] for r in quality_rules.keep_good(table(spark, rows)).collect()}
    assert clean == {None: f"{own} none", 1: f"{line}\n{own} 1", **{i: f"{own} {i}" for i in range(2, 21)}}


def test_exact_classes(docs):
    want = brute.exact([r[:2] for r in corpus()])
    got = exact_dedup.classes(docs).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["text_sha256"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)


@pytest.mark.parametrize("bits,limit", [(24, 1 << 20), (24, 0), (0, 0)])
def test_exact_dedup_does_not_depend_on_the_filter(docs, bits, limit):
    keep = {v[0] for v in brute.exact([r[:2] for r in corpus()]).values()}
    kept = exact_dedup.keep_one(docs, bits_per_row=bits, broadcast_bytes=limit)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(keep)


def test_exact_dedup_of_repeated_rows(repeated):
    assert exact_dedup.classes(repeated).where("kept").count() == 2
    assert sorted(str(r["doc_id"]) for r in exact_dedup.keep_one(repeated).collect()) == ["1", "2"]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, width):
    rows = [r[:2] for r in corpus()]
    want = brute.near(rows, width)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs, width=width).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(got[i]["n_shingles"] == len(brute.shingle_set(t, width)) for i, t in rows)
    kept = minhash.keep_first(docs, width=width)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in want.items() if i == r)


def test_near_duplicates_of_repeated_rows(repeated):
    got = minhash.near_duplicates(repeated, width=2)
    assert got.where("first and n_shingles > 0").count() == 1
    kept = minhash.keep_first(repeated, width=2).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "2", "2"]


def test_chains_of_links_beyond_the_hub(spark):
    """Each text is like its neighbours only; one bucket must not stop at its first hub."""
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**9)}" for _ in range(400)]
    rows = [(i, " ".join(words[i * 6 : i * 6 + 100]), "a") for i in range(40)]
    want = brute.near([r[:2] for r in rows], 2)
    got = minhash.near_duplicates(table(spark, rows), width=2)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def test_tables_written_do_not_grow_with_the_links_of_a_chain(spark, monkeypatch):
    """One pass finds what hubs leave; a round of its own for every few links writes more and more tables."""
    written, stage = [], minhash.stage
    monkeypatch.setattr(minhash, "stage", lambda df: written.append(1) or stage(df))
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**9)}" for _ in range(400)]
    rows = [(i, " ".join(words[i * 6 : i * 6 + 100]), "a") for i in range(40)]
    got = minhash.near_duplicates(table(spark, rows), width=2)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == brute.near([r[:2] for r in rows], 2)
    assert len(written) <= 17


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200), (300, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, **{k: 100 for k in range(101, 140)}, 201: 200}


@pytest.mark.parametrize("depth,digit,group,limit", [(60, 20, 2000, 1 << 20), (60, 20, 1, 0), (200, 64, 2000, 1 << 20), (8, 3, 2, 1 << 20)])
def test_repeated_passages(docs, depth, digit, group, limit):
    rows = corpus()
    out = suffix_dedup.remove_repeats(docs, depth=depth, digit=digit, group_items=group, broadcast_bytes=limit).collect()
    got = {r["doc_id"]: (bytes(r["kept"]), r["n_spans"]) for r in out}
    want = dict(zip([r[0] for r in rows], brute.repeats([r[1] for r in rows], depth), strict=True))
    assert got == want
    assert all(r["n_bytes"] - r["n_removed"] == len(r["kept"]) for r in out)


def test_repeated_rows_repeat_each_other(spark, repeated):
    out = suffix_dedup.remove_repeats(repeated, depth=30, digit=10).collect()
    assert len(out) == 6 and all(len(r["kept"]) == 0 for r in out)


def test_targets_and_shares(docs):
    rows = corpus()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    want, got = brute.targets(sizes), mixing.shares(docs).collect()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] <= 2 * r["size"]
    largest = max(r["size"] for r in got)
    for s, t in want.items():
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - t) <= 2 * largest
    assert sorted(map(str, got)) == sorted(map(str, mixing.shares(docs.repartition(5)).collect()))


def test_one_source_and_sources_without_words(spark):
    rows = [(i, "a b c d", "only") for i in range(10)] + [(50, None, "none"), (51, "", None)]
    got = mixing.shares(table(spark, rows)).collect()
    assert sum(r["taken"] for r in got) == 60
    assert {r["source"]: r["target"] for r in got} == {"only": 60.0, "none": 0.0, None: 0.0}


@pytest.mark.parametrize("ordered", [True, False])
def test_mix_repeats_rows_as_often_as_taken(docs, ordered):
    want = {r["doc_id"]: r["copies"] for r in mixing.shares(docs).collect() if r["copies"]}
    got: dict = {}
    mixed = mixing.mix(docs, ordered=ordered)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == want


def test_mix_keeps_repeated_rows(repeated):
    shares = mixing.shares(repeated)
    assert mixing.mix(repeated).count() == shares.groupBy().sum("copies").first()[0]


def test_best_fit_meets_its_bound():
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(20):
        sizes = rng.integers(1, 101, rng.integers(1, 300))
        bins, offsets, total = packing.best_fit_decreasing(sizes, 100)
        fill = np.bincount(bins, weights=sizes)
        assert len(fill) == total and fill.max() <= 100
        assert -(-sizes.sum() // 100) <= packing.lower_bound(sizes, 100) <= total
        for b in range(total):
            mine = np.flatnonzero(bins == b)
            order = mine[np.argsort(offsets[mine])]
            assert offsets[order].tolist() == np.concatenate([[0], np.cumsum(sizes[order])[:-1]]).tolist()


def test_lower_bound_of_large_items():
    import numpy as np

    assert packing.lower_bound(np.array([51] * 7), 100) == 7
    assert packing.lower_bound(np.array([34] * 7), 100) == 4


TOKENIZER = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def _packed_right(out, docs, capacity):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    pieces, sequences = {}, {}
    for r in out:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for i, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for r in pieces[i]:
            mine = np.array(ids[r["start"] : r["start"] + capacity], "<u4")
            assert r["start"] == r["piece"] * capacity and r["length"] == len(mine)
            assert r["ids_crc32"] == zlib.crc32(mine.tobytes())
        assert sum(r["length"] for r in pieces[i]) == len(ids)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("part", [50_000, 7])
def test_packing(docs, part):
    rows = [*((i, t) for i, t, _ in corpus())]
    out = packing.pack(docs, TOKENIZER, capacity=128, part_pieces=part).collect()
    used = _packed_right(out, rows, 128)
    total = sum(r["length"] for r in out)
    assert used <= -(-total // 128) * (1.05 if part > 100 else 1.25)


def test_packing_of_odd_texts(spark):
    rows = [(k, t) for k, t in enumerate(["don't", "a<|endoftext|>b", "ΑΣ ΣΑΣ", "é ́x", "a\u2003b\x85c", "İI", "\x1c\x1d x", None])]
    _packed_right(packing.pack(table(spark, [(i, t, "a") for i, t in rows]), TOKENIZER).collect(), rows, 4096)


def test_words_of_many_texts_are_encoded_once():
    """Texts are encoded together; a word counts as one whatever ends it, and is not encoded again."""
    import pyarrow as pa

    texts = ["", "one two\n\ntwo  don't ", "\n", "ΑΣ one", "é\u2003x a\u0085 two", None, " ", "x\r\ny\tz", ""]
    encoder = packing.Encoder(TOKENIZER)
    whole = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for kind in (pa.string(), pa.large_string()):
        for first in (0, 1, 5, 8):
            data, ends = packing._text_ends(pa.array(texts, kind).fill_null("")[first:])
            ids, upto = encoder.encode(data, ends)
            assert [part.tolist() for part in np.split(ids, upto)[:-1]] == whole[first:]
    known = {w for t in texts for w in (t or "").replace("\n", " ").split(" ")}
    assert sorted(encoder.words.to_pylist()) == sorted(known)


def test_repeated_rows_are_packed_each(repeated):
    out = packing.pack(repeated, TOKENIZER).collect()
    assert len(out) == 6 and len({(r["sequence_id"], r["offset"]) for r in out}) == 6


def test_packed_pieces_hold_their_ids(docs):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    packed = packing.pack(docs, TOKENIZER, capacity=128, part_pieces=7)
    out, want, found = packed.collect(), {}, {}
    for r in out:
        assert len(r["ids"]) == r["length"]
        found.setdefault((r["doc_id"], r["doc_row"]), []).append((r["start"], r["ids"]))
    for i, text, _ in corpus():
        want[i] = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
    assert {i: [x for _, ids in sorted(v) for x in ids] for (i, _), v in found.items()} == want
    crc = {(r["sequence_id"], r["offset"]): zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in out}
    derived = packing.digests(packed).collect()
    assert {(r["sequence_id"], r["offset"]): r["ids_crc32"] for r in derived} == crc and len(derived) == len(out)


def test_copies_of_a_document_are_told_apart(spark):
    text = " ".join(f"word{k}" for k in range(300))
    out = packing.pack(table(spark, [(1, text, "a"), (1, text, "a")]), TOKENIZER, capacity=128).collect()
    copies = {n: sorted(r["piece"] for r in out if r["doc_row"] == n) for n in {r["doc_row"] for r in out}}
    assert len(copies) == 2 and all(p == list(range(len(out) // 2)) and len(p) > 1 for p in copies.values())


def test_license_scan(spark):
    rows = [
        (1, "first line\nLicensed under the  APACHE license version 2.0\nlast", "a"),
        (2, license_scan.TEMPLATES["mit-permission"] + " once more", "a"),
        (3, "the permission is granted to nobody", "a"), (4, None, "a"), (5, "", None), (6, "license", "a"),
    ]
    got = license_scan.scan(table(spark, rows)).collect()
    assert {(r["doc_id"], r["license"], r["line"]) for r in got} == {(1, "apache-2.0", 0), (1, "apache-2.0", 2), (2, "mit-permission", 0)}
    assert all(0.8 <= r["dice"] <= 1 for r in got)


def test_notices_inside_longer_texts(spark):
    import textwrap

    wrapped = {n: textwrap.fill(license_scan.TEMPLATES[n], 76) for n in ("apache-2.0-notice", "gpl-3.0-notice", "mit-permission")}
    other = " ".join(f"other{k} word" for k in range(200))
    rows = [(k, f"{other}\n{text}\n{other}", "a") for k, text in enumerate(wrapped.values())]
    rows += [
        (10, "This project is free to use. Released under the MIT License.", "a"),
        (11, f"{other} Released under\nthe MIT License. {other}\nReleased under the MIT License.\n{other} released under the mit license", "a"),
        (12, f"{other}\nreleased under some licence of the house", "a"),
    ]
    got = license_scan.scan(table(spark, rows), templates=license_scan.TEMPLATES).collect()
    found = sorted((r["doc_id"], r["license"], r["line"]) for r in got if r["doc_id"] > 2 or r["license"] in wrapped)
    want = [(k, n, 2) for k, n in enumerate(wrapped)] + [(10, "mit", 1), (11, "mit", 1), (11, "mit", 3), (11, "mit", 4)]
    assert found == want
    assert not any(r["whole"] for r in got) and all(0.8 <= r["dice"] <= 1 for r in got)


def test_whole_licence_texts(spark):
    texts = license_scan.license_texts()
    rows = [(k, f"Copyright (c) 2020 Some Person\n\n{t}", "a") for k, t in enumerate(texts.values())]
    rows += [(100 + k, " ".join(f"own{n}" for n in range(12_000)) + "\n" + t, "a") for k, t in enumerate(texts.values())]
    got = {(r["doc_id"], r["license"], r["whole"]) for r in license_scan.scan(table(spark, rows)).collect()}
    for k, name in enumerate(texts):
        assert {(k, name, True), (100 + k, name, False)} <= got, name


@pytest.mark.parametrize(
    "run",
    [
        quality_rules.judge, quality_rules.keep_good, exact_dedup.classes, exact_dedup.keep_one, minhash.near_duplicates,
        minhash.keep_first, mixing.shares, mixing.mix, suffix_dedup.remove_repeats, license_scan.scan,
        lambda d: packing.pack(d, TOKENIZER),
    ],
)
def test_empty_tables(nothing, run):
    assert run(nothing).collect() == []


def test_unlinked_copies_cost_linear_pairs(spark, monkeypatch):
    """Copies of one text, each too far from every other: pairs whose texts are compared grow with the copies."""
    compared = {}
    confirmed = minhash.confirmed

    def counted(pairs, width, similarity_pct):
        compared[size] = compared.get(size, 0) + pairs.count()
        return confirmed(pairs, width, similarity_pct)

    monkeypatch.setattr(minhash, "confirmed", counted)
    for size in (100, 400):
        rng = random.Random(7)
        base = [f"w{k}" for k in range(200)]
        rows = []
        for i in range(size):
            words = list(base)
            for place in rng.sample(range(200), 14):
                words[place] = f"x{i}_{place}"
            rows.append((i, " ".join(words)))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = minhash.near_duplicates(docs).collect()
        assert all(r["component_id"] == r["doc_id"] for r in found)
    assert compared.get(400, 0) <= 40 * 400
    assert compared.get(400, 0) <= 8 * max(compared.get(100, 0), 100)


def test_crowded_bucket_components_equal_brute_force(spark):
    """Over a hundred edited copies share buckets: parts of them give the links of an exact comparison."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(150):
        words = list(base)
        for place in rng.sample(range(300), rng.choice([2, 5, 8, 11])):
            words[place] = f"x{i}_{place}"
        rows.append((i, " ".join(words)))
    for some, exhaustive in ((rows, False), (rows[:30], True)):
        docs = spark.createDataFrame(some, "doc_id long, text string")
        found = minhash.near_duplicates(docs, exhaustive=exhaustive).collect()
        assert {r["doc_id"]: r["component_id"] for r in found} == brute.near(some, 5)


def test_block_comparison_equals_sets():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 60))).astype(np.uint64) for _ in range(40)]
    sets += [np.arange(9000, dtype=np.uint64), np.arange(1000, 9001, dtype=np.uint64)]
    one, other = sets[::2], sets[1::2]
    assert minhash._shared(one, other).tolist() == [[len(np.intersect1d(a, b)) for b in other] for a in one]
    root = minhash._joined(one, other, 80)
    for i, a in enumerate(one):
        for j, b in enumerate(other, len(one)):
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert root[i] == root[j]
    assert root[len(one) - 1] == root[-1]
    assert all(r <= k for k, r in enumerate(root))
