"""Registered queries against their SQL, the pipeline against plain Python."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from statloom.llm import oracle, quality_rules, queries
from tests.llm import brute
from tests.llm.test_operators import _packed_right, corpus
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_equals_sql(spark, duck, small_dir, name):
    assert compare(spark, duck, name, queries.QUERIES[name], oracle.ORACLE[name], small_dir) is None


def test_quality_query_equals_sql_where_lines_go(spark, tmp_path):
    line = "One line that stands in many documents of a host"
    rows = corpus(5, 60) + [(500 + i, f"{line}\n{'own words here ' * (i % 9)}{i}", "ab"[i % 2]) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    with duckdb.connect() as con:
        con.sql(f"create view documents as from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
        name = "op1_quality_rules"
        assert compare(spark, con, name, queries.QUERIES[name], oracle.ORACLE[name], str(tmp_path)) is None
    assert queries.QUERIES[name](spark, str(tmp_path)).where("removed_words > 0").count() > 40


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())


def _mixed(rows):
    """Rows (id, text, source) as often as the mix takes them."""
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    target = brute.targets(sizes)
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    key = {i: md5(f"mix:{i}:{md5(t or '')}") for i, t, _ in rows}
    copies, run = [], dict.fromkeys(sizes, 0)
    for i, t, s in sorted(rows, key=lambda r: key[r[0]]):
        n = len(brute.words(t))
        run[s] += n
        copies += [((e * sizes[s] + run[s]) / target[s], key[i], i, e, n) for e in range(2) if n]
    total, out = sum(target.values()), []
    for *_, i, _e, n in sorted(copies):
        if n > total:
            break
        total -= n
        out.append(i)
    return out


def test_pipeline_against_plain_python(spark, tmp_path):
    rows = [(i, t, s) for i, t, s in corpus(7, 150)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = [rows[k] for k in brute.keepers(rows, quality_rules.Limits())]
    keep = {v[0] for v in brute.exact([r[:2] for r in rows]).values()}
    rows = [r for r in rows if r[0] in keep]
    near = brute.near([r[:2] for r in rows], 5)
    rows = [r for r in rows if near[r[0]] == r[0]]
    taken = _mixed(rows)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in out if r["piece"] == 0) == sorted(taken)
    text = {r[0]: r[1] for r in rows}
    once = {i for i in text if taken.count(i) == 1}
    assert len(once) > 5
    used = {r["sequence_id"] for r in out}
    assert len(used) <= -(-sum(r["length"] for r in out) // 4096) + 1
    single = [r for r in out if r["doc_id"] in once]
    for i in once:
        assert [r["piece"] for r in single if r["doc_id"] == i] == [0]


def test_packing_of_the_test_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    out = queries.op4_pack_sequences(spark, small_dir).collect()
    assert _packed_right(out, [tuple(d) for d in docs], 4096) == -(-sum(r["length"] for r in out) // 4096)


def test_suffix_query_on_the_test_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([d[0] for d in docs], brute.repeats([d[1] for d in docs], 200), strict=True))
    for r in queries.op5_suffix_dedup(spark, small_dir).collect():
        kept, runs = want[r["doc_id"]]
        assert (r["n_bytes"] - r["n_removed"], r["n_spans"]) == (len(kept), runs)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_near_query_on_the_test_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    want = brute.near([tuple(d) for d in docs], 2)
    got = {r["doc_id"]: r for r in queries.op7_minhash_near_dedup(spark, small_dir).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())


def test_classifier_on_held_out_labels(spark, small_dir):
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{small_dir}/labels.parquet").collect()}
    scored = queries.op6_quality_classifier(spark, small_dir).where("held_out").collect()
    right = [r["predicted"] == truth[r["doc_id"]] for r in scored if r["doc_id"] in truth]
    assert len(right) > 10 and sum(right) >= 0.9 * len(right)


def test_toxicity_on_held_out_labels(spark, small_dir):
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{small_dir}/labels.parquet").collect()}
    scored = queries.op11_toxicity(spark, small_dir).collect()
    assert len(scored) == spark.read.parquet(f"{small_dir}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in scored)
    held = [r for r in scored if r["held_out"] and r["doc_id"] in truth]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in scored if r["held_out"])
    clean = [r["predicted"] == 0 for r in held if truth[r["doc_id"]] == 0]
    assert len(clean) > 10 and sum(clean) >= 0.9 * len(clean)
