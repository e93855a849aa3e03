"""Plans and results that must hold when the data grow or one key holds a third of the rows."""

from __future__ import annotations

import datetime
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from statloom import workload
from statloom.operators import periods as per
from statloom.operators import quality as q
from statloom.operators import reshape as res
from statloom.operators import residual as rsd
from statloom.operators.staging import Workspace
from statloom.plans.tables import built_in
from statloom.session import cluster_settings
from statloom.workload.tables import DEMAND_SQL, demand
from tests.oracle import compare

HEAVY = [
    "seasonal_profile",
    "group_ratio_profile",
    "gap_preserving_series",
    "latest_per_group",
    "published_periods",
    "pivot_measures",
    "residual_by_parent",
    "detail_plus_residual",
    "reconcile_exceptions",
    "check_relationship",
    "missing_keys",
    "personnel_series",
    "first_occurrence",
    "consecutive_runs",
    "month_lag",
    "hierarchy_dimension",
    "star_demand_fact",
    "star_monthly_series",
]


@pytest.fixture
def big_data_plans(spark):
    """No broadcast by size and eager skew splitting: the plans a large cluster would use."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", HEAVY)
def test_results_without_broadcasts(spark, duck, small_dir, big_data_plans, name):
    sql = entry.oracle_sql()[name]
    assert compare(spark, duck, name, entry.queries()[name], sql, small_dir) is None


def plan(df, run: bool = True) -> str:
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(workload.QUERIES))
def test_no_products_and_no_row_at_a_time_python(spark, small_dir, monkeypatch, name):
    """Intermediates stay in the plan here, so all of it is looked at."""
    for module in ("demand", "rows", "balance", "star"):
        monkeypatch.setattr(f"statloom.workload.{module}.shared", lambda df: df)
    text = plan(entry.queries()[name](spark, small_dir), run=False)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert ("MapInArrow" in text) == name.startswith("html_")


def test_base_relation_scans_each_table_once_and_only_its_columns(spark, small_dir):
    text = plan(demand(spark, small_dir)).split("Initial Plan")[0]
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    columns = {tuple(sorted(re.sub(r"#\d+L?", "", s).split(","))) for s in scans}
    assert columns == {
        ("l_orderkey", "l_quantity"),
        ("o_custkey", "o_orderdate", "o_orderkey"),
        ("c_custkey", "c_mktsegment"),
    }
    assert len(scans) == 3


def test_one_customer_with_a_third_of_all_orders(spark, small_dir, big_data_plans, tmp_path):
    """The join on the hot customer is split and the totals stay whole."""
    for name in ("orders", "lineitem", "customer"):
        df = spark.read.parquet(f"{small_dir}/{name}.parquet")
        if name == "orders":
            hot_key = F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.col("o_custkey"))
            df = df.withColumn("o_custkey", hot_key.cast("bigint"))
        df.repartition(8).write.parquet(str(tmp_path / f"{name}.parquet"))
    cube = demand(spark, str(tmp_path))
    text = plan(cube)
    assert "SortMergeJoin(skew=true)" in text
    con = duckdb.connect()
    for name in ("orders", "lineitem", "customer"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(
        f"with {DEMAND_SQL} select tipo, fecha, sum(pernoctaciones), cast(sum(viajeros) as bigint)"
        " from base group by all"
    ).fetchall()
    got = cube.select("tipo", "fecha", "pernoctaciones", "viajeros").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_filters_reach_the_scan(spark, small_dir):
    text = plan(entry.queries()["classify_join"](spark, small_dir))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "EqualTo(r_name,EUROPE)" in text


def test_foreign_key_checks_move_each_key_once(spark, small_dir, big_data_plans):
    """Two exchanges of distinct keys; the anti join adds none."""
    text = plan(entry.queries()["check_relationship"](spark, small_dir)).split("Initial Plan")[0]
    assert len(re.findall(r"[-+] Exchange hashpartitioning", text)) == 2
    assert len(re.findall(r"HashAggregate", text)) == 4


def test_settings_grow_with_the_data():
    small, large = cluster_settings(1 << 30, 8), cluster_settings(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
    assert int(large["spark.sql.shuffle.partitions"]) == 51200
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 1 << 30


def test_fixed_tables_are_broadcast_by_their_known_size(spark):
    labels = built_in(spark)["destinos_murciaturistica"]
    facts = spark.range(1000).select(F.col("id").cast("string").alias("destino"), "id")
    text = plan(facts.join(labels, "destino"), run=False)
    assert "LocalTableScan" in text
    assert "BroadcastHashJoin" in text
    assert built_in(spark)["excepciones_cuadre"].count() == 0


def test_first_occurrence_is_trimmed_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    text = plan(res.first_occurrence(df, ["k"], ["v"])).split("Initial Plan")[0]
    exchange = text.index("Exchange hashpartitioning(k")
    assert "WindowGroupLimit" in text[exchange:]


@pytest.fixture
def hot(spark):
    """30,000 rows; key 0 holds a third of them."""
    ids = spark.range(30_000)
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000 + 1)
    return ids.select(key.cast("int").alias("k"), "id", (F.col("id") % 97).alias("v")).repartition(6)


def brute(hot):
    groups: dict[int, list] = {}
    for r in hot.collect():
        groups.setdefault(r.k, []).append((r.id, r.v))
    return groups


def test_operators_with_a_hot_key(spark, hot, big_data_plans):
    groups = brute(hot)
    first = {r.k: r.id for r in res.first_occurrence(hot, ["k"], ["v", "id"]).collect()}
    assert first == {k: min((v, i) for i, v in g)[1] for k, g in groups.items()}
    last = {r.k: r.id for r in res.latest_per_group(hot, ["k"], ["v", "id"]).collect()}
    assert last == {k: max((v, i) for i, v in g)[1] for k, g in groups.items()}
    peaks = {r.k: (r.peak, r.peak_value, r.trough) for r in res.peak_and_trough(hot, "k", "id", "v").collect()}
    assert peaks == {
        k: (
            min(i for i, v in g if v == max(x for _, x in g)),
            max(x for _, x in g),
            min(i for i, v in g if v == min(x for _, x in g)),
        )
        for k, g in groups.items()
    }
    known = spark.range(500).select(F.col("id").cast("int").alias("id"))
    orphans = {r.k: r.filas for r in q.check_relationship(hot, "k", known, "id").collect()}
    assert orphans == {k: len(g) for k, g in groups.items() if k >= 500}
    totals = hot.groupBy("k").agg((F.sum("v") + 5).alias("v"))
    rest = rsd.residual(
        rsd.stack_levels(totals, hot, ["k"], ["v"]), ["k"], "row_type", "total", "child", ["v"]
    )
    assert {r.v for r in rest.collect()} == {5}
    assert rest.count() == len(groups)
    kept = per.keep_published(hot.withColumn("w", F.when(F.col("k") == 7, 0).otherwise(F.col("v"))), "k", ["w"])
    assert kept.count() == 30_000 - len(groups[7])


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64, 4096])
@pytest.mark.parametrize("seed", [1, 2])
def test_runs_against_brute_force(spark, block, seed):
    rng = random.Random(seed)
    data = [(k, p) for k in range(6) for p in range(-40, 60) if rng.random() < 0.15 * (k + 1)]
    rng.shuffle(data)
    df = spark.createDataFrame(data + data[:50] + [(1, None)], "k int, p int")
    expected = set()
    for k in range(6):
        positions = sorted({p for q_, p in data if q_ == k})
        start = prev = None
        for p in [*positions, None]:
            if start is not None and p != prev + 1:
                expected.add((k, start, prev, prev - start + 1))
                start = None
            if start is None:
                start = p
            prev = p
    got = [tuple(r) for r in per.consecutive_runs(df, ["k"], "p", block).collect()]
    assert len(got) == len(expected)
    assert set(got) == expected


def test_a_whole_run_over_many_blocks_is_one_run(spark):
    df = spark.range(0, 10_000).select(F.lit("a").alias("k"), F.col("id").alias("p"))
    assert [tuple(r) for r in per.consecutive_runs(df, ["k"], "p", 100).collect()] == [("a", 0, 9999, 10_000)]


def test_kept_relations_end_the_lineage_and_go_with_their_workspace(spark, tmp_path):
    with Workspace(spark, str(tmp_path)) as work:
        df = work.keep(spark.range(10).withColumn("x", F.col("id") * 2))
        assert "ReadSchema: struct<x:bigint>" in plan(df.select("x"))
        assert df.agg(F.sum("x")).first()[0] == 90
        assert len(list(tmp_path.iterdir())) == 1
    assert list(tmp_path.iterdir()) == []
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


@pytest.mark.parametrize("name", ["star_seasonal_profiles", "star_zone_profile", "star_complete_years", "star_price_series"])
def test_deep_plans_stay_small(spark, small_dir, name):
    df = entry.queries()[name](spark, small_dir)
    text = df._jdf.queryExecution().toString()
    assert len(text) < 100_000 and text.count("FileScan parquet") <= 12
    assert "InMemoryTableScan" not in text and spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


@pytest.mark.parametrize("make", [lambda df: per.gap_series(df, df, "g", "d", "v", "f"), lambda df: per.year_spine(df, "g", "y", "v")])
def test_gaps_are_filled_without_a_join(spark, make):
    schema = "g string, d date, y int, v bigint, f boolean"
    days = [("a", 1), ("a", 4), ("b", 2), ("c", 5)]
    df = spark.createDataFrame([(g, datetime.date(2020, m, 1), 2000 + m, m, True) for g, m in days], schema)
    out = make(df)
    assert "Join" not in plan(out)
    column = out.columns[1]
    found = {(r["g"], r[column].month if column == "d" else r[column] - 2000): r["v"] for r in out.collect()}
    assert found == {(g, m): (m if (g, m) in days else None) for g in "abc" for m in range(1, 6)}
