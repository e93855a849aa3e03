from __future__ import annotations

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from statloom.operators import fingerprint as fp
from statloom.operators import quality as q
from statloom.plans import checks
from statloom.sources.schemas import GOLD, table, H, I, S


def test_gate_blocks_on_errors_only(spark, rows):
    df = spark.createDataFrame([(1, -1.0), (1, 5.0), (None, 200.0)], "k int, v double")
    warn = q.quality_report([q.Check("grano", q.check_unique_values(df, "k"), q.WARN)])
    assert rows(q.gate(spark, warn)) == [{"prueba": "grano", "gravedad": "warn", "fallos": 1, "superada": False}]
    rules = {"a": q.is_missing("k"), "b": q.is_negative("v", F.col("k") == 2), "c": q.is_out_of_range("v", 0, 100)}
    report = q.rules_report(df, rules)
    assert {r.prueba: r.fallos for r in report.collect()} == {"a": 1, "b": 0, "c": 2}
    with pytest.raises(q.QualityError, match=r"a \(1\), c \(2\)"):
        q.gate(spark, report)


def test_relationship_ignores_missing_keys(spark, rows):
    df = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    to = spark.createDataFrame([("a",), ("b",)], "id string")
    assert rows(q.check_relationship(df, "k", to, "id")) == [{"k": "x", "filas": 2}]
    assert rows(q.missing_keys(to, "id", df, "k")) == [{"id": "b"}]


@pytest.mark.parametrize(("today", "age", "fresh"), [("2026-10-31", 4, True), ("2026-11-01", 5, False)])
def test_freshness(spark, today, age, fresh):
    df = spark.createDataFrame([(datetime.date(2026, 6, 1),)], "d date")
    row = q.freshness(df, "d", F.lit(today).cast("date")).first()
    assert (row.meses_de_retraso, row.vigente) == (age, fresh)


def test_no_data_is_not_fresh(spark):
    df = spark.createDataFrame([], "d date")
    assert q.freshness(df, "d", F.current_date()).first().vigente is False


CONTRACT = table((I, "a"), (S, "b"), required=("a",))


@pytest.mark.parametrize(
    ("schema", "message"),
    [
        ("a int", "missing b"),
        ("a int, b string, c int", "unexpected c"),
        ("a bigint, b string", "a is bigint, not int"),
    ],
)
def test_contract_violations(spark, schema, message):
    with pytest.raises(q.ContractError, match=message):
        q.enforce(spark.createDataFrame([], schema), CONTRACT)


def test_contract_orders_columns_and_refuses_null_keys(spark):
    df = spark.createDataFrame([("x", 1)], "b string, a int")
    assert q.enforce(df, CONTRACT).columns == ["a", "b"]
    bad = spark.createDataFrame([("x", None)], "b string, a int")
    with pytest.raises(PySparkException, match="NULL in a required column"):
        q.enforce(bad, CONTRACT).collect()


def test_declared_checks_add_up():
    tables = set(checks.NOT_NULL) | set(checks.ACCEPTED) | set(checks.NOT_NEGATIVE) | set(GOLD)
    rules = sum(len(checks.row_rules(t)) for t in tables)
    keys = sum(len(g) for g in checks.GRAIN.values()) + sum(map(len, checks.RELATIONSHIPS.values()))
    assert rules == 20 + 9 + 17 + 7
    assert keys == 20 + 13


def test_fingerprint_does_not_depend_on_partitions(spark):
    df = spark.range(1000).select((F.col("id") / 7).alias("x"), F.col("id").cast("smallint").alias("n"), F.lit("t").alias("s"))
    a, b = fp.fingerprint(df.repartition(7)), fp.fingerprint(df.coalesce(1))
    assert a.columns == ["filas", "suma_x", "no_finitos_x", "suma_n"]
    assert a.first() == b.first()
    assert fp.parity({"t": df.repartition(3)}, {"t": df}).count() == 0


@pytest.mark.parametrize(
    ("values", "total", "odd"),
    [
        ([4e-7] * 1000, 0.0004, 0),
        ([-0.25, -1.5, 3.75], 2.0, 0),
        ([float("nan"), float("inf"), 1.5, None], 1.5, 2),
        ([1e17, 2.5, -1e17, 0.25], 2.75, 0),
        ([None], None, 0),
    ],
)
def test_fingerprint_of_fractions(spark, values, total, odd):
    row = fp.fingerprint(spark.createDataFrame([(v,) for v in values], "x double")).first()
    assert (row["suma_x"], row["no_finitos_x"]) == (total, odd)


def test_fingerprint_of_large_keys(spark):
    top = 9223372036854775807
    row = fp.fingerprint(spark.createDataFrame([(top,), (top,), (-5,), (None,)], "k long")).first()
    assert row["suma_k"] == float(2 * top - 5)


def test_parity_shows_only_what_differs(spark, rows):
    a = {"t": spark.range(3), "u": spark.range(2)}
    b = {"t": spark.range(4), "u": spark.range(2), "w": spark.range(1)}
    assert rows(fp.parity(a, b)) == [
        {"tabla": "t", "medida": "filas", "valor_a": 3.0, "valor_b": 4.0},
        {"tabla": "t", "medida": "suma_id", "valor_a": 3.0, "valor_b": 6.0},
        {"tabla": "w", "medida": "filas", "valor_a": None, "valor_b": 1.0},
        {"tabla": "w", "medida": "suma_id", "valor_a": None, "valor_b": 0.0},
    ]


def test_sums_of_keys_do_not_overflow(spark):
    df = spark.range(4).select(F.lit(2**63 - 1).alias("k"))
    assert fp.fingerprint(df).first().suma_k == pytest.approx(4.0 * (2**63 - 1))


def test_contract_rows(spark, rows):
    df = spark.createDataFrame([(1, "a")], table((I, "n"), (S, "t"))).withColumn("h", F.lit(1).cast(H))
    assert [(r["posicion"], r["nombre"], r["tipo"], r["filas"]) for r in rows(fp.contract_rows({"x": df}))] == [
        (1, "n", "INTEGER", 1),
        (2, "t", "VARCHAR", 1),
        (3, "h", "SMALLINT", 1),
    ]
