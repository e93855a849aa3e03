"""The given tables and the monthly demand relation that most indicators start from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.columns import cents, month_of

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its quantity; lines are summed per order before the join."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum("l_quantity").alias("pernoctaciones"))
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        month_of("o_orderdate").alias("fecha"),
        F.when(F.col("o_orderstatus") == "F", "espana")
        .otherwise("extranjero")
        .alias("residencia"),
        (F.col("o_orderstatus") == "P").alias("es_provisional"),
    )
    return orders.join(lines, "o_orderkey")


def demand(spark: SparkSession, sf_dir: str, by: Sequence[str] = ()) -> DataFrame:
    """Monthly demand: people (orders) and nights (quantity) per month, segment and ``by``.

    ``by`` may add ``nacion``, ``residencia`` and ``es_provisional`` to the grain. Orders are summed
    per customer and month before the customers are joined, so a customer with very many orders
    reaches that join as a few rows.
    """
    keys = ["o_custkey", "fecha", *(c for c in by if c != "nacion")]
    volumes = (
        order_volumes(spark, sf_dir)
        .groupBy(*keys)
        .agg(F.sum("pernoctaciones").alias("pernoctaciones"), F.count(F.lit(1)).alias("viajeros"))
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_mktsegment").alias("tipo"),
        F.col("c_nationkey").alias("nacion"),
    )
    cells = (
        volumes.join(customers, "o_custkey")
        .groupBy("tipo", "fecha", *by)
        .agg(
            F.sum("pernoctaciones").alias("pernoctaciones"),
            F.sum("viajeros").alias("viajeros"),
        )
    )
    return cells.select(
        "tipo",
        "fecha",
        F.year("fecha").alias("anio"),
        F.month("fecha").alias("mes"),
        *by,
        "pernoctaciones",
        "viajeros",
    )


#: The same relation in SQL, at its finest grain.
DEMAND_SQL = """
lineas as (
    select l_orderkey, sum(l_quantity) as q from lineitem group by l_orderkey
),
base as (
    select c.c_mktsegment as tipo,
           cast(date_trunc('month', o.o_orderdate) as date) as fecha,
           cast(year(o.o_orderdate) as integer) as anio,
           cast(month(o.o_orderdate) as integer) as mes,
           c.c_nationkey as nacion,
           case when o.o_orderstatus = 'F' then 'espana' else 'extranjero' end as residencia,
           o.o_orderstatus = 'P' as es_provisional,
           sum(l.q) as pernoctaciones,
           cast(count(*) as bigint) as viajeros
    from orders o
    join lineas l on l.l_orderkey = o.o_orderkey
    join customer c on c.c_custkey = o.o_custkey
    group by all
)"""

def complete_years_sql(base: str, group: str, out: str) -> str:
    """Years without a hole: every month that every group should have is laid out, and none of
    them is left over when the months with a value are taken away."""
    return f"""
{out} as (
    select distinct anio from {base} where anio not in (
        select anio from (
            select {group}, anio, mes
            from (select distinct {group} from {base}), (select distinct anio from {base}),
                 (select unnest(range(1, 13)) as mes)
            except
            select {group}, anio, mes from {base} where pernoctaciones is not null
        )
    )
)"""


#: Years in which every group of ``base`` has twelve months.
YEARS_SQL = complete_years_sql("base", "tipo", "completos")


def monthly_money(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The same months seen by two sources, in whole cents: order totals and line prices."""
    orders = table(spark, sf_dir, "orders")
    headers = orders.groupBy(
        month_of("o_orderdate").alias("fecha"), F.col("o_orderstatus").alias("estado")
    ).agg(F.sum(cents("o_totalprice")).alias("importe"), F.count(F.lit(1)).alias("pedidos"))
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum(cents("l_extendedprice")).alias("importe"))
    )
    details = (
        orders.select(
            F.col("o_orderkey").alias("l_orderkey"),
            month_of("o_orderdate").alias("fecha"),
            F.col("o_orderstatus").alias("estado"),
        )
        .join(lines, "l_orderkey")
        .groupBy("fecha", "estado")
        .agg(F.sum("importe").alias("importe"), F.count(F.lit(1)).alias("pedidos"))
    )
    return headers, details


MONEY_SQL = """
cabeceras as (
    select cast(date_trunc('month', o_orderdate) as date) as fecha, o_orderstatus as estado,
           sum(cast(round(o_totalprice * 100) as bigint)) as importe, count(*) as pedidos
    from orders group by all
),
lineas as (
    select l_orderkey, sum(cast(round(l_extendedprice * 100) as bigint)) as importe
    from lineitem group by l_orderkey
),
detalles as (
    select cast(date_trunc('month', o.o_orderdate) as date) as fecha, o.o_orderstatus as estado,
           sum(l.importe) as importe, count(*) as pedidos
    from orders o join lineas l on l.l_orderkey = o.o_orderkey
    group by all
)"""
