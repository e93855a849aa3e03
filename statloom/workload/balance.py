"""Residuals, balances and agreement between two sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.columns import cents, month_key, month_of
from statloom.operators import reconcile as rec
from statloom.operators import residual as rsd
from statloom.operators.staging import shared
from statloom.workload import query
from statloom.workload.tables import MONEY_SQL, monthly_money, table

ABSOLUTE, RELATIVE = 10, 0.0005

LEVELS_SQL = """
totales as (
    select o_orderkey as pedido, o_orderstatus as estado,
           cast(round(o_totalprice * 100) as bigint) as importe from orders
),
partes as (
    select l.l_orderkey as pedido, o.o_orderstatus as estado,
           sum(cast(round(l.l_extendedprice * 100) as bigint)) as importe
    from lineitem l join orders o on o.o_orderkey = l.l_orderkey group by all
),
resto as (
    select t.pedido, t.estado,
           cast(greatest(t.importe - coalesce(p.importe, 0), 0) as bigint) as importe
    from totales t left join partes p using (pedido)
)"""


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals and their lines as one relation of typed rows."""
    totals = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pedido"), cents("o_totalprice").alias("importe")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("pedido"), cents("l_extendedprice").alias("importe")
    )
    return rsd.stack_levels(totals, lines, ["pedido"], ["importe"])


def _residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rsd.residual(
        _levels(spark, sf_dir), ["pedido"], "row_type", "total", "child", ["importe"]
    )


@query("residual_by_parent", f"with {LEVELS_SQL} select pedido, importe from resto where importe > 0")
def residual_by_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _residual(spark, sf_dir)


ZONES_SQL = """
filas as (
    select c.c_mktsegment as zona, cast(date_trunc('month', o.o_orderdate) as date) as fecha,
           o.o_orderkey, cast(round(o.o_totalprice * 100) as bigint) as importe
    from orders o join customer c on c.c_custkey = o.o_custkey
),
detalle as (
    select f.zona, f.fecha, 'Prioridad ' || o.o_orderpriority as destino,
           cast(sum(case when o.o_orderstatus <> 'P' then f.importe else 0 end) as bigint) as importe
    from filas f join orders o on o.o_orderkey = f.o_orderkey group by all
),
total as (select zona, fecha, cast(sum(importe) as bigint) as importe from filas group by all),
resto as (
    select t.zona, t.fecha, cast(greatest(t.importe - d.importe, 0) as bigint) as importe
    from total t join (select zona, fecha, sum(importe) as importe from detalle group by all) d
    using (zona, fecha)
),
miembros as (
    select fecha, destino, zona, true as desglosado, importe from detalle
    union all
    select fecha, upper(substr(zona, 1, 1)) || substr(zona, 2) || ' (no desglosado)', zona, false,
           importe
    from resto where importe > 0
)"""


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published totals per segment and month and the destinations (priorities) below them.

    Orders under revision are hidden in the destinations but counted in the totals, as a
    source does that keeps zone totals and suppresses members.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        month_of("o_orderdate").alias("fecha"),
        F.concat(F.lit("Prioridad "), "o_orderpriority").alias("destino"),
        cents("o_totalprice").alias("total"),
        F.when(F.col("o_orderstatus") != "P", cents("o_totalprice")).otherwise(0).alias("visible"),
    )
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("zona")
    )
    cells = shared(
        orders.join(customers, "c_custkey")
        .groupBy("fecha", "zona", "destino")
        .agg(F.sum("total").alias("total"), F.sum("visible").alias("visible"))
    )
    totals = cells.groupBy("fecha", "zona").agg(F.sum("total").alias("importe"))
    details = cells.select("fecha", "zona", "destino", F.col("visible").alias("importe"))
    return totals.select(
        "fecha", "zona", F.lit("total").alias("destino"), "importe", F.lit("total_zona").alias("tipo")
    ).unionByName(details.withColumn("tipo", F.lit("destino")))


def _members(rows: DataFrame) -> DataFrame:
    rest = rsd.residual(rows, ["fecha", "zona"], "tipo", "total_zona", "destino", ["importe"])
    return rsd.detail_and_residual(
        rows.filter(F.col("tipo") == "destino"),
        rest,
        ["fecha", "zona"],
        "destino",
        "zona",
        ["importe"],
        " (no desglosado)",
        "desglosado",
    )


@query("detail_plus_residual", f"with {ZONES_SQL} select * from miembros")
def detail_plus_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members(_zones(spark, sf_dir))


@query(
    "check_zone_totals",
    f"""with {ZONES_SQL},
    s as (select fecha, zona, sum(importe) as importe from miembros where destino not like '%1-URGENT'
          group by all)
    select t.fecha, t.zona from total t left join s using (fecha, zona)
    where abs(coalesce(s.importe, 0) - t.importe) > 0.5""",
)
def check_zone_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members without one priority: every total that had it stops balancing."""
    rows = _zones(spark, sf_dir)
    members = _members(rows).filter(~F.col("destino").endswith("1-URGENT"))
    totals = rows.filter(F.col("tipo") == "total_zona")
    return rsd.unbalanced_totals(members, totals, ["fecha", "zona"], ["importe"])


@query(
    "reconcile_sources",
    f"""with {MONEY_SQL},
    a as (select fecha, cast(sum(importe) as bigint) as i, cast(sum(pedidos) as bigint) as p
          from cabeceras group by fecha),
    b as (select fecha, cast(sum(importe) as bigint) as i, cast(sum(pedidos) as bigint) as p
          from detalles group by fecha)
    select count(*) as periodos, max(abs(a.i - b.i)) as dif_max_importe,
           count(*) filter (where abs(a.i - b.i) <= greatest(10, 0.0005::double * a.i)) as cuadran_importe,
           max(abs(a.p - b.p)) as dif_max_pedidos,
           count(*) filter (where abs(a.p - b.p) <= greatest(10, 0.0005::double * a.p)) as cuadran_pedidos
    from a join b using (fecha)""",
)
def reconcile_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers, details = monthly_money(spark, sf_dir)
    return rec.summary(headers, details, ["fecha"], ["importe", "pedidos"], ABSOLUTE, RELATIVE)


@query(
    "reconcile_exceptions",
    f"""with {MONEY_SQL},
    a as (select cast(year(fecha) * 100 + month(fecha) as integer) as fecha_id,
                 cast(sum(importe) as bigint) as i, cast(sum(pedidos) as bigint) as p
          from cabeceras group by all),
    b as (select cast(year(fecha) * 100 + month(fecha) as integer) as fecha_id,
                 cast(sum(importe) as bigint) as i, cast(sum(pedidos) as bigint) as p
          from detalles group by all),
    x as (
        select distinct cast(year(o_orderdate) * 100 + month(o_orderdate) as integer) as fecha_id,
               case when month(o_orderdate) <= 6 then 'importe' else 'pedidos' end as medida
        from orders where year(o_orderdate) = 1997
    ),
    largo as (
        select fecha_id, unnest(['importe', 'pedidos']) as medida, unnest([a.i, a.p]) as de_a,
               unnest([b.i, b.p]) as de_b
        from a join b using (fecha_id)
    ),
    malos as (
        select distinct fecha_id from (
            select * from largo anti join x using (fecha_id, medida)
        ) where abs(de_a - de_b) > greatest(10, 0.0005::double * de_a)
    )
    select fecha_id, a.i as importe_a, b.i as importe_b, a.p as pedidos_a, b.p as pedidos_b
    from malos join a using (fecha_id) join b using (fecha_id)""",
)
def reconcile_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that disagree, except those documented for the same measure."""
    headers, details = monthly_money(spark, sf_dir)
    headers = headers.withColumn("fecha_id", month_key("fecha"))
    details = details.withColumn("fecha_id", month_key("fecha"))
    noted = (
        table(spark, sf_dir, "orders")
        .filter(F.year("o_orderdate") == 1997)
        .select(
            month_key("o_orderdate").alias("fecha_id"),
            F.when(F.month("o_orderdate") <= 6, "importe").otherwise("pedidos").alias("medida"),
        )
        .distinct()
    )
    return rec.mismatches(
        headers, details, ["fecha_id"], ["importe", "pedidos"], ABSOLUTE, RELATIVE, noted
    )


@query(
    "residence_split_warn",
    f"""with {MONEY_SQL}
    select c.fecha, c.estado, cast(c.importe as bigint) as importe_a,
           cast(d.importe as bigint) as importe_b
    from cabeceras c join detalles d using (fecha, estado)
    where abs(c.importe - d.importe) > 0.05::double * c.importe""",
)
def residence_split_warn(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers, details = monthly_money(spark, sf_dir)
    drift = rec.share_drift(headers, details, ["fecha", "estado"], "importe", 0.05)
    return drift.select("fecha", "estado", "importe_a", "importe_b")
