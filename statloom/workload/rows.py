"""Projections, filters, joins and reshaping over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions import columns as col
from statloom.operators import indicators as ind
from statloom.operators import periods as per
from statloom.operators import reshape as res
from statloom.operators.staging import shared
from statloom.plans.fixed_values import MONTH_NAMES
from statloom.workload import query
from statloom.workload.tables import cents, table

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query(
    "mask_and_flags",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           case when l_returnflag = 'N' then null else l_quantity end as valor,
           l_returnflag = 'N' as es_secreto,
           ascii(l_linestatus) = 79 as es_provisional,
           l_linestatus <> 'F' or l_returnflag not like '%R' as es_desglosado
    from lineitem""",
)
def mask_and_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    secret = F.col("l_returnflag") == "N"
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        col.mask_secret("l_quantity", secret).alias("valor"),
        secret.alias("es_secreto"),
        col.is_code(F.ascii("l_linestatus"), 79).alias("es_provisional"),
        col.is_broken_down("l_linestatus", "l_returnflag", "F", "R").alias("es_desglosado"),
    )


@query(
    "label_marker_split",
    r"""with t as (
        select p_partkey, p_name || case p_size % 4 when 0 then '' when 1 then ' *'
               when 2 then '#' else ' *# ' end as publicado from part
    )
    select p_partkey, publicado, trim(regexp_replace(publicado, ' *[*#]+$', '')) as etiqueta,
           regexp_matches(publicado, '[*#] *$') as tiene_llamada,
           upper(substr(publicado, 1, 1)) || substr(publicado, 2) || ' (resto)' as generada
    from t""",
)
def label_marker_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size") % 4
    mark = F.when(size == 0, "").when(size == 1, " *").when(size == 2, "#").otherwise(" *# ")
    labels = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat("p_name", mark).alias("publicado")
    )
    label, marked = col.split_marker("publicado")
    return labels.select(
        "p_partkey",
        "publicado",
        label.alias("etiqueta"),
        marked.alias("tiene_llamada"),
        col.capitalised("publicado", " (resto)").alias("generada"),
    )


@query(
    "project_and_tag",
    """with t as (
        select cast(o_orderkey as bigint) as pedido, cast(year(o_orderdate) as smallint) as anio,
               cast(month(o_orderdate) as smallint) as mes,
               cast(quarter(o_orderdate) as smallint) as trimestre,
               cast(year(o_orderdate) * 100 + month(o_orderdate) as integer) as fecha_id,
               nullif(case when o_orderstatus = 'P' then '' else o_orderstatus end, '') as estado,
               case when o_orderpriority = '1-URGENT' then o_totalprice end as urgente,
               case when o_orderstatus = 'F' then o_totalprice end as cerrado,
               cast(round_even(o_totalprice / 4, 0) as bigint) as cuarto,
               'pedidos' as fuente
        from orders
    )
    select *, printf('%d-%02d', fecha_id // 100, fecha_id % 100) as mes_texto,
           case when estado = 'F' then 'cerrado' when estado = 'O' then 'abierto' else 'resto' end
               as grupo
    from t where urgente is not null or cerrado is not null""",
)
def project_and_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, date = F.col("o_totalprice"), F.col("o_orderdate")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("pedido"),
        F.year(date).cast("smallint").alias("anio"),
        F.month(date).cast("smallint").alias("mes"),
        F.quarter(date).cast("smallint").alias("trimestre"),
        col.month_key(date).alias("fecha_id"),
        col.blank_to_null(
            F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
        ).alias("estado"),
        F.when(F.col("o_orderpriority") == "1-URGENT", price).alias("urgente"),
        F.when(F.col("o_orderstatus") == "F", price).alias("cerrado"),
        col.to_count(price / 4).alias("cuarto"),
        F.lit("pedidos").alias("fuente"),
    )
    return rows.filter(col.any_published("urgente", "cerrado")).select(
        "*",
        col.key_text("fecha_id").alias("mes_texto"),
        col.label_by("estado", {"F": "cerrado", "O": "abierto"}, "resto").alias("grupo"),
    )


@query(
    "classify_join",
    """select o.o_orderkey, c.c_mktsegment, n.n_name, r.r_name
    from orders o
    join customer c on c.c_custkey = o.o_custkey
    join nation n on n.n_nationkey = c.c_nationkey
    join region r on r.r_regionkey = n.n_regionkey and r.r_name = 'EUROPE'
    where o.o_orderstatus = 'F'""",
)
def classify_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension is filtered before the join; facts keep only rows that it classifies."""
    regions = table(spark, sf_dir, "region").filter(F.col("r_name") == "EUROPE")
    nations = table(spark, sf_dir, "nation").join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_mktsegment", "n_name", "r_name"
    )


@query(
    "published_periods",
    """with t as (
        select user_id, cast(ts as date) as dia, event_type,
               case when (user_id + day(ts)) % 7 = 0 then 0 else value end as valor
        from events
    ),
    publicados as (
        select user_id, dia from t group by user_id, dia having sum(coalesce(valor, 0)) > 0
    )
    select t.* from t join publicados using (user_id, dia)""",
)
def published_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("ts").cast("date")
    silent = (F.col("user_id") + F.dayofmonth("ts")) % 7 == 0
    rows = table(spark, sf_dir, "events").select(
        "user_id",
        day.alias("dia"),
        "event_type",
        F.when(silent, F.lit(0.0)).otherwise(F.col("value")).alias("valor"),
    )
    return per.keep_published(rows, ["user_id", "dia"], ["valor"])


@query(
    "pivot_measures",
    """with t as (
        select user_id, cast(ts as date) as dia, event_type, value,
               value > 200 as alto from events
    )
    select user_id, dia, max(value) filter (where event_type = 'click') as click,
           max(value) filter (where event_type = 'error') as error,
           max(value) filter (where event_type = 'purchase') as purchase,
           max(value) filter (where event_type = 'signup') as signup,
           max(value) filter (where event_type = 'view') as view,
           count(value) as publicadas, bool_or(alto) as tiene_alto
    from t group by user_id, dia having count(value) > 0""",
)
def pivot_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "user_id",
        F.col("ts").cast("date").alias("dia"),
        "event_type",
        "value",
        (F.col("value") > 200).alias("alto"),
    )
    wide = res.pivot_measures(
        rows, ["user_id", "dia"], "event_type", "value", EVENT_TYPES, {"tiene_alto": "alto"}, "publicadas"
    )
    return wide.filter("publicadas > 0")


@query(
    "unpivot_breakdown",
    """with t as (
        select o_custkey, count(*) filter (where o_orderstatus = 'F') as pedidos_f,
               count(*) filter (where o_orderstatus <> 'F') as pedidos_x,
               cast(sum(case when o_orderstatus = 'F'
                   then cast(round(o_totalprice * 100) as bigint) end) as bigint) as importe_f,
               cast(sum(case when o_orderstatus <> 'F'
                   then cast(round(o_totalprice * 100) as bigint) end) as bigint) as importe_x
        from orders group by o_custkey
    )
    select o_custkey, 'cerrado' as estado, pedidos_f as pedidos, importe_f as importe from t
    union all
    select o_custkey, 'abierto', pedidos_x, importe_x from t""",
)
def unpivot_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = F.col("o_orderstatus") == "F"
    wide = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count_if(closed).alias("pedidos_f"),
            F.count_if(~closed).alias("pedidos_x"),
            F.sum(F.when(closed, cents("o_totalprice"))).alias("importe_f"),
            F.sum(F.when(~closed, cents("o_totalprice"))).alias("importe_x"),
        )
    )
    breakdown = {
        "cerrado": {"pedidos": "pedidos_f", "importe": "importe_f"},
        "abierto": {"pedidos": "pedidos_x", "importe": "importe_x"},
    }
    return res.unpivot_breakdown(wide, ["o_custkey"], breakdown, "estado")


MONTH_CASE = "case mes " + " ".join(
    f"when {i} then '{n}'" for i, n in enumerate(MONTH_NAMES, 1)
) + " end"


@query(
    "month_dimension",
    f"""with limites as (
        select least((select min(cast(o_orderdate as date)) from orders),
                     (select min(cast(l_shipdate as date)) from lineitem)) as a,
               greatest((select max(cast(o_orderdate as date)) from orders),
                        (select max(cast(l_shipdate as date)) from lineitem)) as b
    ),
    m as (
        select unnest(generate_series(date_trunc('month', a)::date, date_trunc('month', b)::date,
                                      interval 1 month))::date as fecha from limites
    ),
    d as (
        select cast(year(fecha) * 100 + month(fecha) as integer) as fecha_id, fecha,
               cast(year(fecha) as smallint) as anio, cast(month(fecha) as smallint) as mes,
               cast(quarter(fecha) as smallint) as trimestre
        from m
    )
    select *, {MONTH_CASE} as nombre_mes from d""",
)
def month_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = [
        (table(spark, sf_dir, t).select(col.month_of(c).alias("fecha")), "fecha")
        for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
    ]
    return per.month_dimension(dates, MONTH_NAMES)


@query(
    "hierarchy_dimension",
    """with h as (
        select 'r' || r_regionkey as id, r_name as nombre, 'region' as nivel,
               cast(null as varchar) as padre_id from region
        union all
        select 'n' || n_nationkey, n_name, 'pais', 'r' || n_regionkey from nation
        union all
        select 'c' || c_custkey, c_name, 'cliente', 'n' || c_nationkey from customer
    )
    select a.id, a.nombre, a.nivel, a.padre_id, p.nombre as padre,
           case a.padre_id when 'r0' then 'africa' when 'r1' then 'america' else 'otros' end as grupo,
           a.nivel <> 'cliente' or a.nombre not like '%0' as es_desglosado
    from h a left join h p on p.id = a.padre_id""",
)
def hierarchy_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    def level(name: str, mark: str, key: str, label: str, parent) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(mark), F.col(key)).alias("id"),
            F.col(label).alias("nombre"),
            F.lit({"r": "region", "n": "pais", "c": "cliente"}[mark]).alias("nivel"),
            parent.alias("padre_id"),
        )

    members = (
        level("region", "r", "r_regionkey", "r_name", F.lit(None).cast("string"))
        .unionByName(
            level("nation", "n", "n_nationkey", "n_name", F.concat(F.lit("r"), "n_regionkey"))
        )
        .unionByName(
            level("customer", "c", "c_custkey", "c_name", F.concat(F.lit("n"), "c_nationkey"))
        )
    )
    # Only inner levels can be parents, so the leaves stay out of the build side.
    parents = members.filter(F.col("nivel") != "cliente")
    family = res.with_parent(members, parents, "id", "padre_id", {"padre": "nombre"})
    return family.select(
        "*",
        col.label_by("padre_id", {"r0": "africa", "r1": "america"}, "otros").alias("grupo"),
        col.is_broken_down("nivel", "nombre", "cliente", "0").alias("es_desglosado"),
    )


@query(
    "small_dimensions",
    """select distinct 'segmento' as dimension, c_mktsegment as nombre from customer
    union all
    select distinct 'tipo', p_type from part""",
)
def small_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    def members(name: str, dimension: str, column: str) -> DataFrame:
        rows = table(spark, sf_dir, name).select(
            F.lit(dimension).alias("dimension"), F.col(column).alias("nombre")
        )
        return rows.distinct()

    return members("customer", "segmento", "c_mktsegment").unionByName(
        members("part", "tipo", "p_type")
    )


@query(
    "first_occurrence",
    """select p_brand, p_type, p_partkey, p_name, p_size from part
    qualify row_number() over (partition by p_brand, p_type order by p_size, p_partkey) = 1""",
)
def first_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        "p_brand", "p_type", "p_partkey", "p_name", "p_size"
    )
    return res.first_occurrence(parts, ["p_brand", "p_type"], ["p_size", "p_partkey"])


@query(
    "consecutive_runs",
    """with d as (
        select distinct user_id, event_type,
               cast(date_diff('day', date '1970-01-01', cast(ts as date)) as bigint) as p
        from events
    ),
    i as (select *, p - row_number() over (partition by user_id, event_type order by p) as g from d)
    select user_id, event_type, min(p) as start, max(p) as "end", max(p) - min(p) + 1 as length
    from i group by user_id, event_type, g""",
)
def consecutive_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.unix_date(F.col("ts").cast("date")).alias("dia")
    )
    return per.consecutive_runs(days, ["user_id", "event_type"], "dia")


@query(
    "consecutive_turns",
    """with i as (
        select distinct conv_id, role, turn,
               turn - dense_rank() over (partition by conv_id, role order by turn) as g
        from conversations
    )
    select conv_id, role, min(turn) as start, max(turn) as "end",
           max(turn) - min(turn) + 1 as length from i group by conv_id, role, g""",
)
def consecutive_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs over blocks of two positions: the joining step does most of the work."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "role", "turn")
    return per.consecutive_runs(turns, ["conv_id", "role"], "turn", block=2)


@query(
    "provisional_band",
    """select cast(date_trunc('month', min(o_orderdate)) as date) as desde,
           cast(date_trunc('month', max(o_orderdate)) + interval 1 month as date) as hasta
    from orders where o_orderstatus = 'P'""",
)
def provisional_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = table(spark, sf_dir, "orders").select(
        col.month_of("o_orderdate").alias("fecha"), (F.col("o_orderstatus") == "P").alias("p")
    )
    return per.provisional_band(months, "fecha", "p")


@query(
    "coverage_metadata",
    """select strftime(min(o_orderdate), '%Y-%m') as primer_mes,
           strftime(max(o_orderdate) filter (where o_orderpriority = '1-URGENT'), '%Y-%m') as "ultimo_mes_1-URGENT",
           strftime(max(o_orderdate) filter (where o_orderpriority = '5-LOW'), '%Y-%m') as "ultimo_mes_5-LOW",
           strftime(min(o_orderdate) filter (where o_orderstatus = 'P'), '%Y-%m') as provisional_desde
    from orders""",
)
def coverage_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("fecha"),
        F.col("o_orderpriority").alias("fuente"),
        (F.col("o_orderstatus") == "P").alias("p"),
    )
    return ind.coverage(rows, "fecha", "fuente", ["1-URGENT", "5-LOW"], "p")


@query(
    "period_text",
    """select strftime(min(l_shipdate), '%Y-%m') as desde, strftime(max(l_shipdate), '%Y-%m') as hasta
    from lineitem""",
)
def period_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "lineitem").select(col.month_key("l_shipdate").alias("fecha_id"))
    return ind.period_text(keys, "fecha_id")


@query(
    "personnel_series",
    """with f as (
        select n.n_name as grupo, cast(date_trunc('month', l.l_shipdate) as date) as fecha,
               count(distinct l.l_suppkey) as personal
        from lineitem l join supplier s on s.s_suppkey = l.l_suppkey
        join nation n on n.n_nationkey = s.s_nationkey
        group by all
    )
    select grupo, strftime(fecha, '%Y-%m') as mes_texto, cast(year(fecha) as smallint) as anio,
           cast(month(fecha) as smallint) as mes, personal from f""",
)
def personnel_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active suppliers per nation and month.

    Pairs of supplier and month are made distinct before the dimension join, so the join and
    the second count see one row per supplier and month.
    """
    active = (
        table(spark, sf_dir, "lineitem")
        .select(col.month_of("l_shipdate").alias("fecha"), F.col("l_suppkey").alias("s_suppkey"))
        .distinct()
    )
    places = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    fact = shared(
        active.join(places.select("s_suppkey", "n_name"), "s_suppkey")
        .groupBy(F.col("n_name").alias("grupo"), "fecha")
        .agg(F.count(F.lit(1)).alias("personal"))
    )
    calendar = per.month_dimension([(fact, "fecha")], MONTH_NAMES)
    fact = fact.withColumn("fecha_id", col.month_key("fecha")).drop("fecha")
    return ind.measure_series(fact, calendar, "grupo", ["personal"], parts=["anio", "mes"])


@query(
    "price_series",
    """with f as (
        select p.p_type as grupo, cast(date_trunc('month', l.l_shipdate) as date) as fecha,
               sum(cast(round(l.l_extendedprice * 100) as bigint)) as importe,
               cast(sum(l.l_quantity) as bigint) as unidades
        from lineitem l join part p on p.p_partkey = l.l_partkey group by all
    )
    select grupo, strftime(fecha, '%Y-%m') as mes_texto,
           cast(importe as double) / nullif(cast(unidades as double), 0) as indice,
           cast(unidades as bigint) as unidades from f""",
)
def price_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean unit price in cents per part type and month."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"), col.month_of("l_shipdate").alias("fecha"))
        .agg(
            F.sum(cents("l_extendedprice")).alias("importe"), F.sum("l_quantity").alias("unidades")
        )
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("grupo"))
    fact = (
        lines.join(parts, "p_partkey")
        .groupBy("grupo", "fecha")
        .agg(F.sum("importe").alias("importe"), F.sum("unidades").cast("bigint").alias("unidades"))
    )
    return fact.select(
        "grupo",
        col.month_text("fecha").alias("mes_texto"),
        col.ratio(F.col("importe"), F.col("unidades")).alias("indice"),
        "unidades",
    )


@query(
    "month_lag",
    """select l_orderkey, l_linenumber, l_partkey,
           cast((year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate)
               as integer) as meses
    from lineitem join orders on o_orderkey = l_orderkey""",
)
def month_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months between order and shipment."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
    )
    return lines.join(orders, "l_orderkey").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        col.month_gap("l_shipdate", "o_orderdate").alias("meses"),
    )


@query(
    "group_shares",
    """with t as (
        select o_orderpriority as grupo, o_orderstatus as estado, count(*) as pedidos
        from orders group by all
    )
    select grupo, estado, pedidos, 100 * cast(pedidos as double)
           / sum(pedidos) over (partition by grupo) as pct from t""",
)
def group_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("grupo"), F.col("o_orderstatus").alias("estado"))
        .agg(F.count(F.lit(1)).alias("pedidos"))
    )
    return ind.share_of_group(counts, "grupo", "pedidos", "pct")
