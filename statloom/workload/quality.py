"""Quality checks, contracts, fingerprints and parity over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.operators import fingerprint as fp
from statloom.operators import quality as q
from statloom.sources.schemas import DT, L, S
from statloom.sources.schemas import table as contract
from statloom.sources.store import register
from statloom.workload import query
from statloom.workload.tables import TABLES, table

TODAY = "2002-03-15"


@query(
    "check_grain",
    """select l_orderkey, l_linenumber, count(*) as filas from lineitem
    group by l_orderkey, l_linenumber having count(*) > 1""",
)
def check_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.check_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_unique",
    """select p_name, count(*) as filas from part where p_name is not null
    group by p_name having count(*) > 1""",
)
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.check_unique_values(table(spark, sf_dir, "part"), "p_name")


@query(
    "check_not_null",
    """select d.doc_id, l.quality from documents d left join labels l on l.doc_id = d.doc_id
    where l.quality is null""",
)
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = (
        table(spark, sf_dir, "documents")
        .select("doc_id")
        .join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    )
    return q.check_not_null(joined, "quality")


@query(
    "check_accepted",
    """select source, count(*) as filas from documents
    where source not in ('src0', 'src1', 'src2', 'src3', 'src4', 'src5') group by source""",
)
def check_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return q.check_accepted(docs, "source", [f"src{i}" for i in range(6)])


@query(
    "check_nonnegative",
    """select c_custkey, c_mktsegment, c_acctbal from customer
    where c_mktsegment <> 'MACHINERY' and c_acctbal < 0""",
)
def check_nonnegative(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return q.check_non_negative(rows, "c_acctbal", F.col("c_mktsegment") != "MACHINERY")


@query(
    "check_percent",
    """select 'precio' as prueba, count(*) as fallos from (
        select 100 * l_quantity / 45 as pct from lineitem) where pct < 0 or pct > 100""",
)
def check_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") * 100 / 45).alias("pct"))
    return q.rule_failures(rows, {"precio": q.is_out_of_range("pct", 0, 100)})


@query(
    "check_range_rows",
    """select o_orderkey, o_totalprice from orders where o_totalprice < 2000 or o_totalprice > 490000""",
)
def check_range_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return q.check_range(rows, "o_totalprice", 2000, 490000)


@query(
    "check_relationship",
    """select o_orderkey, count(*) as filas from orders
    where not exists (select 1 from lineitem where l_orderkey = o_orderkey) group by o_orderkey""",
)
def check_relationship(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return q.check_relationship(table(spark, sf_dir, "orders"), "o_orderkey", lines, "l_orderkey")


@query(
    "missing_keys",
    """select o_orderkey from orders
    where not exists (select 1 from lineitem where l_orderkey = o_orderkey)
    order by o_orderkey limit 10""",
)
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected keys without data, as a short ordered sample."""
    lines = table(spark, sf_dir, "lineitem")
    absent = q.missing_keys(table(spark, sf_dir, "orders"), "o_orderkey", lines, "l_orderkey")
    return q.sample_of(absent, "o_orderkey")


@query(
    "unmapped_labels",
    """select distinct p_name from part p
    where not exists (select 1 from part x where x.p_size > 48 and x.p_name = p.p_name)""",
)
def unmapped_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    mapped = parts.filter(F.col("p_size") > 48)
    return q.missing_keys(parts, "p_name", mapped)


@query(
    "check_freshness",
    f"""with u as (select cast(max(l_shipdate) as date) as ultimo_mes from lineitem),
    m as (
        select ultimo_mes, cast((year(date '{TODAY}') - year(ultimo_mes)) * 12
               + month(date '{TODAY}') - month(ultimo_mes) as integer) as meses_de_retraso from u
    )
    select *, meses_de_retraso <= 4 as vigente from m""",
)
def check_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    today = F.lit(TODAY).cast("date")
    return q.freshness(table(spark, sf_dir, "lineitem"), "l_shipdate", today)


@query(
    "quality_report",
    """with r as (
        select 'clave de cliente' as prueba, 'error' as gravedad, count(*) as fallos
        from orders where o_custkey is null
        union all
        select 'precio negativo', 'error', count(*) from orders where o_totalprice < 0
        union all
        select 'estado', 'error', count(*) from orders where o_orderstatus not in ('F', 'O')
        union all
        select 'grano', 'error', count(*) from (
            select 1 from orders group by o_orderkey having count(*) > 1)
        union all
        select 'pedidos sin lineas', 'warn', count(*) from orders
        where not exists (select 1 from lineitem where l_orderkey = o_orderkey)
    )
    select *, fallos = 0 as superada from r""",
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row rules in one scan, key checks next to them, one report line each."""
    orders = table(spark, sf_dir, "orders")
    rules = {
        "clave de cliente": q.is_missing("o_custkey"),
        "precio negativo": q.is_negative("o_totalprice"),
        "estado": q.is_outside("o_orderstatus", ("F", "O")),
    }
    lines = table(spark, sf_dir, "lineitem")
    keys = [
        q.Check("grano", q.check_unique(orders, ["o_orderkey"])),
        q.Check(
            "pedidos sin lineas",
            q.check_relationship(orders, "o_orderkey", lines, "l_orderkey"),
            q.WARN,
        ),
    ]
    return q.rules_report(orders, rules).unionByName(q.quality_report(keys))


# Numeric columns per table, written out for the SQL side only; fractions are marked.
NUMERIC = {
    "region": "r_regionkey",
    "nation": "n_nationkey n_regionkey",
    "customer": "c_custkey c_nationkey c_acctbal*",
    "supplier": "s_suppkey s_nationkey s_acctbal*",
    "part": "p_partkey p_size p_retailprice*",
    "orders": "o_orderkey o_custkey o_totalprice*",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity* l_extendedprice* "
    "l_discount* l_tax*",
    "events": "event_id user_id value*",
    "documents": "doc_id n_chars",
    "embeddings": "vec_id label",
    "pages": "page_id",
    "benchmark": "item_id",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn",
}


def _fingerprint_sql(name: str, where: str = "") -> str:
    cells = [("filas", "count(*)")]
    for c in NUMERIC[name].split():
        n = c.rstrip("*")
        if n == c:
            cells.append((f"suma_{n}", f"round(sum({n}), 4)"))
        else:
            cells.append((f"suma_{n}", f"round(fsum({n}), 4)"))
            cells.append((f"no_finitos_{n}", f"count(*) filter (where not isfinite({n}))"))
    values = ", ".join(f"cast({sql} as double)" for _, sql in cells)
    names = ", ".join(f"'{n}'" for n, _ in cells)
    return (
        f"select '{name}' as tabla, unnest([{names}]) as medida, unnest([{values}]) as valor "
        f"from {name} {where}"
    )


@query("table_fingerprint", " union all ".join(_fingerprint_sql(t) for t in TABLES))
def table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp.fingerprints({t: table(spark, sf_dir, t) for t in TABLES})


PARITY_TABLES = ("orders", "customer", "part")


@query(
    "parity_diff",
    f"""with a as ({" union all ".join(_fingerprint_sql(t) for t in PARITY_TABLES)}),
    b as (
        {_fingerprint_sql("orders", "where o_orderkey > (select min(o_orderkey) from orders)")}
        union all {_fingerprint_sql("customer")} union all {_fingerprint_sql("part")}
    )
    select tabla, medida, a.valor as valor_a, b.valor as valor_b
    from a full join b using (tabla, medida)
    where a.valor is distinct from b.valor""",
)
def parity_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table set against a copy that lost one row."""
    full = {t: table(spark, sf_dir, t) for t in PARITY_TABLES}
    first = full["orders"].agg(F.min("o_orderkey")).scalar()
    return fp.parity(full, {**full, "orders": full["orders"].filter(F.col("o_orderkey") > first)})


def _contract_sql(name: str) -> str:
    return (
        f"select '{name}' as tabla, cast(row_number() over () as integer) as posicion, "
        f"column_name as nombre, column_type as tipo, (select count(*) from {name}) as filas "
        f"from (describe {name})"
    )


@query("contract_document", " union all ".join(_contract_sql(t) for t in TABLES))
def contract_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp.contract_rows({t: table(spark, sf_dir, t) for t in TABLES})


@query(
    "enforce_contract",
    """select o_orderkey as pedido, o_custkey as cliente, cast(o_orderdate as date) as fecha, o_orderstatus as estado,
           cast(round(o_totalprice * 100) as bigint) as centimos from orders""",
)
def enforce_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A growing fact brought to its declared columns and order; any other column would stop it, and so
    would a NULL in a required one."""
    declared = contract(
        (L, "pedido", "cliente"), (DT, "fecha"), (S, "estado"), (L, "centimos"), required=("pedido", "cliente", "fecha")
    )
    return q.enforce(
        table(spark, sf_dir, "orders").select(
            F.round(F.col("o_totalprice") * 100).cast("bigint").alias("centimos"), F.col("o_orderdate").cast("date").alias("fecha"),
            F.col("o_custkey").alias("cliente"), F.col("o_orderkey").alias("pedido"), F.col("o_orderstatus").alias("estado"),
        ),
        declared,
    )


@query(
    "registered_view",
    """select c_nationkey, count(*) as clientes, sum(cast(round(c_acctbal * 100) as bigint))::bigint as saldo
    from customer group by c_nationkey""",
)
def registered_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet files registered under a name and read with SQL."""
    register(spark, f"{sf_dir}/customer.parquet", "clientes_registrados")
    return spark.sql(
        """SELECT c_nationkey, count(*) AS clientes, sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS saldo
        FROM clientes_registrados GROUP BY c_nationkey"""
    )
