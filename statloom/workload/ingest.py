"""Documents to rows: series documents, HTML tables and metadata, made from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.columns import cents, month_of, month_text
from statloom.operators.classify import DISCARDED, OUTCOME
from statloom.plans import catalogue as cat
from statloom.plans import fixed_values as fx
from statloom.sources.html import html_tables, typed
from statloom.sources.schemas import SERIES_DOCUMENT
from statloom.sources.series import observations
from statloom.workload import query
from statloom.workload.tables import table

BATCH = 64


@query(
    "explode_observations",
    f"""select 'U' || user_id as codigo, 'Serie ' || event_type as nombre_serie,
           cast(year(ts) as smallint) as anio, cast(day(ts) as smallint) as periodo,
           cast(1 + (event_id % 2) as smallint) as fk_tipo_dato,
           case when value > 300 then null else value end as valor,
           value > 300 as secreto,
           case when event_id % 3 = 0 then null when event_id % 3 = 1 then event_type
                else event_type || ' | k=' || json_extract_string(props, '$.k') end as notas,
           'events/U' || user_id || '_' || event_type || '_' || (event_id // {BATCH}) || '.json'
               as _fichero_origen,
           cast(ts as date) as _ingestado_en
    from events""",
)
def explode_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as series documents, read back through the declared schema.

    A document holds the events of one user, kind and day inside one block of event numbers,
    so its size is bounded whatever the share of a user.
    """
    events = table(spark, sf_dir, "events")
    note = F.struct(F.col("event_type").alias("texto"))
    key = F.from_json("props", "k bigint")["k"]
    second = F.struct(F.concat(F.lit("k="), key).alias("texto"))
    notes = (
        F.when(F.col("event_id") % 3 == 1, F.array(note))
        .when(F.col("event_id") % 3 == 2, F.array(note, second))
        .otherwise(F.lit(None))
    )
    secret = F.col("value") > 300
    observation = F.struct(
        (F.col("event_id") % 2 + 1).alias("FK_TipoDato"),
        F.dayofmonth("ts").cast("bigint").alias("FK_Periodo"),
        F.year("ts").cast("bigint").alias("Anyo"),
        F.when(~secret, F.col("value")).alias("Valor"),
        F.when(secret, F.lit(True)).alias("Secreto"),
        notes.alias("Notas"),
    )
    block = F.floor(F.col("event_id") / BATCH).cast("bigint")
    documents = events.groupBy(
        "user_id", "event_type", F.col("ts").cast("date").alias("dia"), block.alias("bloque")
    ).agg(F.collect_list(observation).alias("Data"))
    text = documents.select(
        F.concat_ws("_", F.concat(F.lit("U"), "user_id"), "event_type", "bloque").alias("f"),
        "dia",
        F.to_json(
            F.struct(
                F.concat(F.lit("U"), "user_id").alias("COD"),
                F.concat(F.lit("Serie "), "event_type").alias("Nombre"),
                "Data",
            )
        ).alias("json"),
    )
    parsed = text.select(
        F.from_json("json", SERIES_DOCUMENT, {"mode": "FAILFAST"}).alias("d"), "f", "dia"
    )
    rows = parsed.select("d.*", F.concat("f", F.lit(".json")).alias("fichero"), "dia")
    return observations(rows, F.lit("events"), F.col("dia"))


@query(
    "explode_properties",
    """select event_id, cast(json_extract(props, '$.k') as bigint) as k from events""",
)
def explode_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k bigint")["k"].alias("k")
    )


PAGE_COLUMNS = ["grupo", "pedidos", "importe", "nota"]


@query(
    "html_monthly_tables",
    """select strftime(o_orderdate, '%Y-%m') as mes, o_orderpriority || ' & más' as grupo,
           cast(count(*) as double) as pedidos,
           cast(sum(cast(round(o_totalprice * 100) as bigint)) as double) as importe,
           cast(null as double) as nota
    from orders group by all""",
)
def html_monthly_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per month with a table of order totals, parsed back into typed rows.

    A page holds one row per priority; blank separators and text that is not a number are
    part of the table, as in a published one.
    """
    cells = (
        table(spark, sf_dir, "orders")
        .groupBy(month_of("o_orderdate").alias("fecha"), "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("importe"))
    )

    def td(c: Column) -> Column:
        return F.concat(F.lit("<td>"), c, F.lit("</td>"))

    row = F.concat(
        F.lit("<tr>"),
        td(F.concat("o_orderpriority", F.lit(" &amp; <b>m&aacute;s</b>"))),
        td(F.col("n").cast("string")),
        td(F.format_number("importe", 0)),
        F.lit("<td>n.d.<tr><td>&nbsp;</td><td colspan='3'></td></tr>"),
    )
    head = "<html><body><p>x</p><table><tr><th rowspan=2>a</th><th colspan=3>b</th></tr>"
    head += "<tr><th>c</th><th>d</th><th>e</th></tr>"
    pages = cells.groupBy("fecha").agg(F.array_join(F.collect_list(row), "").alias("filas"))
    pages = pages.select(
        month_text("fecha").alias("mes"),
        F.concat(F.lit(head), "filas", F.lit("</table><table><tr><td>1</table>")).alias("html"),
    )
    rows = html_tables(pages, PAGE_COLUMNS, 2, ["mes"], "html")
    return typed(rows, PAGE_COLUMNS[1:]).filter(F.col("grupo").isNotNull()).drop("fila")


@query(
    "html_cells",
    """with l as (
        select page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) as t
        from pages
    )
    select page_id, cast(unnest(range(1, len(t) + 1)) as integer) as fila, unnest(t) as enlace from l""",
)
def html_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Navigation lists of whole raw pages, read as one-column tables."""
    html = F.col("html")
    for old, new in (
        ("<ul>", "<table>"),
        ("</ul>", "</table>"),
        ("<li>", "<tr><td>"),
        ("</li>", "</td></tr>"),
    ):
        html = F.replace(html, F.lit(old), F.lit(new))
    pages = table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    return html_tables(pages, ["enlace"], 0, ["page_id"], "html")


# --- classification of series metadata made from the parts ---------------------------

CONCEPTS = {
    "ECONOMY": "Viajero",
    "SMALL": "Pernoctaciones",
    "MEDIUM": "Personal empleado",
    "PROMO": "Número de plazas estimadas",
    "STANDARD": "Grado de ocupación por plazas",
    "LARGE": "Algo nuevo",
}


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata documents from parts: concept by type, the rest by size and key."""
    size, key = F.col("p_size"), F.col("p_partkey")
    tables = F.array(*[F.lit(t[0]) for t in fx.SOURCE_TABLES])

    def pair(variable: str, value: Column) -> Column:
        return F.struct(F.lit(variable).alias("T3_Variable"), value.alias("Nombre"))

    concept = F.lit(None).cast("string")
    for kind, name in CONCEPTS.items():
        concept = F.when(F.col("p_type") == kind, name).otherwise(concept)
    residence = (
        F.when(size % 4 == 0, "Total")
        .when(size % 4 == 1, "Residentes en España")
        .when(size % 4 == 2, "Residentes en el extranjero")
    )
    entries = F.array(
        pair("Provincias", F.when(key % 3 == 0, "Murcia").otherwise("Alicante")),
        pair("ZONAS TURÍSTICAS", F.when(key % 3 == 1, "Murcia (Región De): Costa Cálida")),
        pair(fx.CONCEPT, F.lit("anterior")),
        pair(fx.CONCEPT, concept),
        pair(fx.CATEGORY, F.when(size % 10 == 9, "Cinco estrellas").otherwise(fx.ALL_CATEGORIES)),
        pair(fx.RESIDENCE, residence),
        pair(fx.DATA_TYPE, F.when(size % 2 == 1, "Índice").otherwise("Dato")),
    )
    return table(spark, sf_dir, "part").select(
        F.element_at(tables, (key % len(fx.SOURCE_TABLES) + 1).cast("int")).alias("tabla_id"),
        key.alias("posicion"),
        F.concat(F.lit("P"), key).alias("COD"),
        F.col("p_name").alias("Nombre"),
        F.concat(F.lit(" "), "p_brand").alias("T3_Unidad"),
        F.filter(entries, lambda e: e["Nombre"].isNotNull()).alias("MetaData"),
    )


_VALUES = ", ".join(
    f"({i}, {t}, '{op}', '{kind}', '{fact}')" for i, (t, op, kind, fact) in enumerate(fx.SOURCE_TABLES)
)
_MEASURE = " ".join(
    f"when '{k}' then '{fx.MEASURES[v]}'" for k, v in CONCEPTS.items() if v in fx.MEASURES
)
CLASSIFY_SQL = f"""
tablas(orden, tabla_id, operacion, tipo_alojamiento, hecho) as (values {_VALUES}),
leidas as (
    select t.*, p_partkey, p_size, p_type, p_name, p_brand,
           case p_partkey % 3 when 0 then 'region-murcia' when 1 then 'costa-calida' end as territorio,
           case p_partkey % 3 when 0 then 'region' when 1 then 'zona' end as nivel_territorio,
           case p_size % 4 when 1 then 'espana' when 2 then 'extranjero' else '' end as residencia,
           case when hecho = 'precios' then case when p_size % 2 = 1 then 'indice_precios' end
                else case p_type {_MEASURE} end end as medida
    from part join tablas t on t.orden = p_partkey % {len(fx.SOURCE_TABLES)}
),
clasificadas as (
    select *, case when territorio is null or p_size % 10 = 9 or p_size % 4 = 0 then ''
                   when hecho = 'precios' and p_size % 2 = 0
                       then 'unknown data type in P' || p_partkey || ': Dato'
                   when hecho <> 'precios' and p_size % 2 = 1 then ''
                   when hecho <> 'precios' and medida is null
                       then 'unknown concept in P' || p_partkey || ': Algo nuevo' end as resultado
    from leidas
)"""


@query(
    "catalog_classify",
    f"""with {CLASSIFY_SQL}
    select 'P' || p_partkey as codigo, coalesce(resultado, 'clasificada') as resultado,
           case when resultado is null then territorio end as territorio,
           case when resultado is null then medida end as medida,
           case when resultado is null then residencia end as residencia
    from clasificadas""",
)
def catalog_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every series with its dimensions, or why it has none."""
    rows = cat.classify_series(_metadata(spark, sf_dir))
    fine = F.col(OUTCOME).isNull()
    return rows.select(
        F.col("COD").alias("codigo"),
        F.coalesce(OUTCOME, F.lit("clasificada")).alias("resultado"),
        *[F.when(fine, F.col(c)).alias(c) for c in ("territorio", "medida", "residencia")],
    )


@query(
    "series_catalogue",
    f"""with {CLASSIFY_SQL}
    select 'P' || p_partkey as codigo, operacion, cast(tabla_id as integer) as tabla_id, hecho,
           tipo_alojamiento, territorio, nivel_territorio, medida, residencia,
           p_brand as unidad, p_name as nombre_ine
    from clasificadas where resultado is null
    qualify row_number() over (
        partition by hecho, tipo_alojamiento, territorio, medida, residencia
        order by orden, p_partkey) = 1""",
)
def series_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue of the series whose values are known; with the others the build would stop."""
    metadata = _metadata(spark, sf_dir)
    odd = cat.classify_series(metadata).filter(F.col(OUTCOME) != DISCARDED).select("COD")
    return cat.series_catalogue(metadata.join(odd, "COD", "left_anti"))
