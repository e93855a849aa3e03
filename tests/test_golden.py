"""Hand-computed cases of the silver and gold rules."""

from __future__ import annotations

import datetime

import pytest

from statloom.operators.periods import published_periods
from statloom.plans import gold, silver
from statloom.sources.schemas import GOLD

M = silver.OCCUPANCY
MONTH = datetime.date(2019, 7, 1)


def classified(spark, *rows):
    data = [(MONTH, "costa", kind, *values) for kind, values in rows]
    return spark.createDataFrame(data, "fecha date, zona string, tipo_fila string, " + ", ".join(f"{m} bigint" for m in M))


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        # Destinations hidden as zero: the whole total is recovered.
        (
            [("destino", (0, 0, 0, 0)), ("destino", (0, 0, 0, 0)), ("total_zona", (5000, 1200, 24000, 8178))],
            [(5000, 1200, 24000, 8178)],
        ),
        # The zone balances: nothing is invented.
        (
            [("destino", (100, 10, 200, 20)), ("destino", (70, 7, 110, 11)), ("total_zona", (170, 17, 310, 31))],
            [],
        ),
        # More than the total: never negative.
        ([("destino", (120, 0, 300, 5)), ("total_zona", (100, 0, 300, 10))], [(0, 0, 0, 5)]),
        # A total without destinations.
        ([("total_zona", (1, 2, 3, 4))], [(1, 2, 3, 4)]),
        # Destinations without a total have no residual; other row types do not count.
        ([("destino", (1, 1, 1, 1)), ("subtotal", (9, 9, 9, 9))], []),
        # An unknown total is not a residual.
        ([("destino", (1, 1, 1, 1)), ("total_zona", (None, 5, None, None))], [(0, 4, 0, 0)]),
    ],
)
def test_residual(spark, rows, expected):
    out = silver.residual_by_zone(classified(spark, *rows))
    assert [tuple(r[m] for m in M) for r in out.collect()] == expected


def test_members_reproduce_the_total(spark, rows):
    df = classified(spark, ("destino", (1, 1, 1, 1)), ("total_zona", (3, 1, 1, 1))).selectExpr("*", "'D' as destino")
    out = silver.destination_occupancy(df, silver.residual_by_zone(df))
    assert rows(out, "destino", "desglosado", "viajeros_residentes") == [
        {"destino": "Costa (no desglosado)", "desglosado": False, "viajeros_residentes": 2},
        {"destino": "D", "desglosado": True, "viajeros_residentes": 1},
    ]


def test_all_zero_month_is_not_published(spark):
    april, july = datetime.date(2020, 4, 1), datetime.date(2020, 7, 1)
    df = spark.createDataFrame(
        [(april, 0, 0, 0, 0), (april, None, 0, 0, 0), (july, 0, 0, 0, 0), (july, 100, 10, 200, None)],
        "fecha date, " + ", ".join(f"{m} bigint" for m in M),
    )
    assert [r.fecha for r in published_periods(df, "fecha", M).collect()] == [july]


def test_series_masks_and_flags(spark, rows):
    df = spark.createDataFrame(
        [
            ("S", 2024, 1, 1, 1000.0, False),
            ("S", 2024, 2, 1, 0.0, True),
            ("S", 2026, 8, 2, 500.0, False),
        ],
        "codigo string, anio smallint, periodo smallint, fk_tipo_dato smallint, valor double, secreto boolean",
    ).selectExpr("*", "cast(null as string) notas", "current_date() _ingestado_en")
    out = silver.series_observations(df)
    assert rows(out, "mes", "valor", "es_secreto", "es_provisional") == [
        {"mes": 1, "valor": 1000.0, "es_secreto": False, "es_provisional": False},
        {"mes": 2, "valor": None, "es_secreto": True, "es_provisional": False},
        {"mes": 8, "valor": 500.0, "es_secreto": False, "es_provisional": True},
    ]


OBS = (
    "fecha date, hecho string, territorio string, tipo_alojamiento string, residencia string, "
    "medida string, valor double, es_provisional boolean, es_secreto boolean"
)


def test_demand_joins_both_sources_and_splits_residence(spark, rows):
    august = datetime.date(2024, 8, 1)
    observations = spark.createDataFrame(
        [
            (august, "demanda", "region-murcia", "camping", "espana", "viajeros", 100.0, False, False),
            (august, "demanda", "region-murcia", "camping", "espana", "pernoctaciones", 400.0, False, False),
            (august, "demanda", "costa-calida", "rural", "extranjero", "viajeros", None, True, True),
            (august, "demanda", "costa-calida", "rural", "extranjero", "pernoctaciones", None, True, True),
            (august, "oferta", "costa-calida", "rural", None, "plazas", 9.0, True, True),
        ],
        OBS,
    )
    occupancy = spark.createDataFrame(
        [(MONTH, "La Manga", 21262, 4788, 90856, 26407), (MONTH, "Otro", 1, 1, 1, 1)],
        "fecha date, destino string, " + ", ".join(f"{m} bigint" for m in M),
    )
    territories = spark.createDataFrame(
        [("destino-la-manga", "murciaturistica", "La Manga")],
        "territorio_id string, fuente string, nombre_en_fuente string",
    )
    out = gold.demand(observations, occupancy, territories)
    assert out.columns == GOLD["fct_demanda_mensual"].names
    assert [tuple(r.values()) for r in rows(out, "fecha_id", "residencia_id", "viajeros", "pernoctaciones", "fuente")] == [
        (201907, "espana", 21262, 90856, "murciaturistica"),
        (201907, "extranjero", 4788, 26407, "murciaturistica"),
        (202408, "espana", 100, 400, "INE"),
    ]


def test_supply_row_needs_a_published_measure(spark):
    observations = spark.createDataFrame(
        [
            (MONTH, "oferta", "region-murcia", "hotel", None, "plazas", 10.0, False, False),
            (MONTH, "oferta", "region-murcia", "hotel", None, "ocupacion_plazas", 55.5, True, False),
            (MONTH, "oferta", "region-murcia", "rural", None, "plazas", None, False, True),
        ],
        OBS,
    )
    (row,) = gold.supply(observations).collect()
    assert (row.tipo_alojamiento_id, row.plazas, row.ocupacion_plazas, row.parcelas) == ("hotel", 10, 55.5, None)
    assert (row.es_provisional, row.tiene_secreto) == (True, False)


def test_prices_keep_rows_with_any_measure(spark):
    observations = spark.createDataFrame(
        [
            (MONTH, "precios", "espana", "hotel", None, "variacion_interanual_precios", -1.5, False, False),
            (MONTH, "precios", "region-murcia", "hotel", None, "indice_precios", None, False, False),
        ],
        OBS,
    )
    (row,) = gold.prices(observations).collect()
    assert (row.territorio_id, row.indice_precios, row.variacion_interanual) == ("espana", None, -1.5)


def test_calendar_has_every_month(spark, rows):
    a = spark.createDataFrame([(datetime.date(2019, 11, 1),), (None,)], "fecha date")
    b = spark.createDataFrame([(datetime.date(2020, 2, 1),)], "fecha date")
    out = gold.calendar(a, b)
    assert out.schema.simpleString() == GOLD["dim_fecha"].simpleString()
    assert [(r["fecha_id"], r["trimestre"], r["nombre_mes"]) for r in rows(out)] == [
        (201911, 4, "noviembre"),
        (201912, 4, "diciembre"),
        (202001, 1, "enero"),
        (202002, 1, "febrero"),
    ]
