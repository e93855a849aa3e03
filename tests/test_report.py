"""Indicators over a small star schema whose answers are known.

Hotels sleep 100·month nights per residence and campings 50, from January 2019 to June 2020;
campings miss April 2020. Two destinations share out the hotels exactly, but report 100 more
people per residence in January 2019.
"""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from statloom.operators.staging import shared
from statloom.plans import indicators

PARTS = ("espana", "extranjero")


@pytest.fixture(scope="module")
def tables(spark):
    months = [(y, m) for y in (2019, 2020) for m in range(1, 13) if (y, m) <= (2020, 6)]
    demand = []
    for y, m in months:
        key = y * 100 + m
        for part in PARTS:
            extra = 100 if key == 201901 else 0
            demand += [
                (key, "region-murcia", "hotel", part, 40 * m, 100 * m, key >= 202006, "INE"),
                (key, "destino-la-manga", "hotel", part, 25 * m + extra, 60 * m, False, "murciaturistica"),
                (key, "destino-murcia-ciudad", "hotel", part, 15 * m, 40 * m, False, "murciaturistica"),
            ]
            if key != 202004:
                demand.append((key, "region-murcia", "camping", part, 20, 50, False, "INE"))
    make = spark.createDataFrame
    return {
        "dim_fecha": make(
            [(y * 100 + m, datetime.date(y, m, 1), y, m) for y, m in months],
            "fecha_id int, fecha date, anio smallint, mes smallint",
        ),
        "dim_territorio": make(
            [
                ("region-murcia", None),
                ("destino-la-manga", "zona-costa"),
                ("destino-murcia-ciudad", "zona-ciudad"),
            ],
            "territorio_id string, padre_id string",
        ),
        "fct_demanda_mensual": make(
            demand,
            "fecha_id int, territorio_id string, tipo_alojamiento_id string, residencia_id string, "
            "viajeros bigint, pernoctaciones bigint, es_provisional boolean, fuente string",
        ),
        "fct_oferta_mensual": make(
            [(y * 100 + m, "region-murcia", "hotel", 1000 + 10 * m) for y, m in months],
            "fecha_id int, territorio_id string, tipo_alojamiento_id string, personal_empleado bigint",
        ),
        "fct_precios_mensual": make(
            [(y * 100 + m, t, 100.0 + m, 1.5) for y, m in months for t in ("region-murcia", "espana")],
            "fecha_id int, territorio_id string, indice_precios double, variacion_interanual double",
        ),
        "excepciones_cuadre": make(
            [(201901, "viajeros", "prueba"), (201902, "viajeros", "prueba"), (201904, "viajeros", "prueba")],
            "fecha_id int, medida string, motivo string",
        ),
    }


@pytest.fixture(scope="module")
def sections(tables):
    return indicators.all_indicators(tables)


def test_complete_years(sections):
    for base in ("ine", "mt"):
        assert [r.anio for r in sections[f"anios_completos_{base}"].collect()] == [2019]


def test_profile_adds_up_to_100(sections):
    rows = sections["perfil_tipos_mes"].collect()
    for kind in ("hotel", "camping"):
        assert sum(r.pct for r in rows if r.grupo == kind) == pytest.approx(100)
    assert all(r.pct == pytest.approx(100 / 12) for r in rows if r.grupo == "camping")


def test_series_has_gaps_not_zeros(sections):
    series = {(r.tipo, r.fecha): r for r in sections["serie_tipos"].collect()}
    assert len(series) == 36
    assert series["camping", "2020-04"].pernoctaciones is None
    assert series["camping", "2020-04"].provisional is False
    assert series["hotel", "2020-04"].pernoctaciones == 800
    assert series["hotel", "2020-06"].provisional is True


def test_sources_agree_but_for_one_month_of_people(sections):
    assert tuple(sections["cuadre"].first()) == (18, 0, 18, 17)


def test_coverage(sections):
    assert tuple(sections["meta"].first()) == ("2019-01", "2020-06", "2020-06", "2020-06")


def test_zone_profile(sections):
    zones = {r.zona: r for r in sections["perfil_zonas"].collect()}
    assert set(zones) == {"costa", "ciudad"}
    assert zones["costa"].ratio_agosto_enero == pytest.approx(8)
    assert zones["ciudad"].estancia_media == pytest.approx(40 / 15)
    assert zones["costa"].pct_extranjero == pytest.approx(50)


def test_annual_index_and_totals(sections):
    assert {(r.grupo, r.anio, r.pernoctaciones, r.indice) for r in sections["anual_tipos"].collect()} == {
        ("hotel", 2019, 15600, 100.0),
        ("camping", 2019, 1200, 100.0),
    }
    total = {r.grupo: r for r in sections["totales_tipos"].collect()}
    assert total["hotel"].total == 16800
    assert total["hotel"].peso_resto == pytest.approx(100 * 1200 / 16800)
    assert total["camping"].cambio_total == 0
    assert sections["bajo_base_tipos"].count() == 0


def test_derived_figures(sections):
    peaks = sections["picos_tipos"].collect()
    assert [(p.grupo, p.peak, p.trough) for p in peaks] == [("hotel", 12, 1), ("camping", 1, 1)]
    assert tuple(sections["extremos_tipos"].first()) == ("hotel", "camping")
    summer = {r.grupo: r.pct for r in sections["verano_zonas"].collect()}
    assert summer["costa"] == pytest.approx(100 * 30 / 78)
    staff = {r.anio: r for r in sections["empleo_total"].collect()}
    assert (staff[2019].alto, staff[2019].bajo) == (1080, 1010)
    assert staff[2019].cambio == pytest.approx(100 * 70 / 1010)
    assert (staff[2020].alto, staff[2020].bajo, staff[2020].cambio) == (None, 1010, None)
    assert {r.territorio: r.fecha for r in sections["ultimos_precios"].collect()} == {
        "region-murcia": "2020-06",
        "espana": "2020-06",
    }
    band = sections["banda_provisional"].first()
    assert (band.desde, band.hasta) == (datetime.date(2020, 6, 1), datetime.date(2020, 7, 1))


def test_exception_runs(sections):
    runs = sorted((r.start, r.end) for r in sections["tramos_excepciones"].collect())
    assert runs == [(1, 2), (4, 4)]


def test_mismatch_honours_the_exception_of_its_measure_only(spark, tables):
    from statloom.operators import reconcile as rec
    from statloom.plans.checks import PEOPLE, source_totals

    office, portal = source_totals(tables)

    def keys(exceptions):
        out = rec.mismatches(office, portal, ["fecha_id"], PEOPLE, 10, 0.0005, exceptions)
        return [r.fecha_id for r in out.collect()]

    assert keys(None) == [201901]
    assert keys(tables["excepciones_cuadre"]) == []
    other = tables["excepciones_cuadre"].withColumn("medida", F.lit("pernoctaciones"))
    assert keys(other) == [201901]


def test_a_year_without_one_group_is_not_complete(tables):
    demand = tables["fct_demanda_mensual"]
    rural = demand.filter("fecha_id = 202001 and tipo_alojamiento_id = 'hotel'").withColumn(
        "tipo_alojamiento_id", F.lit("rural")
    )
    more = {**tables, "fct_demanda_mensual": demand.unionByName(rural)}
    assert indicators.complete_years(shared(indicators.region(indicators.monthly_base(more)))).count() == 0
