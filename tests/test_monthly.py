"""The whole monthly run over made-up sources with known totals."""

from __future__ import annotations

import hashlib
import json
import pathlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from statloom.operators.quality import QualityError
from statloom.operators.staging import shared
from statloom.plans import checks, indicators, monthly, release
from statloom.plans.tables import built_in, from_csv
from statloom.sources.schemas import GOLD
from statloom.sources.store import observed_failures, read_table, register_layers
from tests import world

TODAY = "2020-09-15"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("monthly")
    world.write_world(base / "raw")
    world.write_catalogue(base / "series_ine.csv")
    (base / "release").mkdir()
    (base / "release" / "notas.txt").write_text("de otra persona", "utf-8")
    return base


@pytest.fixture(scope="module")
def reference(spark, folder):
    return from_csv(spark, {"series_ine": str(folder / "series_ine.csv")})


@pytest.fixture(scope="module")
def result(spark, folder, reference):
    return monthly.run(
        spark, str(folder / "raw"), str(folder / "lake"), reference, str(folder / "release"), TODAY
    )


def test_all_checks_run_and_pass(result):
    report = result["_pruebas"].collect()
    assert len(report) == 86 + 5 + 2
    assert [r.prueba for r in report if not r.superada] == []


def test_ledger(result):
    lines = {(r.tabla, r.filas, r.origen) for r in result["_cargas"].collect()}
    series = len(world.CATALOGUE) * len(world.MONTHS)
    assert lines == {
        ("bronze.ine_series", series, "ine/2020-09-01"),
        ("bronze.murciaturistica_destinos", 15 * len(world.MONTHS), "murciaturistica"),
    }


def test_hidden_coast_is_recovered_and_sources_agree(spark, folder, result):
    fact = read_table(spark, str(folder / "lake/gold/fct_demanda_mensual"))
    hidden = fact.filter("territorio_id = 'destino-costa-no-desglosado'")
    assert {r.fecha_id for r in hidden.collect()} == {201901, 201912, 202001}
    # Seventeen of the eighteen months are published by both sources.
    assert tuple(result["cuadre"].first()) == (17, 0, 17, 17)
    camping = fact.filter("fecha_id = 202004 and tipo_alojamiento_id = 'camping'")
    assert camping.count() == 0


def test_indicators(result):
    assert [r.anio for r in result["anios_completos_mt"].collect()] == [2019]
    series = {(r.tipo, r.fecha): r.pernoctaciones for r in result["serie_tipos"].collect()}
    assert series["camping", "2020-04"] is None
    assert series["camping", "2020-05"] == 100
    zones = {r.zona: r for r in result["perfil_zonas"].collect()}
    assert set(zones) == {"ciudad", "costa", "interior"}
    assert all(z.ratio_agosto_enero == pytest.approx(8) for z in zones.values())
    assert all(z.estancia_media == pytest.approx(3) for z in zones.values())


def _package(spark, folder):
    return pathlib.Path(release.package_path(spark, str(folder)))


def test_package(spark, folder, result):
    out = _package(spark, folder / "release")
    contract = json.loads((out / "contrato.json").read_text("utf-8"))
    assert contract["periodo"] == {"desde": "2019-01", "hasta": "2020-06"}
    assert set(contract["tablas"]) == set(GOLD)
    assert contract["tablas"]["dim_residencia"] == {
        "filas": 2,
        "columnas": [{"nombre": "residencia_id", "tipo": "VARCHAR"}, {"nombre": "nombre", "tipo": "VARCHAR"}],
    }
    lines = (out / "SHA256SUMS").read_text("utf-8").splitlines()
    assert len(lines) == len({line.split("  ")[1] for line in lines}) > len(GOLD)
    for line in lines:
        sha, name = line.split("  ")
        assert hashlib.sha256((out / name).read_bytes()).hexdigest() == sha
    assert (folder / "release" / "notas.txt").read_text("utf-8") == "de otra persona"
    assert not any("notas.txt" in line for line in lines)


def test_publishing_again_replaces_old_tables(spark, folder, result, tmp_path):
    out = str(tmp_path / "p")
    one = {"fct_demanda_mensual": spark.createDataFrame([(201501, 1), (202608, 2)], "fecha_id int, n bigint")}
    release.publish(spark, {**one, "vieja": spark.range(2)}, out)
    contract = release.publish(spark, one, out)
    assert contract["periodo"] == {"desde": "2015-01", "hasta": "2026-08"}
    assert not (_package(spark, out) / "vieja.parquet").exists()
    with pytest.raises(ValueError, match="gold"):
        release.publish(spark, {}, out)


def test_a_package_that_fails_half_way_leaves_the_old_one(spark, tmp_path):
    out = str(tmp_path / "p")
    good = spark.createDataFrame([(201501, 1), (202608, 2)], "fecha_id int, n bigint")
    release.publish(spark, {"fct_demanda_mensual": good, "otra": spark.range(3)}, out)
    before = _package(spark, out)
    bad = spark.range(5).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(PySparkException):
        release.publish(spark, {"fct_demanda_mensual": good.limit(1), "otra": bad}, out)
    assert _package(spark, out) == before and len([d for d in before.parent.iterdir() if d.is_dir()]) == 1
    contract = json.loads((before / "contrato.json").read_text("utf-8"))
    assert {n: spark.read.parquet(str(before / f"{n}.parquet")).count() for n in contract["tablas"]} == {
        n: t["filas"] for n, t in contract["tablas"].items()
    }
    for line in (before / "SHA256SUMS").read_text("utf-8").splitlines():
        sha, name = line.split("  ")
        assert hashlib.sha256((before / name).read_bytes()).hexdigest() == sha


def test_row_rules_cost_no_scan_of_a_written_layer(spark, folder, result):
    lake, name = str(folder / "lake"), "fct_demanda_mensual"
    fact = read_table(spark, f"{lake}/gold/{name}")
    with_scan = checks.layer_report({name: fact})
    counted = {name: observed_failures(spark, f"{lake}/gold/{name}")}
    without = checks.layer_report({name: fact}, observed=counted)
    rules = checks.row_rules(name)
    assert set(counted[name]) == set(rules)
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("parquet")
    assert scans(without) == scans(with_scan) - 1
    assert sorted(map(tuple, without.collect())) == sorted(map(tuple, with_scan.collect()))


def test_indicators_read_the_demand_fact_once(spark, folder, result):
    lake = str(folder / "lake")
    fact = read_table(spark, f"{lake}/gold/fct_demanda_mensual").select("*", F.spark_partition_id().alias("_demand_fact"))
    tables = {n: read_table(spark, f"{lake}/gold/{n}") for n in GOLD} | {"fct_demanda_mensual": fact}
    tables["excepciones_cuadre"] = built_in(spark)["excepciones_cuadre"]
    kept = []
    sections = indicators.all_indicators(tables, lambda df: kept.append(df) or shared(df))
    read = [d for d in [*kept, *sections.values()] if "_demand_fact" in d._jdf.queryExecution().analyzed().toString()]
    assert len(read) == 1 and len(sections) == 26
    assert {r.zona for r in sections["perfil_zonas"].collect()} == {"ciudad", "costa", "interior"}


def test_indicator_files(spark, result, tmp_path):
    monthly.write_indicators({"cuadre": result["cuadre"], "precios": result["precios"]}, str(tmp_path))
    assert spark.read.json(str(tmp_path / "cuadre")).first().meses == 17
    document = monthly.document(result)
    assert document["cuadre"] == [
        {
            "meses": 17,
            "dif_max_pernoctaciones": 0,
            "meses_pernoctaciones_cuadran": 17,
            "meses_viajeros_cuadran": 17,
        }
    ]
    assert json.loads(json.dumps(document))["serie_tipos"][0]["fecha"] == "2019-01"


def test_a_missing_series_blocks_the_build(spark, folder, reference, tmp_path):
    extra = reference["series_ine"].limit(1).withColumn("codigo", F.lit("FALTA"))
    more = {**reference, "series_ine": reference["series_ine"].unionByName(extra)}
    with pytest.raises(QualityError, match="catalogo_completo"):
        monthly.run(spark, str(folder / "raw"), str(tmp_path / "lake"), more, today=TODAY)
    assert not (tmp_path / "lake" / "gold").exists()
    loaded = read_table(spark, str(tmp_path / "lake/bronze/ine_series"))
    assert [r.codigo for r in checks.missing_sample(loaded, more["series_ine"]).collect()] == ["FALTA"]


def test_old_data_only_warn(spark, folder, result, reference):
    loaded = read_table(spark, str(folder / "lake/bronze/ine_series"))
    late = checks.bronze_report(loaded, reference["series_ine"], "2021-09-15")
    assert {(r.prueba, r.gravedad, r.superada) for r in late.collect()} == {
        ("catalogo_completo", "error", True),
        ("datos_recientes", "warn", False),
    }


def test_an_unbalanced_source_blocks_gold_and_publication(spark, folder, reference, tmp_path):
    raw = tmp_path / "raw"
    world.write_world(raw)
    rows = [r and ((r[0], *(v + 5000 for v in r[1:])) if r[0] == "La Manga" else r) for r in world.page_rows(2019, 7)]
    (raw / "murciaturistica/destinos_2019-07.html").write_text(world.page_html(rows), "utf-8")
    with pytest.raises(QualityError, match="zonas_cuadran_con_totales"):
        monthly.run(spark, str(raw), str(tmp_path / "lake"), reference, str(tmp_path / "p"), TODAY)
    assert not (tmp_path / "lake" / "gold").exists()
    assert not (tmp_path / "p").exists()


def test_layers_are_visible_to_sql(spark, folder, result):
    names = register_layers(spark, str(folder / "lake"))
    assert {f"gold.{n}" for n in GOLD} <= set(names)
    assert register_layers(spark, str(folder / "lake")) == names
    row = spark.sql(
        """
        SELECT d.anio, sum(f.pernoctaciones) AS p
        FROM gold.fct_demanda_mensual f JOIN gold.dim_fecha d USING (fecha_id)
        WHERE f.fuente = 'INE' AND f.tipo_alojamiento_id = 'camping' AND d.anio = 2019 GROUP BY ALL
        """
    ).first()
    assert tuple(row) == (2019, 1200)
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE {layer} CASCADE")
    assert (folder / "lake/gold/dim_fecha/_CURRENT").exists()


def test_command_line(spark, folder, tmp_path):
    monthly.main(
        [
            str(folder / "raw"),
            str(tmp_path / "lake"),
            "--series",
            str(folder / "series_ine.csv"),
            "--indicators",
            str(tmp_path / "out"),
            "--today",
            TODAY,
        ]
    )
    assert spark.read.json(str(tmp_path / "out" / "pruebas")).filter("not superada").count() == 0
    assert spark.read.json(str(tmp_path / "out" / "cuadre")).first().meses == 17


def test_the_one_document(spark, result, tmp_path):
    path = str(tmp_path / "indicadores.json")
    written = monthly.write_document(spark, result, path, "2024-01-31")
    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    assert read == json.loads(json.dumps(written))
    assert read["generado"] == "2024-01-31"
    assert set(read["meta"]) >= {"primer_mes", "anios_completos_mt", "anios_completos_ine"}
    assert isinstance(read["cuadre"]["excepciones"], list)
    assert not set(read) & {"excepciones", "anios_completos_mt", "_pruebas"}
