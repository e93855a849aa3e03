from __future__ import annotations

import json

import pytest

from statloom.operators.classify import UnknownValue
from statloom.plans import catalogue as cat
from statloom.sources.reference import read_reference
from statloom.sources.schemas import SERIES_CATALOGUE
from statloom.sources.series import read_metadata


def series(code, unit="Personas ", **variables):
    names = {
        "region": "Comunidades y Ciudades Autónomas",
        "provincia": "Provincias",
        "punto": "PUNTOS TURISTÍCOS",
        "zona": "ZONAS TURÍSTICAS",
        "nacional": "Totales Territoriales",
        "concepto": "Concepto turístico",
        "residencia": "RESIDENCIA/ORIGEN",
        "categoria": "TIPO DE CATEGORIA",
        "dato": "Tipo de dato",
    }
    entries = [{"Id": 1, "T3_Variable": names[k], "Nombre": v, "Codigo": ""} for k, v in variables.items()]
    return {"COD": code, "Nombre": f" Serie {code} ", "T3_Unidad": unit, "MetaData": entries, "Data": []}


REGION = {"region": "Murcia, Región de"}
DEMAND = [
    series("A1", **REGION, concepto="Viajero", residencia="Residentes en España"),
    series("A2", **REGION, concepto="Viajero", residencia="Residentes en el Extranjero"),
    series("A3", **REGION, concepto="Viajero", residencia="Total"),
    series("A4", provincia="Murcia", concepto="Viajero", residencia="Residentes en España"),
    series("A5", region="Andalucía", concepto="Lo que sea"),
    series("A6", **REGION, concepto="Viajero", residencia="Residentes en España", categoria="Cinco estrellas"),
    series("A7", **REGION, concepto="Viajero", dato="Tasa", residencia="Residentes en España"),
    series("A8", nacional="Total Nacional", concepto="Viajero", residencia="Residentes en España"),
]
SUPPLY = [
    series("B1", None, punto="Cartagena", concepto="Personal empleado", categoria="Total categorías"),
    series("B2", zona="Murcia (Región De): Costa Cálida", concepto="Número de plazas estimadas", dato="Dato"),
]
PRICES = [
    series("C1", nacional="Total Nacional", concepto="Índice de precios", dato="Índice"),
    series("C2", **REGION, concepto="Índice de precios", dato="Tasa de variación interanual"),
]


@pytest.fixture
def read(spark, tmp_path):
    def write(tables):
        for number, documents in tables.items():
            text = json.dumps(documents, ensure_ascii=False)
            (tmp_path / f"metadatos_{number}.json").write_text(text, "utf-8")
        (tmp_path / "otra.json").write_text("[]", "utf-8")
        return read_metadata(spark, str(tmp_path))

    return write


def test_catalogue(read):
    df = cat.series_catalogue(read({2074: DEMAND, 2066: SUPPLY, 12156: PRICES}), (2074, 2066, 12156))
    assert df.columns == SERIES_CATALOGUE.names
    got = [(r.codigo, r.hecho, r.territorio, r.nivel_territorio, r.medida, r.residencia, r.unidad) for r in df.collect()]
    assert got == [
        ("A1", "demanda", "region-murcia", "region", "viajeros", "espana", "Personas"),
        ("A2", "demanda", "region-murcia", "region", "viajeros", "extranjero", "Personas"),
        ("B1", "oferta", "cartagena", "punto", "personal_empleado", "", ""),
        ("B2", "oferta", "costa-calida", "zona", "plazas", "", "Personas"),
        ("C1", "precios", "espana", "pais", "indice_precios", "", "Personas"),
        ("C2", "precios", "region-murcia", "region", "variacion_interanual_precios", "", "Personas"),
    ]
    assert df.first().nombre_ine == "Serie A1"


def test_first_table_wins_over_position(read):
    later = series("Z1", **REGION, concepto="Viajero", residencia="Residentes en España")
    df = cat.series_catalogue(read({2039: [later], 2074: [DEMAND[4], DEMAND[3], DEMAND[0]]}), (2039, 2074))
    assert [r.codigo for r in df.collect()] == ["A4"]


@pytest.mark.parametrize(
    ("number", "bad", "message"),
    [
        (2074, series("N1", **REGION, concepto="Algo nuevo"), "concept in N1: Algo nuevo"),
        (2074, series("N2", **REGION, concepto="Viajero", residencia="Marte"), "residence in N2: Marte"),
        (12156, series("N3", **REGION, dato="Otro"), "data type in N3: Otro"),
        (12156, series("N4", **REGION), r"data type in N4: \(none\)"),
    ],
)
def test_an_unknown_value_stops_the_build(read, number, bad, message):
    with pytest.raises(UnknownValue, match=message):
        cat.series_catalogue(read({number: [bad, *DEMAND[:1]] if number == 2074 else [bad]}), [number])


def test_unknown_values_of_discarded_series_do_not_matter(read):
    fine = series("D1", region="Andalucía", concepto="Algo nuevo", residencia="Marte")
    assert cat.series_catalogue(read({2074: [fine]}), [2074]).count() == 0


def test_catalogue_file_reads_back(spark, read, tmp_path):
    df = cat.series_catalogue(read({2074: DEMAND, 2066: SUPPLY}), (2074, 2066))
    cat.write_catalogue(df, str(tmp_path / "csv"))
    again = read_reference(spark, str(tmp_path / "csv"), SERIES_CATALOGUE, blanks=True)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, df.collect()))


def test_a_missing_source_table_stops_the_build(read):
    with pytest.raises(cat.MissingTable, match="2066"):
        cat.series_catalogue(read({2074: DEMAND}), (2074, 2066))
    with pytest.raises(cat.MissingTable):
        cat.series_catalogue(read({2074: DEMAND, 2066: SUPPLY}))


def test_the_first_of_several_territories_counts(read):
    both = series("N5", **REGION, zona="Murcia (Región De): Costa Cálida", concepto="Viajero", residencia="Residentes en España")
    first = next(t for _, _, t, _ in cat.fx.METADATA_TERRITORIES if t in ("region-murcia", "costa-calida"))
    assert [r.territorio for r in cat.series_catalogue(read({2074: [both]}), [2074]).collect()] == [first]
