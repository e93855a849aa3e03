from __future__ import annotations

import datetime
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from statloom.plans import bronze
from statloom.plans.tables import REFERENCE
from statloom.sources import files, store
from statloom.sources.html import html_tables, table_rows
from statloom.sources.reference import read_reference
from statloom.sources.schemas import BRONZE_DESTINATIONS, BRONZE_SERIES
from statloom.sources.series import latest_snapshot
from tests import world


def document(**changes):
    d = world.series_document(0, world.CATALOGUE[0])
    d["Data"] = d["Data"][:3]
    d["Data"][0].update(changes)
    return d


def test_latest_snapshot_ignores_other_folders(spark, tmp_path):
    for name in ("2026-08-01", "2026-09-29", "notas", "2026-09-01"):
        (tmp_path / name).mkdir()
    assert latest_snapshot(spark, str(tmp_path)) == "2026-09-29"


def test_no_snapshot_fails(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        latest_snapshot(spark, str(tmp_path))


def test_series_load_uses_the_newest_snapshot(spark, tmp_path):
    world.write_series(tmp_path, "2026-09-01", [document()])
    newest = document(Valor=None, Secreto=True)
    newest["Data"][1].update(Valor=None, Notas=[{"texto": "cierre"}, {"texto": "otra"}])
    del newest["Data"][2]["Secreto"]
    world.write_series(tmp_path, "2026-09-29", [newest])
    df, origin = bronze.series(spark, str(tmp_path))
    assert origin == "ine/2026-09-29"
    assert df.schema.simpleString() == BRONZE_SERIES.simpleString()
    a, b, c = df.orderBy("anio", "periodo").collect()
    assert (a.valor, a.secreto, a.notas) == (None, True, None)
    assert (b.valor, b.secreto, b.notas) == (None, False, "cierre | otra")
    assert c.secreto is False
    assert a._ingestado_en == datetime.date(2026, 9, 29)
    assert a._fichero_origen == "ine/2026-09-29/X000.json"


def test_every_load_is_recorded_and_an_empty_one_keeps_the_table(spark, tmp_path):
    raw, lake = tmp_path / "raw", str(tmp_path / "lake")
    world.write_series(raw, "2026-09-01", [document()])
    assert [bronze.load_series(spark, str(raw), lake) for _ in range(3)] == [3, 3, 3]
    empty = document()
    empty["Data"] = []
    world.write_series(raw, "2026-09-02", [empty])
    with pytest.raises(store.EmptyLoad):
        bronze.load_series(spark, str(raw), lake)
    assert store.read_table(spark, f"{lake}/bronze/ine_series").count() == 3
    ledger = store.read_ledger(spark, f"{lake}/bronze/_cargas").collect()
    assert [(r.tabla, r.filas, r.origen) for r in ledger] == [("bronze.ine_series", 3, "ine/2026-09-01")] * 3
    versions = [n for n in files.list_names(spark, f"{lake}/bronze/ine_series", True) if n.startswith("v")]
    assert len(versions) == 2


def test_a_broken_document_fails_the_load(spark, tmp_path):
    world.write_series(tmp_path, "2026-09-01", [document()])
    (tmp_path / "ine/2026-09-01/roto.json").write_text('{"COD": "A", "Data": [', "utf-8")
    df, _ = bronze.series(spark, str(tmp_path))
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        df.collect()


def test_pages_are_read_as_published(spark, tmp_path):
    folder = tmp_path / "murciaturistica"
    folder.mkdir()
    rows = world.page_rows(2019, 7)
    label = rows[1][0]
    cell = f"<td>{label}</td><td>{rows[1][1]:,}</td>"
    html = world.page_html(rows).replace(cell, f"<td>{label}</td><td>n.d.</td>")
    (folder / "destinos_2019-07.html").write_text(html, "utf-8")
    (folder / "destinos_2019-7.html").write_text("otro", "utf-8")
    df = bronze.destinations(spark, str(tmp_path))
    assert df.schema.simpleString() == BRONZE_DESTINATIONS.simpleString()
    got = {r.destino: r for r in df.collect()}
    assert len(got) == 15
    assert {"Mazarrón", "Águilas", "Total Costa", "Totales"} <= set(got)
    assert got[label].viajeros_total is None
    total = got["Totales"]
    assert total.pernoctaciones_no_residentes == rows[-1][6] > 1000
    assert (total.anio, total.mes, total._fichero_origen) == (2019, 7, "murciaturistica/destinos_2019-07.html")


def test_no_pages_fails(spark, tmp_path):
    (tmp_path / "murciaturistica").mkdir()
    (tmp_path / "murciaturistica/destinos_x.html").write_text("x", "utf-8")
    with pytest.raises(FileNotFoundError):
        bronze.destinations(spark, str(tmp_path))


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("<table><tr><td>a<td>b<tr><td>c<td></table>", [["a", "b"], ["c", None]]),
        ("<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>", [["a", "b"], ["a", "c"]]),
        ("<table><tr><td colspan='2'>a</td><td>b</td></tr></table>", [["a", "a", "b"]]),
        ("<p>x</p><table><tr><td> &aacute;<b>b</b>\n c </td></tr></table><table><tr><td>z</table>", [["áb c"]]),
        ("<table><tr><td>a<script>b</script><table><tr><td>n</td></tr></table></td></tr></table>", [["an"]]),
        ("<p>no table</p>", []),
        ("<table><tr><td rowspan=3>a</td><td>1</td></tr><tr><td>2</td></tr><tr><td>3</td></tr></table>",
         [["a", "1"], ["a", "2"], ["a", "3"]]),
    ],
)
def test_first_table(html, expected):
    assert table_rows(html) == expected


def test_bytes_in_another_charset():
    page = '<meta charset="iso-8859-1"><table><tr><td>Águila</td></tr></table>'
    assert table_rows(page.encode("latin-1")) == [["Águila"]]
    assert table_rows("<table><tr><td>Águila</td></tr></table>".encode("cp1252")) == [["Águila"]]


def test_a_page_of_another_width_fails_with_its_name(spark):
    df = spark.createDataFrame([("p1", "<table><tr><td>a</td></tr></table>")], "path string, content string")
    with pytest.raises(PySparkException, match="p1: expected a table of 2 columns"):
        html_tables(df, ["a", "b"], 0).collect()


def test_reference_tables_have_declared_types(spark, tmp_path):
    path = tmp_path / "series.csv"
    world.write_catalogue(path)
    df = read_reference(spark, str(path), REFERENCE["series_ine"])
    assert df.schema.simpleString() == REFERENCE["series_ine"].simpleString()
    row = df.filter("codigo = 'X008'").first()
    assert (row.tabla_id, row.residencia, row.nombre_ine) == (1, None, 'Serie 8, con "coma"')
    assert read_reference(spark, str(path), REFERENCE["series_ine"], blanks=True).filter("residencia = ''").count() == 4


def test_replacing_a_table_is_invisible_until_it_is_whole(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert store.replace_table(spark.range(10), folder, ["id"]) == 10
    first = store.current_path(spark, folder)
    bad = spark.range(5).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(PySparkException):
        store.replace_table(bad, folder)
    assert store.current_path(spark, folder) == first
    assert store.replace_table(spark.range(3), folder) == 3
    assert store.read_table(spark, folder).count() == 3


def test_export_and_checksums(spark, tmp_path):
    folder = tmp_path / "out"
    store.export({"a": spark.range(100), "b": spark.range(5)}, str(folder), max_bytes=480)
    store.export({"a": spark.range(100)}, str(folder), max_bytes=480)
    sums = {r.fichero: r.sha256 for r in store.checksums(spark, str(folder), "part-*").collect()}
    assert len([n for n in sums if n.startswith("a.parquet/")]) >= 4
    for name, sha in sums.items():
        assert hashlib.sha256((folder / name).read_bytes()).hexdigest() == sha
    assert store.register(spark, str(folder / "b.parquet"), "vista_b").count() == 5
    assert spark.table("vista_b").count() == 5


def test_a_charset_after_a_long_head_is_found():
    head = b"<html><head><style>" + b"x" * 5000 + b"</style><meta charset='iso-8859-15'></head>"
    assert table_rows(head + b"<table><tr><td>a\xa4</td></tr></table>") == [["a\u20ac"]]


def test_spans_are_neither_clipped_nor_unbounded():
    page = "<table><tr><td colspan=1500>a</td></tr></table>"
    assert len(table_rows(page)[0]) == 1500
    with pytest.raises(ValueError, match="more than 9"):
        table_rows(page, 9)
    assert table_rows("<table><tr><td colspan='\u00b2'>a</td><td colspan='x'>b</td></tr></table>") == [["a", "b"]]


@pytest.mark.parametrize(
    "page, encoding",
    [
        ("<table><tr><td>España \u2013 charset=iso-8859-1</td></tr></table>", "utf-8"),
        ("<!-- <meta charset='iso-8859-1'> --><table><tr><td>España</td></tr></table>", "utf-8"),
        ("<script>'<meta charset=utf-16>'</script><table><tr><td>España</td></tr></table>", "utf-8"),
        ("<p title='<meta charset=utf-16>'></p><table><tr><td>España</td></tr></table>", "utf-8"),
        ("<meta charset='iso-8859-1'><table><tr><td>España</td></tr></table>", "utf-8-sig"),
        ("<table><tr><td>España</td></tr></table>", "utf-16"),
        ("<table><tr><td>España</td></tr></table><META CONTENT='text/html; Charset = \"cp1250\"' HTTP-EQUIV=content-type>", "cp1252"),
        ("<meta name=charset content='charset=utf-16'><table><tr><td>España</td></tr></table>", "utf-8"),
        ("<meta charset=unheard-of><table><tr><td>España</td></tr></table>", "utf-8"),
        ("<table><tr><td>España</td></tr></table><meta charset='", "utf-8"),
    ],
)
def test_only_marks_and_meta_tags_declare_a_charset(page, encoding):
    cell = table_rows(page.encode(encoding))[0][0]
    # The two Windows code pages differ in this letter: the declared one is taken, wherever it stands.
    assert cell.startswith("Espańa" if encoding == "cp1252" else "España")
    assert "\u00c3" not in cell


def test_rows_are_handed_on_in_pieces(spark):
    page = "<table>" + "".join(f"<tr><td>{i}</td></tr>" for i in range(9000)) + "</table>"
    df = spark.createDataFrame([("a", page), ("b", "<table><tr><td>x</td></tr></table>")], "path string, content string")
    rows = html_tables(df.coalesce(1), ["c"], 0).collect()
    assert len(rows) == 9001
    assert [(r.path, r.fila, r.c) for r in rows][8998:] == [("a", 8999, "8998"), ("a", 9000, "8999"), ("b", 1, "x")]
    assert html_tables(df.limit(0), ["c"], 0).count() == 0


def test_exported_files_are_bounded_in_bytes(spark, tmp_path):
    rows = spark.range(200).select(
        F.sha2(F.col("id").cast("string"), 512).alias("a"),
        F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.rand(7)).alias("b"),
        F.when(F.col("id") == 77, F.repeat(F.uuid(), 200)).alias("c"),
    )
    store.export({"t": spark.createDataFrame(rows.collect(), rows.schema)}, str(tmp_path), max_bytes=40_000)
    files_ = list((tmp_path / "t.parquet").glob("part-*"))
    assert len(files_) > 5 and max(f.stat().st_size for f in files_) < 40_000
    assert spark.read.parquet(str(tmp_path / "t.parquet")).count() == 200
    store.export({"empty": rows.limit(0)}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "empty.parquet")).count() == 0


def test_a_load_that_is_tried_again_has_one_line(spark, tmp_path):
    raw, lake = tmp_path / "raw", str(tmp_path / "lake")
    world.write_series(raw, "2026-09-01", [document()])
    for load_id in ("september", "september", "october"):
        bronze.load_series(spark, str(raw), lake, load_id)
    assert store.read_ledger(spark, f"{lake}/bronze/_cargas").count() == 2


def test_failures_are_counted_while_a_table_is_written(spark, tmp_path):
    rules = {"negative": F.col("id") < 0, "odd": F.col("id") % 2 == 1}
    store.replace_table(spark.range(9), str(tmp_path), ["id"], rules=rules)
    assert store.observed_failures(spark, str(tmp_path)) == {"negative": 0, "odd": 4}
    assert store.read_table(spark, str(tmp_path)).count() == 9
