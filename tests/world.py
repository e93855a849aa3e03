"""A small made-up pair of sources on disk: series documents and monthly pages."""

from __future__ import annotations

import json
from pathlib import Path

from statloom.plans import fixed_values as fx

DESTINATIONS = [(label, zone) for label, zone, kind in fx.PUBLISHED_LABELS if kind == "destino"]
MONTHS = [(y, m) for y in (2019, 2020) for m in range(1, 13) if (y, m) <= (2020, 6)]
CATALOGUE = []
for _kind in ("hotel", "camping"):
    for _measure in ("viajeros", "pernoctaciones"):
        for _part in ("espana", "extranjero"):
            CATALOGUE.append(("demanda", _kind, "region-murcia", _measure, _part))
CATALOGUE += [
    ("oferta", "hotel", "region-murcia", "personal_empleado", ""),
    ("oferta", "hotel", "region-murcia", "ocupacion_plazas", ""),
    ("precios", "hotel", "region-murcia", "indice_precios", ""),
    ("precios", "hotel", "espana", "variacion_interanual_precios", ""),
]


def code(i: int) -> str:
    return f"X{i:03d}"


def value(entry: tuple, y: int, m: int) -> float:
    fact, kind, _, measure, part = entry
    if fact == "demanda" and kind == "hotel":
        # What the destinations of the pages add up to.
        return float(sum(page_value(d, m, part, measure) for d in range(len(DESTINATIONS))))
    return {"demanda": 50.0, "oferta": 60.0, "precios": -1.0 if "variacion" in measure else 110.0}[fact]


def page_value(destination: int, m: int, part: str, measure: str) -> int:
    base = (destination + 1) * m * (10 if measure == "viajeros" else 30)
    return base * (2 if part == "espana" else 1)


def series_document(i: int, entry: tuple) -> dict:
    data = []
    for y, m in MONTHS:
        data.append(
            {
                "Fecha": 0,
                "FK_TipoDato": 2 if (y, m) == (2020, 6) else 1,
                "FK_Periodo": m,
                "Anyo": y,
                "Valor": value(entry, y, m),
                "Secreto": False,
            }
        )
    if entry[1] == "camping":
        hidden = next(d for d in data if (d["Anyo"], d["FK_Periodo"]) == (2020, 4))
        hidden.update(Valor=0.0, Secreto=True, Notas=[{"texto": "oculto", "Fk_TipoNota": 1}])
    return {"COD": code(i), "Nombre": f"Serie {i}", "FK_Unidad": 1, "Data": data}


def write_series(raw: Path, date: str, documents: list[dict]) -> None:
    folder = raw / "ine" / date
    folder.mkdir(parents=True)
    for d in documents:
        (folder / f"{d['COD']}.json").write_text(json.dumps(d, ensure_ascii=False, indent=1), "utf-8")


def page_rows(y: int, m: int, hide: str | None = None, silent: bool = False) -> list[tuple]:
    """Label and the six measures; ``hide`` names a zone whose destinations show zero."""

    def cells(ds, zero):
        out = []
        for measure in ("viajeros", "pernoctaciones"):
            parts = [sum(page_value(d, m, p, measure) for d in ds) for p in ("espana", "extranjero")]
            out += [sum(parts), *parts]
        return [0] * 6 if zero or silent else out

    rows = []
    for zone in ("ciudad", "costa", "interior"):
        ds = [d for d, (_, z) in enumerate(DESTINATIONS) if z == zone]
        rows += [(DESTINATIONS[d][0], *cells([d], zone == hide)) for d in ds]
        mark = " *" if zone == hide else ""
        rows += [(f"Total {zone.capitalize()}{mark}", *cells(ds, False)), None]
    return [*rows, ("Totales", *cells(range(len(DESTINATIONS)), False))]


def page_html(rows: list[tuple | None]) -> str:
    head = '<tr><th rowspan="2">Destino</th><th colspan="3">Viajeros</th><th colspan="3">Pernoctaciones</th></tr>'
    head += "<tr>" + "<th>Total</th><th>Residentes</th><th>No residentes</th>" * 2 + "</tr>"
    body = ""
    for r in rows:
        cells = ["&nbsp;"] * 7 if r is None else [r[0], *(f"{v:,}" for v in r[1:])]
        body += "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>\n"
    return f'<html><head><meta charset="utf-8"></head><body><table>{head}{body}</table></body></html>'


def write_world(raw: Path) -> None:
    """January 2019 to June 2020; the coast is hidden in winter and April 2020 is all zero."""
    write_series(raw, "2020-08-01", [])
    write_series(raw, "2020-09-01", [series_document(i, e) for i, e in enumerate(CATALOGUE)])
    folder = raw / "murciaturistica"
    folder.mkdir()
    for y, m in MONTHS:
        rows = page_rows(y, m, "costa" if m in (1, 12) else None, (y, m) == (2020, 4))
        (folder / f"destinos_{y}-{m:02d}.html").write_text(page_html(rows), "utf-8")
    (folder / "destinos_borrador.html").write_text("<p>no</p>", "utf-8")


def write_catalogue(path: Path) -> None:
    head = "codigo,operacion,tabla_id,hecho,tipo_alojamiento,territorio,nivel_territorio,medida,residencia,unidad,nombre_ine"
    lines = [
        f'{code(i)},EOH,1,{f},{k},{t},x,{m},{r},u,"Serie {i}, con ""coma"""'
        for i, (f, k, t, m, r) in enumerate(CATALOGUE)
    ]
    path.write_text("\n".join([head, *lines]) + "\n", "utf-8")
