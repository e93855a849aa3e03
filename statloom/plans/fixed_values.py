"""Fixed values of the published statistics.

Everything in this file is data that has to match the sources and the published tables:
word lists, code tables and patterns. There is no logic here.
"""

from __future__ import annotations

# Month names, January to December.
MONTH_NAMES = (
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
)

# Sources of a fact row.
OFFICE = "INE"
PORTAL = "murciaturistica"

# Region and accommodation type that both sources cover.
REGION = "region-murcia"
HOTEL = "hotel"
RESIDENTS = "espana"
FOREIGNERS = "extranjero"

# Label of the generated member, leaf level, provisional code, base year.
RESIDUAL_SUFFIX = " (no desglosado)"
NOT_BROKEN_DOWN = "(no desglosado)"
LEAF_LEVEL = "destino_mt"
PROVISIONAL = 2
BASE_YEAR = 2019
HIGH_MONTH, LOW_MONTH = 8, 1
SUMMER = (6, 7, 8, 9)

# Tolerances of the cross-source checks.
ABSOLUTE_TOLERANCE = 10
RELATIVE_TOLERANCE = 0.0005
RESIDENCE_TOLERANCE = 0.05
BALANCE_TOLERANCE = 0.5
MAX_MONTHS_OLD = 4

# Names of the monthly pages.
PAGE_GLOB = "destinos_*.html"
PAGE_NAME = r"destinos_(\d{4})-(\d{2})\.html"
HEADER_ROWS = 2

# Territories (id, name, level, parent, source, name in the source).
TERRITORIES = (
    ("espana", "España", "pais", None, "INE", None),
    ("region-murcia", "Región de Murcia", "region", "espana", "INE", None),
    ("costa-calida", "Costa Cálida", "zona_ine", "region-murcia", "INE", None),
    ("cartagena", "Cartagena (municipio)", "punto_ine", "region-murcia", "INE", None),
    ("murcia-municipio", "Murcia (municipio)", "punto_ine", "region-murcia", "INE", None),
    ("zona-ciudad", "Ciudad", "zona_mt", "region-murcia", "murciaturistica", "Total Ciudad"),
    ("zona-costa", "Costa", "zona_mt", "region-murcia", "murciaturistica", "Total Costa"),
    ("zona-interior", "Interior", "zona_mt", "region-murcia", "murciaturistica", "Total Interior"),
    ("destino-murcia-ciudad", "Murcia Ciudad", "destino_mt", "zona-ciudad", "murciaturistica", "Murcia Ciudad"),
    ("destino-cartagena", "Cartagena", "destino_mt", "zona-ciudad", "murciaturistica", "Cartagena"),
    ("destino-lorca-puerto-lumbreras", "Lorca / Puerto Lumbreras", "destino_mt", "zona-ciudad", "murciaturistica", "Lorca / Puerto Lumbreras"),
    ("destino-ciudad-no-desglosado", "Ciudad (no desglosado)", "destino_mt", "zona-ciudad", "murciaturistica", "Ciudad (no desglosado)"),
    ("destino-la-manga", "La Manga", "destino_mt", "zona-costa", "murciaturistica", "La Manga"),
    ("destino-resto-mar-menor", "Resto Mar Menor", "destino_mt", "zona-costa", "murciaturistica", "Resto Mar Menor"),
    ("destino-mazarron", "Mazarrón", "destino_mt", "zona-costa", "murciaturistica", "Mazarrón"),
    ("destino-aguilas", "Águilas", "destino_mt", "zona-costa", "murciaturistica", "Águilas"),
    ("destino-costa-no-desglosado", "Costa (no desglosado)", "destino_mt", "zona-costa", "murciaturistica", "Costa (no desglosado)"),
    ("destino-noroeste", "Noroeste", "destino_mt", "zona-interior", "murciaturistica", "Noroeste"),
    ("destino-valle-ricote-balnearios", "Valle de Ricote / Balnearios", "destino_mt", "zona-interior", "murciaturistica", "V.Ricote / Balnearios"),
    ("destino-centro", "Centro", "destino_mt", "zona-interior", "murciaturistica", "Centro"),
    ("destino-altiplano-este", "Altiplano / Este", "destino_mt", "zona-interior", "murciaturistica", "Altiplano / Este"),
    ("destino-interior-no-desglosado", "Interior (no desglosado)", "destino_mt", "zona-interior", "murciaturistica", "Interior (no desglosado)"),
)

# Published labels (label, zone, row type).
PUBLISHED_LABELS = (
    ("Murcia Ciudad", "ciudad", "destino"),
    ("Cartagena", "ciudad", "destino"),
    ("Lorca / Puerto Lumbreras", "ciudad", "destino"),
    ("La Manga", "costa", "destino"),
    ("Resto Mar Menor", "costa", "destino"),
    ("Mazarrón", "costa", "destino"),
    ("Águilas", "costa", "destino"),
    ("Noroeste", "interior", "destino"),
    ("V.Ricote / Balnearios", "interior", "destino"),
    ("Centro", "interior", "destino"),
    ("Altiplano / Este", "interior", "destino"),
    ("Subtotal La Manga + Resto Mar Menor", "costa", "subtotal"),
    ("Subtotal Águilas + Mazarrón", "costa", "subtotal"),
    ("Total Ciudad", "ciudad", "total_zona"),
    ("Total Costa", "costa", "total_zona"),
    ("Total Interior", "interior", "total_zona"),
    ("Totales", None, "total_region"),
)

# Accommodation types and residences.
ACCOMMODATION_TYPES = (
    ("hotel", "Hoteles", "EOH"),
    ("apartamento", "Apartamentos turísticos", "EOAP"),
    ("camping", "Campings", "EOAC"),
    ("rural", "Alojamientos de turismo rural", "EOTR"),
)
RESIDENCES = (
    ("espana", "Residentes en España"),
    ("extranjero", "Residentes en el extranjero"),
)

# Zone label of each parent territory.
ZONES = {"zona-costa": "costa", "zona-ciudad": "ciudad"}
OTHER_ZONE = "interior"

# Source tables (number, survey, accommodation type, fact) in order of preference.
SOURCE_TABLES = (
    (2074, "EOH", "hotel", "demanda"),
    (2039, "EOH", "hotel", "demanda"),
    (2078, "EOH", "hotel", "demanda"),
    (2066, "EOH", "hotel", "oferta"),
    (2013, "EOH", "hotel", "oferta"),
    (2076, "EOH", "hotel", "oferta"),
    (2063, "EOAP", "apartamento", "demanda"),
    (2019, "EOAP", "apartamento", "demanda"),
    (2082, "EOAP", "apartamento", "demanda"),
    (2072, "EOAP", "apartamento", "oferta"),
    (2022, "EOAP", "apartamento", "oferta"),
    (2083, "EOAP", "apartamento", "oferta"),
    (2062, "EOAC", "camping", "demanda"),
    (2047, "EOAC", "camping", "demanda"),
    (2084, "EOAC", "camping", "demanda"),
    (2064, "EOAC", "camping", "oferta"),
    (2049, "EOAC", "camping", "oferta"),
    (2085, "EOAC", "camping", "oferta"),
    (2073, "EOTR", "rural", "demanda"),
    (2070, "EOTR", "rural", "oferta"),
    (12156, "IPH", "hotel", "precios"),
)

# Territories in the metadata (variable, value, territory, level).
METADATA_TERRITORIES = (
    ("Comunidades y Ciudades Autónomas", "Murcia, Región de", "region-murcia", "region"),
    ("Provincias", "Murcia", "region-murcia", "region"),
    ("ZONAS TURÍSTICAS", "Murcia (Región De): Costa Cálida", "costa-calida", "zona"),
    ("PUNTOS TURISTÍCOS", "Cartagena", "cartagena", "punto"),
    ("PUNTOS TURISTÍCOS", "Murcia", "murcia-municipio", "punto"),
    ("Totales Territoriales", "Total Nacional", "espana", "pais"),
)
PRICES_ONLY = "espana"

# Metadata variables and the values that mean «everything».
CATEGORY, ALL_CATEGORIES = "TIPO DE CATEGORIA", "Total categorías"
RESIDENCE, ALL_RESIDENCES = "RESIDENCIA/ORIGEN", "Total"
DATA_TYPE, PLAIN_DATA = "Tipo de dato", "Dato"
CONCEPT = "Concepto turístico"

# Concepts, price data types and residences of the metadata.
MEASURES = {
    "Viajero": "viajeros",
    "Pernoctaciones": "pernoctaciones",
    "Número de establecimientos abiertos estimados": "establecimientos",
    "Número de habitaciones estimadas": "habitaciones",
    "Número de plazas estimadas": "plazas",
    "Número de apartamentos estimados": "apartamentos",
    "Número de parcelas": "parcelas",
    "Parcelas ocupadas": "parcelas_ocupadas",
    "Personal empleado": "personal_empleado",
    "Grado de ocupación por plazas": "ocupacion_plazas",
    "Grado de ocupación por plazas en fin de semana": "ocupacion_plazas_fin_semana",
    "Grado de ocupación por habitaciones": "ocupacion_habitaciones",
    "Grado de ocupación por apartamentos": "ocupacion_apartamentos",
    "Grado de ocupación por apartamentos en fin de semana": "ocupacion_apartamentos_fin_semana",
    "Grado de ocupación por parcelas": "ocupacion_parcelas",
    "Grado de ocupación de parcelas en fin de semana": "ocupacion_parcelas_fin_semana",
}
PRICE_MEASURES = {
    "Índice": "indice_precios",
    "Tasa de variación interanual": "variacion_interanual_precios",
}
METADATA_RESIDENCES = {
    "Residentes en España": "espana",
    "Residentes en el Extranjero": "extranjero",
    "Residentes en el extranjero": "extranjero",
}

# Sources named in the contract of the package and its version.
CONTRACT_VERSION = "1.0.0"
CONTRACT_SOURCES = ("INE (EOH, EOAP, EOAC, EOTR, IPH)", "murciaturistica.es (CREM)")

# Accepted values of the declared checks.
LEVELS = ("pais", "region", "zona_ine", "punto_ine", "zona_mt", "destino_mt")
FACTS = ("demanda", "oferta", "precios")
ROW_TYPES = ("destino", "subtotal", "total_zona", "total_region")
