"""Ordered classification of organisation names. Rules are data; the first that matches decides."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sendero.functions import text

#: Fixed values: (type, pattern, pattern that must not match), in order.
TYPES: list[tuple[str, str, str]] = [
    ("DATT", r"DATT|DEPARTAMENTO\s+ADMINISTRATIVO\s+DE\s+TRANS", ""),
    ("DIAN", r"\bDIAN\b", ""),
    ("SENA", r"\bSENA\b", "SENAMIHI"),
    ("COLPENSIONES", "COLPENSIONES", ""),
    ("EMCALI", "EMCALI", ""),
    ("CAR", r"CORPORACION\s+AUTONOMA\s+REGIONAL|COORPORACION\s+AUTONOMA|CARDER|CORNARE|\bCVC\b|\bCAS\b.*SANTANDER|CORTOLIMA|CORPOGUAJIRA|CORANTIOQUIA|CORPOCESAR|CORPOAMAZONIA|CORPOBOYACA|CORPOMAG|\bCDMB\b", ""),
    ("RAMA_JUDICIAL", r"RAMA\s+JUDICIAL|DISTRITO\s+JUDICIAL|CONSEJO\s+SUPERIOR|CONSEJO\s+SECCIONAL", "JUZGADO"),
    ("JUZGADO", r"JUZGADO|JUZG\b|JUZSADO|JUZG\s|JUEZ\b", ""),
    ("OFICINA_APOYO", r"OFICINA\s+DE\s+APOYO", ""),
    ("CENTRO_SERVICIOS", r"CENTRO\s+DE\s+SERVICIOS?\s+JUDICIAL", ""),
    ("ALCALDIA", "ALCALDI", ""),
    ("GOBERNACION", r"GOBERNACI|GOBERNACIO\b|GBERANCION|OBERNACION", ""),
    ("SUPERINTENDENCIA", "SUPERINTENDENCIA", ""),
    ("SECRETARIA", "SECRETARI", "SECRGOBERNACION"),
    ("MINISTERIO", "MINISTERIO|MINHACIENDA", ""),
    ("UGPP", r"\bU\.?G\.?P\.?P\.?\b", ""),
    ("MUNICIPIO", r"\bMUNICIPIO\b", ""),
    ("DIRECCION_EJECUTIVA", r"DIRECCION\s+EJECUTIVA", ""),
    ("IDU", r"\bIDU\b|INSTITUTO\s+DE\s+DESARROLLO\s+URBANO", ""),
    ("INSTITUTO_MOVILIDAD", r"INSTITUTO\s+DE\s+MOVILIDAD", ""),
    ("TRANSITO", r"DIRECCION\s+DE\s+TRANSITO|SECRETARIA\s+DE\s+TRANSITO|INSTITUTO\s+DE\s+TRANSITO", ""),
    ("TRIBUNAL", "TRIBUNAL", ""),
    ("FISCALIA", "FISCALI", ""),
    ("ESP", r"EMPRESAS?\s+PUBLICAS?|E\.?\s*S\.?\s*P\.?\s*$", ""),
    ("POLICIA", "POLICI", ""),
    ("CORTE", r"\bCORTE\b", ""),
    ("CONTRALORIA", "CONTRALORI", ""),
    ("PERSONERIA", "PERSONERI", ""),
]
OTHER = "OTRO"
#: Subtypes by type, (subtype, patterns that must all match), in order; '' ends a list that has a default.
SUBTYPES: dict[str, list[tuple[str, list[str]]]] = {
    "DATT": [("TRANSITO", [])],
    "CAR": [("CARDER", ["CARDER"]), ("CVC", ["CVC"]), ("CORNARE", ["CORNARE"]), ("CAS", [r"CAS\b"]), ("CORTOLIMA", ["CORTOLIMA"]), ("CORPOGUAJIRA", ["CORPOGUAJIRA"]), ("CORANTIOQUIA", ["CORANTIOQUIA"]), ("CORPOCESAR", ["CORPOCESAR"]), ("CORPOAMAZONIA", ["CORPOAMAZONIA"]), ("CORPOBOYACA", ["CORPOBOYACA"]), ("CORPOMAG", ["CORPOMAG"]), ("CDMB", ["CDMB"]), ("CRA", [r"CRA\b"]), ("CRQ", [r"CRQ\b"])],
    "JUZGADO": [
        ("PEQUENAS_CAUSAS_LABORAL", ["PEQUENAS CAUSAS.*LABORAL|LABORAL.*PEQUENAS CAUSAS"]),
        ("PEQUENAS_CAUSAS", ["PEQUENAS CAUSAS|COMPETENCIA MULTIPLE"]),
        ("PROMISCUO_FAMILIA", ["PROMISCUO", "FAMILIA"]),
        ("PROMISCUO_MUNICIPAL", ["PROMISCUO"]),
        ("EJECUCION_CIVIL", ["EJECUCION", "CIVIL"]),
        ("EJECUCION_PENAL", ["EJECUCION", "PENAL"]),
        ("EJECUCION", ["EJECUCION"]),
        ("FAMILIA_CIRCUITO", ["FAMILIA", "CIRCUITO"]),
        ("FAMILIA", ["FAMILIA"]),
        ("LABORAL_CIRCUITO", ["LABORAL", "CIRCUITO"]),
        ("LABORAL", ["LABORAL"]),
        ("PENAL_CIRCUITO", ["PENAL", "CIRCUITO"]),
        ("PENAL_MUNICIPAL", ["PENAL", "MUNICIPAL"]),
        ("PENAL", ["PENAL"]),
        ("ADMINISTRATIVO", ["ADMINISTRATIVO"]),
        ("CIVIL_CIRCUITO", ["CIVIL", "CIRCUITO"]),
        ("CIVIL_MUNICIPAL", ["CIVIL", "MUNICIPAL"]),
        ("CIVIL", ["CIVIL"]),
        ("MUNICIPAL", ["MUNICIPAL"]),
    ],
    "OFICINA_APOYO": [("CIVIL_MUNICIPAL", ["CIVIL", "MUNICIPAL"]), ("CIVIL", ["CIVIL"]), ("LABORAL", ["LABORAL"])],
    "SUPERINTENDENCIA": [("SOCIEDADES", ["SOCIEDADES"]), ("INDUSTRIA_COMERCIO", ["INDUSTRIA|COMERCIO"]), ("SALUD", ["SALUD"]), ("FINANCIERA", ["FINANCIERA"]), ("NOTARIADO", ["NOTARIADO"]), ("PUERTOS_TRANSPORTE", ["PUERTOS|TRANSPORTE"]), ("SUBSIDIO_FAMILIAR", ["SUBSIDIO"]), ("SERVICIOS_PUBLICOS", ["SERVICIO", "PUBLICO"]), ("VIGILANCIA", ["VIGILANCIA"]), ("OTRA", [])],
    "SECRETARIA": [("TRANSITO", ["TRANSITO|TRANSPORTE|MOVILIDAD"]), ("HACIENDA", ["HACIENDA"]), ("GOBIERNO", ["GOBIERNO"]), ("EDUCACION", ["EDUCACION"]), ("SALUD", ["SALUD"]), ("OTRA", [])],
    "MINISTERIO": [("TRABAJO", ["TRABAJO"]), ("HACIENDA", ["HACIENDA"]), ("DEFENSA", ["DEFENSA"]), ("EDUCACION", ["EDUCACION"]), ("SALUD", ["SALUD"])],
    "TRIBUNAL": [("ADMINISTRATIVO", ["ADMINISTRATIVO"]), ("SUPERIOR", ["SUPERIOR"])],
    "CORTE": [("SUPREMA", ["SUPREMA"]), ("CONSTITUCIONAL", ["CONSTITUCIONAL"])],
}
#: Types that keep a number, judicial types, places of types that name none.
NUMBERED = ["JUZGADO", "FISCALIA"]
JUDICIAL = ["JUZGADO", "TRIBUNAL", "CORTE", "RAMA_JUDICIAL", "CENTRO_SERVICIOS", "OFICINA_APOYO", "FISCALIA", "DIRECCION_EJECUTIVA"]
DEFAULT_PLACE = {"DATT": ("Cartagena de Indias", "Bolívar"), "EMCALI": ("Cali", "Valle del Cauca")}


def entity_type(clean: Column) -> Column:
    """The type of a cleaned, accent-free name."""
    chain = F
    for name, yes, no in TYPES:
        chain = chain.when(clean.rlike(yes) & ~clean.rlike(no) if no else clean.rlike(yes), name)
    return chain.otherwise(OTHER)


def subtype(kind: Column, clean: Column) -> Column:
    """The subtype within a type, '' if none."""
    chain = F
    for of, rules in SUBTYPES.items():
        for name, patterns in rules:
            chain = chain.when(reduce(lambda a, b: a & b, [clean.rlike(p) for p in patterns], kind == of), name)
    tail = F.substring(F.trim(F.regexp_extract(clean, "MINISTERIO(.*)$", 1)), 1, 25)
    return chain.when(kind == "MINISTERIO", tail).otherwise("")


def classified(names: DataFrame) -> DataFrame:
    """names(raw, ...) with clean, tipo, subtipo and numero."""
    out = names.withColumn("clean", text.clean_text(F.col("raw")))
    out = out.withColumn("tipo", entity_type(F.col("clean")))
    number = F.when(F.col("tipo").isin(*NUMBERED), text.extract_number(F.col("raw"))).otherwise("")
    return out.withColumns({"subtipo": subtype(F.col("tipo"), F.col("clean")), "numero": number})


def with_default_places(placed: DataFrame) -> DataFrame:
    """placed(tipo, municipio, departamento, ...) with the places of types that name none."""
    for kind, (city, dept) in DEFAULT_PLACE.items():
        own = F.col("tipo") == kind
        placed = placed.withColumns({"municipio": F.when(own, F.coalesce("municipio", F.lit(city))).otherwise(F.col("municipio")), "departamento": F.when(own, F.coalesce("departamento", F.lit(dept))).otherwise(F.col("departamento"))})
    return placed
