"""Enrichment of entities from registries, and the unified entity dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sendero.functions.text import blank_if, norm_registry
from sendero.operators import match

#: Texts that mean no value in the registries.
NO_VALUE = ["", "NULL", "NONE", "NAN"]
#: Columns of the three entity tables of the third model.
COERCIVE = "entidad_id nombre_extraido nombre_real ciudad email_extraido email_real nit cod_institucion orden sector naturaleza_juridica tipo_institucion direccion telefono pagina_web estado representante cargo_representante total_registros".split()
JUDICIAL = "entidad_id nombre_extraido nombre_real ciudad email_extraido email_real codigo_despacho numero_despacho jurisdiccion distrito circuito juez direccion telefono area total_registros".split()
UNIFIED = "entidad_id nombre_normalizado nombre_real tipo subtipo categoria nit cod_institucion email direccion telefono ciudad municipio_id departamento_id orden sector naturaleza_juridica estado representante total_registros num_variantes".split()
#: What each table takes from its registry, and what of that is put in capitals.
FROM_COERCIVE = "nombre_real nit cod_institucion email_real orden sector naturaleza_juridica tipo_institucion direccion telefono pagina_web estado representante cargo_representante".split()
FROM_JUDICIAL = "nombre_real codigo_despacho jurisdiccion distrito circuito juez direccion telefono area".split()
AS_SPELLED = {"nit", "cod_institucion", "codigo_despacho", "telefono", "pagina_web"}
LEAST = 0.60


def cleaned(col: Column) -> Column:
    """The stripped text, '' for null and for texts that mean no value."""
    return blank_if(F.coalesce(col, F.lit("")), NO_VALUE, F.upper)


def capitals(col: Column) -> Column:
    return F.upper(cleaned(col))


def registry(rows: DataFrame, taken: list[str], name: str = "nombre", city: str | None = None) -> DataFrame:
    """(rid, rnorm, the columns taken) of a registry with rid; rows whose name has no word character are left out."""
    out = rows.withColumn("rnorm", norm_registry(cleaned(F.col(name)))).filter("rnorm <> ''")
    source = {"nombre_real": F.col(name)}
    values = [(cleaned if c in AS_SPELLED else capitals)(source.get(c, F.col(c) if c in rows.columns else F.lit(""))).alias(c) for c in taken]
    return out.select("rid", "rnorm", *values, *([capitals(F.col(city)).alias("ciudad_registro")] if city else []))


def _matched(entities: DataFrame, listed: DataFrame, taken: list[str]) -> DataFrame:
    """entities with what the best registry row holds, '' without one."""
    named = entities.select(F.col("entidad_id").alias("id"), norm_registry(cleaned(F.col("nombre_extraido"))).alias("norm")).filter("norm <> ''")
    best = match.best_matches(named, listed.select("rid", "rnorm"), match.jaccard, LEAST).select(F.col("id").alias("entidad_id"), "rid")
    extra = [c for c in listed.columns if c not in ("rid", "rnorm")]
    found = entities.join(best, "entidad_id", "left").join(listed.drop("rnorm"), "rid", "left")
    return found.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in extra})


def _filled(own: Column, other: Column) -> Column:
    """own, or other where own is blank."""
    return F.coalesce(F.nullif(own, F.lit("")), other)


def enrich_coercive(entities: DataFrame, listed: DataFrame) -> DataFrame:
    """entities(entidad_id, nombre_extraido, ciudad, email_extraido, total_registros) with the registry of institutions; a missing mail is filled from it."""
    out = _matched(entities, listed, FROM_COERCIVE).withColumns({c: capitals(F.col(c)) for c in ("nombre_extraido", "ciudad", "email_extraido")})
    return out.withColumn("email_extraido", _filled(F.col("email_extraido"), F.col("email_real"))).select(*COERCIVE)


def enrich_judicial(entities: DataFrame, listed: DataFrame) -> DataFrame:
    """entities(..., numero_despacho) with the registry of courts; a missing city is filled from it."""
    out = _matched(entities, listed, FROM_JUDICIAL).withColumns({c: capitals(F.col(c)) for c in ("nombre_extraido", "ciudad", "email_extraido", "numero_despacho")})
    return out.withColumns({"ciudad": _filled(F.col("ciudad"), F.col("ciudad_registro")), "email_real": F.lit("")}).select(*JUDICIAL)


def unified(base: DataFrame, coercive: DataFrame, judicial: DataFrame) -> DataFrame:
    """The 21 columns of every entity of both tables; base has its name, type, place and variants, '' or 0 where it lacks an entity."""
    blank = F.lit("")
    common = ["entidad_id", "nombre_extraido", "nombre_real", "direccion", "telefono", "ciudad", "total_registros"]
    a = coercive.select(*common, F.lit("COACTIVA").alias("categoria"), "nit", "cod_institucion", _filled(F.col("email_extraido"), F.col("email_real")).alias("email"), "orden", "sector", "naturaleza_juridica", "estado", "representante")
    b = judicial.select(*common, F.lit("JUDICIAL").alias("categoria"), blank.alias("nit"), F.col("codigo_despacho").alias("cod_institucion"), F.col("email_extraido").alias("email"), F.col("jurisdiccion").alias("orden"), F.col("area").alias("sector"), blank.alias("naturaleza_juridica"), blank.alias("estado"), F.col("juez").alias("representante"))
    own = base.select("entidad_id", "nombre_normalizado", "tipo", "subtipo", "municipio_id", "departamento_id", "num_variantes")
    out = a.unionByName(b).join(own, "entidad_id", "left")
    filled = {"nombre_normalizado": capitals(F.coalesce("nombre_normalizado", "nombre_extraido")), "tipo": capitals(F.col("tipo")), "subtipo": capitals(F.col("subtipo")), "num_variantes": F.coalesce(F.col("num_variantes"), F.lit(0))}
    return out.withColumns(filled).select(*UNIFIED)
