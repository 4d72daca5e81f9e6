"""Deterministic sender names on orders, by the same expression for Spark and for DuckDB.

The test tables hold clean data only; accents, ordinals, typos, missing cities, case and spacing variants come from here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sendero.plans.registry import table

PREFIXES = ["JUZGADO", "JUZGADO", "Juzgado", "ALCALDÍA MUNICIPAL", "ALCALDIA", "GOBERNACIÓN", "SECRETARÍA DE HACIENDA", "SECRETARIA DE TRANSITO Y TRANSPORTE", "TRIBUNAL SUPERIOR", "FISCALÍA 21", "SUPERINTENDENCIA DE SOCIEDADES", "CORPOBOYACA", "DIAN SECCIONAL", "MUNICIPIO", "OFICINA DE APOYO CIVIL MUNICIPAL", "MINISTERIO DE TRABAJO", "EMPRESAS PUBLICAS", "Oficina de cobro"]
ORDINALS = ["PRIMERO", "SEGUNDO", "TERCERA", "DÉCIMO PRIMERO", "VIGÉSIMO CUARTO", "TREINTA Y DOS", "ONCE", "07", "12", "CUARENTA Y UN"]
SPECIALTIES = ["CIVIL MUNICIPAL", "CIVIL DEL CIRCUITO", "PROMISCUO MUNICIPAL", "PENAL MUNICIPAL", "LABORAL DEL CIRCUITO", "DE FAMILIA", "DE EJECUCIÓN CIVIL", "DE PEQUENAS CAUSAS"]
CITIES = ["MEDELLÍN", "BOGOTÁ D.C.", "CARTAGENA DE INDIAS", "PEREIRA", "CÚCUTA", "SANTA MARTA", "IBAGUÉ", "TUNJA", "SAN GIL", "ARMENIA", "ARMENIA ANTIOQUIA", "CÓRDOBA", "SANTIAGO DE CALI", "POPAYAN", "PEREYRA", "MEDELIN", "", "", "VALLE DEL CAUCA", "SUCRE"]


def _expression(pick) -> tuple[str, str]:
    """(raw sender, raw city) over orders."""
    m = "(o_custkey % 240)"
    prefix = pick(PREFIXES, f"{m} % 18")
    ordinal = pick(ORDINALS, f"CAST(floor({m} / 18) AS INT) % 10")
    special = pick(SPECIALTIES, f"({m} * 7) % 8")
    city = pick(CITIES, f"({m} * 11) % 20")
    name = f"{prefix} || CASE WHEN {m} % 18 < 3 THEN ' ' || {ordinal} || ' ' || {special} ELSE '' END || CASE WHEN {city} = '' THEN '' ELSE ' DE ' || {city} END"
    v = "(o_orderkey % 6)"
    raw = f"CASE WHEN {v} = 1 THEN lower({name}) WHEN {v} = 2 THEN replace({name}, ' ', '  ') WHEN {v} = 3 THEN '\"' || {name} || '\"' WHEN {v} = 4 THEN {name} || ' (COPIA).' WHEN {v} = 5 THEN ' - ' || {name} || ' ;' ELSE {name} END"
    where = f"CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 7 = 1 THEN lower({city}) WHEN o_orderkey % 7 = 2 THEN {city} || ' - VALLE' ELSE {city} END"
    return raw, where


def _quoted(items: list[str]) -> str:
    return ", ".join(f"'{x}'" for x in items)


SPARK = _expression(lambda items, i: f"element_at(array({_quoted(items)}), CAST({i} AS INT) + 1)")
DUCK = _expression(lambda items, i: f"list_extract([{_quoted(items)}], CAST({i} AS INT) + 1)")
#: Common table expressions: s, all orders with their sender; u, the distinct senders and their counts.
SENDERS = f"s AS (SELECT *, {DUCK[0]} AS raw, {DUCK[1]} AS ciudad FROM orders), u AS (SELECT raw, CAST(count(*) AS BIGINT) AS n, min(o_orderkey) AS seen FROM s GROUP BY raw)"


def senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with raw (the sender's name as spelled) and ciudad."""
    return table(spark, sf_dir, "orders").withColumns({"raw": F.expr(SPARK[0]), "ciudad": F.expr(SPARK[1])})


def distinct_senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw, n, seen (the first order): whatever is dear is done once for each spelling."""
    return senders(spark, sf_dir).groupBy("raw").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("seen"))
