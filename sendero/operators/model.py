"""Star model, dedup, first children, splits and enrichment."""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sendero.functions.classify import JUDICIAL
from sendero.sources.stage import broadcast_if_small, staged

#: What a status is worth when duplicates compete, and statuses that never enter the model.
PRIORITY = {"PROCESADO": 1, "RECONFIRMADO": 2, "CONFIRMADO": 3, "PROCESADO_CON_ERRORES": 4, "EN_PROCESO": 5, "SIN_CONFIRMAR": 6}
LEAST_PRIORITY = 99
EXCLUDED = ["SIN_CONFIRMAR"]
#: Column types of the fact and dimension tables.
SCHEMAS = {
    "dim_departamentos": "departamento_id int, nombre string",
    "dim_municipios": "municipio_id int, nombre string, departamento_id int",
    "dim_entidades": "entidad_id int, nombre_normalizado string, tipo string, subtipo string, municipio_id int, departamento_id int, total_registros bigint, num_variantes bigint",
    "dim_variantes": "variante_id int, entidad_id int, nombre_normalizado string, variante_original string, conteo bigint",
    "dim_entidad_bancaria": "entidad_bancaria_id int, nombre string",
    "fact_oficios": "oficio_id string, entidad_remitente_id int, entidad_bancaria_id int, estado string, numero_oficio string, fecha_oficio date, fecha_recepcion date, titulo_embargo string, titulo_orden string, monto decimal(20,2), monto_a_embargar decimal(20,2), nombre_demandado string, id_demandado string, tipo_id_demandado string, direccion_remitente string, correo_remitente string, nombre_funcionario string, municipio_id int, departamento_id int, fuente_ubicacion string, referencia string, expediente string, created_at timestamp_ntz, confirmed_at timestamp_ntz, processed_at timestamp_ntz",
}


def columns(table: str) -> list[tuple[str, str]]:
    """(name, type) of a table's columns."""
    return [tuple(c.split(" ")) for c in SCHEMAS[table].split(", ")]


def ddl(table: str) -> str:
    """CREATE TABLE text of a table of the model."""
    return f"CREATE TABLE {table} ({SCHEMAS[table]})"


def typed(rows: DataFrame, table: str) -> DataFrame:
    """All-string rows in the types of a table; blanks and what cannot be read become null."""
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit("")) if c in rows.columns else F.lit(None).cast("string")
    return rows.select(*[(blank(c) if kind == "string" else blank(c).try_cast(kind)).alias(c) for c, kind in columns(table)])


def known_status(status: Column) -> Column:
    """Rows of the model: any status but the excluded ones; no status counts as one."""
    return ~F.coalesce(status, F.lit("")).isin(*EXCLUDED)


def first_child(parents: DataFrame, children: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """parents with the columns of their first child in the given order, null without one."""
    first = children.withColumn("rn", F.row_number().over(W.partitionBy(key).orderBy(*order))).filter("rn = 1").drop("rn")
    return parents.join(first, key, "left")


def priority(status: Column, table: dict[str, int] = PRIORITY) -> Column:
    made = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(made, status), F.lit(LEAST_PRIORITY))


def dedup_by_priority(fact: DataFrame, number: str, key: list[Column], status: Column, id_col: str, table: dict[str, int] = PRIORITY) -> DataFrame:
    """fact with `keep`: rows without a number all stay; of the others one for each key (nulls are equal), that of the
    best status and then of the greatest id as text."""
    best = F.row_number().over(W.partitionBy(*key).orderBy(priority(status, table), F.desc(F.col(id_col).cast("string"))))
    numbered = fact.filter(F.col(number).isNotNull()).withColumn("keep", best == 1)
    return numbered.unionByName(fact.filter(F.col(number).isNull()).withColumn("keep", F.lit(True)))


def judicial(kind: Column) -> Column:
    return kind.isin(*JUDICIAL)


def release_pairs(events: DataFrame, released: Column, ordered: Column, secondary: str, id_col: str) -> DataFrame:
    """Releases joined with the order that their secondary id names."""
    orders = events.filter(ordered).select(*[F.col(c).alias(f"order_{c}") for c in events.columns])
    return events.filter(released).join(orders, F.col(secondary) == F.col(f"order_{id_col}"))


def cascade(rows: DataFrame, id_col: str, levels: list[DataFrame]) -> DataFrame:
    """The first level of matches (id, ...) that has a row's id, with its number from 1."""
    out, rest = None, rows.select(id_col)
    for k, level in enumerate(levels, 1):
        found = rest.join(level, id_col).withColumn("nivel", F.lit(k))
        rest = rest.join(level.select(id_col), id_col, "left_anti")
        out = found if out is None else out.unionByName(found)
    return out


def not_deleted(rows: DataFrame, mark: str = "deleted") -> DataFrame:
    """Rows whose mark of deletion is false; unknown counts as marked."""
    return rows.filter(F.col(mark).cast("boolean") == F.lit(False))


def numbered(rows: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """rows with 1..n in the given order: sorted by ranges, each range numbered from the count of those before it."""
    part = F.spark_partition_id()
    placed = staged(rows.orderBy(*order).withColumns({"_part": part, "_at": F.monotonically_increasing_id() - F.shiftleft(part.cast("bigint"), 33)}), "numbered")
    counts = placed.groupBy("_part").count().orderBy("_part").collect()  # one row a partition
    if not counts:
        return rows.withColumn(name, F.lit(0).cast("bigint"))
    before = list(accumulate((r["count"] for r in counts), initial=0))[:-1]
    starts = rows.sparkSession.createDataFrame(pa.table({"_part": pa.array([r["_part"] for r in counts], pa.int32()), "_start": pa.array(before, pa.int64())}))
    return placed.join(broadcast_if_small(starts, len(counts), 16), "_part").withColumn(name, F.col("_start") + F.col("_at") + 1).drop("_part", "_at", "_start")


#: Tables in an order in which none refers to a later one.
LOAD_ORDER = ["dim_departamentos", "dim_municipios", "dim_entidad_bancaria", "dim_entidades", "dim_variantes", "fact_oficios"]


def rebuild_ddl() -> list[str]:
    """Statements that drop all tables, referring ones first, and create them again."""
    return [f"DROP TABLE IF EXISTS {t}" for t in reversed(LOAD_ORDER)] + [ddl(t) for t in LOAD_ORDER]
