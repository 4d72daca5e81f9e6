"""The third model as a database has it: tables with keys, references and indexes, and the views over them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from sendero.functions.classify import JUDICIAL
from sendero.sources.load import Rules

#: Tables in an order in which none refers to a later one; (column, type, more) of each.
TABLES: dict[str, list[tuple[str, str, str]]] = {
    "dim_departamentos": [("departamento_id", "INTEGER", "NOT NULL"), ("nombre", "VARCHAR(100)", "NOT NULL UNIQUE")],
    "dim_municipios": [("municipio_id", "INTEGER", "NOT NULL"), ("nombre", "VARCHAR(150)", "NOT NULL"), ("departamento_id", "INTEGER", "NOT NULL")],
    "dim_entidades": [
        ("entidad_id", "INTEGER", "NOT NULL"), ("nombre_normalizado", "VARCHAR(500)", "NOT NULL"), ("nombre_real", "VARCHAR(500)", ""), ("tipo", "VARCHAR(50)", ""), ("subtipo", "VARCHAR(50)", ""),
        ("categoria", "VARCHAR(20)", ""), ("nit", "VARCHAR(50)", ""), ("cod_institucion", "VARCHAR(50)", ""), ("email", "VARCHAR(200)", ""), ("direccion", "VARCHAR(500)", ""), ("telefono", "VARCHAR(100)", ""),
        ("ciudad", "VARCHAR(150)", ""), ("municipio_id", "INTEGER", ""), ("departamento_id", "INTEGER", ""), ("orden", "VARCHAR(50)", ""), ("sector", "VARCHAR(100)", ""), ("naturaleza_juridica", "VARCHAR(100)", ""),
        ("estado", "VARCHAR(30)", ""), ("representante", "VARCHAR(200)", ""), ("total_registros", "INTEGER", "DEFAULT 0"), ("num_variantes", "INTEGER", "DEFAULT 0"),
    ],
    "dim_entidades_coactivas": [
        ("entidad_id", "INTEGER", "NOT NULL"), ("nombre_extraido", "VARCHAR(500)", "NOT NULL"), ("nombre_real", "VARCHAR(500)", ""), ("ciudad", "VARCHAR(150)", ""), ("email_extraido", "VARCHAR(200)", ""), ("email_real", "VARCHAR(200)", ""),
        ("nit", "VARCHAR(50)", ""), ("cod_institucion", "VARCHAR(50)", ""), ("orden", "VARCHAR(50)", ""), ("sector", "VARCHAR(100)", ""), ("naturaleza_juridica", "VARCHAR(100)", ""), ("tipo_institucion", "VARCHAR(100)", ""),
        ("direccion", "VARCHAR(500)", ""), ("telefono", "VARCHAR(100)", ""), ("pagina_web", "VARCHAR(200)", ""), ("estado", "VARCHAR(30)", ""), ("representante", "VARCHAR(200)", ""), ("cargo_representante", "VARCHAR(200)", ""), ("total_registros", "INTEGER", "DEFAULT 0"),
    ],
    "dim_entidades_judiciales": [
        ("entidad_id", "INTEGER", "NOT NULL"), ("nombre_extraido", "VARCHAR(500)", "NOT NULL"), ("nombre_real", "VARCHAR(500)", ""), ("ciudad", "VARCHAR(150)", ""), ("email_extraido", "VARCHAR(200)", ""), ("email_real", "VARCHAR(200)", ""),
        ("codigo_despacho", "VARCHAR(20)", ""), ("numero_despacho", "VARCHAR(20)", ""), ("jurisdiccion", "VARCHAR(50)", ""), ("distrito", "VARCHAR(100)", ""), ("circuito", "VARCHAR(100)", ""), ("juez", "VARCHAR(200)", ""),
        ("direccion", "VARCHAR(500)", ""), ("telefono", "VARCHAR(100)", ""), ("area", "VARCHAR(50)", ""), ("total_registros", "INTEGER", "DEFAULT 0"),
    ],
    "dim_variantes": [("variante_id", "INTEGER", "NOT NULL"), ("entidad_id", "INTEGER", "NOT NULL"), ("nombre_normalizado", "VARCHAR(500)", ""), ("variante_original", "VARCHAR(500)", "NOT NULL"), ("conteo", "INTEGER", "DEFAULT 0")],
    "fact_oficios": [
        ("oficio_id", "VARCHAR(20)", "NOT NULL"), ("entidad_remitente_id", "INTEGER", ""), ("entidad_bancaria_id", "INTEGER", ""), ("estado", "VARCHAR(30)", ""), ("numero_oficio", "VARCHAR(100)", ""), ("fecha_oficio", "DATE", ""), ("fecha_recepcion", "DATE", ""),
        ("titulo_embargo", "VARCHAR(50)", ""), ("titulo_orden", "VARCHAR(50)", ""), ("monto", "DECIMAL(18,2)", ""), ("monto_a_embargar", "DECIMAL(18,2)", ""), ("nombre_demandado", "VARCHAR(300)", ""), ("id_demandado", "VARCHAR(30)", ""), ("tipo_id_demandado", "VARCHAR(20)", ""),
        ("direccion_remitente", "VARCHAR(500)", ""), ("correo_remitente", "VARCHAR(200)", ""), ("nombre_funcionario", "VARCHAR(200)", ""), ("municipio_id", "INTEGER", ""), ("departamento_id", "INTEGER", ""), ("fuente_ubicacion", "VARCHAR(30)", ""), ("referencia", "VARCHAR(200)", ""),
        ("expediente", "VARCHAR(200)", ""), ("created_at", "TIMESTAMP", ""), ("confirmed_at", "TIMESTAMP", ""), ("processed_at", "TIMESTAMP", ""),
    ],
}
#: What a table's columns refer to, and the columns with an index.
REFERS = {
    "dim_municipios": [("departamento_id", "dim_departamentos", "departamento_id")],
    "dim_entidades": [("municipio_id", "dim_municipios", "municipio_id"), ("departamento_id", "dim_departamentos", "departamento_id")],
    "dim_entidades_coactivas": [("entidad_id", "dim_entidades", "entidad_id")],
    "dim_entidades_judiciales": [("entidad_id", "dim_entidades", "entidad_id")],
    "dim_variantes": [("entidad_id", "dim_entidades", "entidad_id")],
    "fact_oficios": [("entidad_remitente_id", "dim_entidades", "entidad_id"), ("municipio_id", "dim_municipios", "municipio_id"), ("departamento_id", "dim_departamentos", "departamento_id")],
}
INDEXES = {
    "idx_municipios_depto": ("dim_municipios", "departamento_id"),
    "idx_entidades_tipo": ("dim_entidades", "tipo"),
    "idx_entidades_cat": ("dim_entidades", "categoria"),
    "idx_entidades_muni": ("dim_entidades", "municipio_id"),
    "idx_entidades_depto": ("dim_entidades", "departamento_id"),
    "idx_variantes_entidad": ("dim_variantes", "entidad_id"),
    "idx_oficios_entidad": ("fact_oficios", "entidad_remitente_id"),
    "idx_oficios_estado": ("fact_oficios", "estado"),
    "idx_oficios_muni": ("fact_oficios", "municipio_id"),
    "idx_oficios_depto": ("fact_oficios", "departamento_id"),
    "idx_oficios_fecha": ("fact_oficios", "fecha_oficio"),
}
VIEWS = {"vista_entidades_judiciales": "IN", "vista_entidades_coactivas": "NOT IN"}


def rules(table: str) -> Rules:
    """What a load of a table must keep: its first column tells its rows apart, references have a row."""
    return Rules(key=(TABLES[table][0][0],), refers=tuple(REFERS.get(table, [])))


def create_table(table: str) -> str:
    columns = [" ".join(x for x in column if x) for column in TABLES[table]]
    keys = [f"PRIMARY KEY ({TABLES[table][0][0]})", *[f"FOREIGN KEY ({c}) REFERENCES {to} ({key})" for c, to, key in REFERS.get(table, [])]]
    return f"CREATE TABLE {table} ({', '.join(columns + keys)})"


def view(name: str) -> str:
    """The SELECT of a view: entities of judicial types, or all others, with the name of their municipality."""
    kinds = ", ".join(f"'{k}'" for k in JUDICIAL)
    return f"SELECT e.entidad_id, e.nombre_normalizado AS nombre_extraido, e.tipo, e.subtipo, m.nombre AS ciudad, e.total_registros FROM dim_entidades e LEFT JOIN dim_municipios m ON e.municipio_id = m.municipio_id WHERE e.tipo {VIEWS[name]} ({kinds})"


def database(replace: bool = False) -> list[str]:
    """Statements that create tables, indexes and views, after dropping those that are there if `replace`."""
    dropped = [f"DROP VIEW {v}" for v in VIEWS] + [f"DROP TABLE {t}" for t in reversed(TABLES)] if replace else []
    return dropped + [create_table(t) for t in TABLES] + [f"CREATE INDEX {i} ON {t} ({c})" for i, (t, c) in INDEXES.items()] + [f"CREATE VIEW {v} AS {view(v)}" for v in VIEWS]


def spark_type(kind: str) -> str:
    """The type in which Spark holds a column of the database."""
    return {"INTEGER": "int", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}.get(kind, "string" if kind.startswith("VARCHAR") else kind.lower())


def fitted(rows: DataFrame, table: str) -> DataFrame:
    """All-text or typed rows with the columns and types of a table; blanks and what cannot be read become null, except
    where a table has no null text; longer texts are cut as the column is."""
    out = []
    for column, kind, more in TABLES[table]:
        value = f"nullif(trim(CAST(`{column}` AS STRING)), '')" if column in rows.columns else "CAST(NULL AS STRING)"
        if width := re.fullmatch(r"VARCHAR\((\d+)\)", kind):
            value = f"left({value}, {width[1]})"
            value = f"coalesce({value}, '')" if "NOT NULL" in more else value
        else:
            value = f"try_cast({value} AS {spark_type(kind)})"
            value = f"coalesce({value}, 0)" if "DEFAULT 0" in more else value
        out.append(f"{value} AS {column}")
    return rows.selectExpr(*out)


def create_views(tables: dict[str, DataFrame]) -> None:
    """The views of the model, for spark.sql, over loaded tables, which get views of their own names."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)
    spark = tables["dim_entidades"].sparkSession
    for name in VIEWS:
        spark.sql(view(name)).createOrReplaceTempView(name)
