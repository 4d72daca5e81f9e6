"""Sinks: CSV in a fixed column order, typed tables, JDBC batches, JSON for dashboards."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sendero.operators.model import SCHEMAS, typed


def write_csv(rows: DataFrame, path: str, columns: list[str]) -> None:
    rows.select(*columns).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def write_table(rows: DataFrame, path: str, table: str) -> None:
    """All-text rows in the types of a table of the model, replacing what is there: a repeated load changes nothing."""
    if table not in SCHEMAS:
        raise ValueError(f"no table {table}")
    typed(rows, table).write.mode("overwrite").parquet(path)


def write_jdbc(rows: DataFrame, url: str, table: str, batch: int = 10_000, **properties: str) -> None:
    rows.write.mode("overwrite").option("batchsize", batch).jdbc(url, table, properties=properties)


def dashboard_json(kpis: DataFrame) -> DataFrame:
    """One JSON text of a small table of figures."""
    return kpis.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*kpis.columns)))).alias("json"))


def nested_json(sections: dict[str, DataFrame], order: dict[str, list[str | Column]] | None = None) -> DataFrame:
    """One JSON text of several small tables of figures: an object with a list of objects for each, in the given order of
    its rows, else that of its columns. Nested columns stay nested; an empty table gives an empty list."""
    parts = []
    for name, rows in sections.items():
        keys = [F.expr(c) if isinstance(c, str) else c for c in (order or {}).get(name, [])]
        keyed = rows.select(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"c{i}") for i, c in enumerate(rows.columns)]).alias("k"), F.struct(*rows.columns).alias("v"))
        listed = keyed.agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda x: x.v).alias("rows"))
        parts.append(listed.select(F.lit(name).alias("name"), F.to_json(F.struct("rows"), {"ignoreNullFields": "false"}).alias("json")))
    told = reduce(DataFrame.unionByName, parts).agg(F.map_from_entries(F.collect_list(F.struct("name", "json"))).alias("all"))
    # Each text is {"rows":[...]}: its list stands between the name and the last brace.
    each = [F.concat(F.lit(f"{json.dumps(name, ensure_ascii=False)}:"), F.expr(f"substring(all['{name}'], 9, length(all['{name}']) - 9)")) for name in sections]
    return told.select(F.concat(F.lit("{"), F.concat_ws(",", *each), F.lit("}")).alias("json"))
