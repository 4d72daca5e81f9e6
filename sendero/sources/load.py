"""Loads of several tables that take effect together or not at all.

Into a folder: each table is written aside under a name that no reader knows, checked there (keys, references), and listed in
a manifest with all others; one rename puts the manifest in place, and readers follow the newest one. Whatever fails before
leaves the last load as it was. Two loads that start from the same manifest cannot both take effect: the second finds its
number taken. The folder's file system must rename a file in one step, as HDFS and local disks do.

Into a database: tables are written in batches to new tables beside the old ones, many tasks at a time; then one
transaction empties the old ones, those that refer to others first, and fills them from the new. A failure rolls it back.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAME = re.compile(r"manifest-(\d{10})\.json")


@dataclass(frozen=True)
class Rules:
    """What must hold in a table: the columns that tell its rows apart, and (column, table, column there) it refers to."""

    key: tuple[str, ...] = ()
    refers: tuple[tuple[str, str, str], ...] = ()


@dataclass(frozen=True)
class Manifest:
    """A load that took effect: its number, and path, rows and schema of each table."""

    version: int = 0
    tables: dict[str, dict] = field(default_factory=dict)


class LoadError(ValueError):
    """A load that did not take effect."""


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, folder: str) -> list[str]:
    store, at = _path(spark, folder)
    return [s.getPath().getName() for s in store.listStatus(at)] if store.exists(at) else []


def manifest(spark: SparkSession, folder: str, version: int | None = None) -> Manifest:
    """The newest manifest of a folder, or that of a version; an empty one where nothing was loaded yet."""
    known = sorted(int(m[1]) for n in _names(spark, folder) if (m := NAME.fullmatch(n)))
    if version is None and not known:
        return Manifest()
    if version is not None and version not in known:
        raise LoadError(f"no version {version}")
    number = known[-1] if version is None else version
    told = spark.read.text(f"{folder}/manifest-{number:010d}.json", wholetext=True).first()[0]
    return Manifest(number, json.loads(told)["tables"])


def tables(spark: SparkSession, folder: str, version: int | None = None) -> dict[str, DataFrame]:
    """All tables as the newest load, or a version of it, left them."""
    return {name: spark.read.schema(t["schema"]).parquet(f"{folder}/{t['path']}") for name, t in manifest(spark, folder, version).tables.items()}


def broken_rules(loaded: dict[str, DataFrame], name: str, rules: Rules) -> Iterator[str]:
    """What in a table breaks its rules; null references refer to nothing."""
    rows = loaded[name]
    if rules.key:
        null = F.lit(False)
        for c in rules.key:
            null = null | F.col(c).isNull()
        if not rows.filter(null).isEmpty():
            yield f"{name}: null in {', '.join(rules.key)}"
        if not rows.groupBy(*rules.key).count().filter("count > 1").isEmpty():
            yield f"{name}: {', '.join(rules.key)} repeats"
    for column, to, key in rules.refers:
        if to not in loaded:
            yield f"{name}: {column} refers to {to}, which is not there"
        elif not rows.filter(F.col(column).isNotNull()).join(loaded[to].select(F.col(key).alias(column)), column, "left_anti").isEmpty():
            yield f"{name}: {column} has no row in {to}"


@contextmanager
def _aside(spark: SparkSession, folder: str) -> Iterator[str]:
    """A new folder name, deleted if what happens inside fails."""
    name = f"load-{uuid.uuid4().hex}"
    try:
        yield name
    except BaseException:
        store, at = _path(spark, f"{folder}/{name}")
        store.delete(at, True)
        raise


def load(spark: SparkSession, folder: str, given: dict[str, DataFrame], rules: dict[str, Rules] | None = None) -> Manifest:
    """Write all given tables, check them, and let them take effect together; tables that are not given stay.

    Raises LoadError, with the folder as it was, where a rule is broken or another load took effect meanwhile. A load that
    broke off may be run again as it was: nothing of it is seen or used. `vacuum` deletes what such loads left.
    """
    old = manifest(spark, folder)
    with _aside(spark, folder) as aside:
        made = {}
        for name, rows in given.items():
            rows.write.parquet(f"{folder}/{aside}/{name}")
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
            back = spark.read.schema(schema).parquet(f"{folder}/{aside}/{name}")
            made[name] = {"path": f"{aside}/{name}", "rows": back.count(), "schema": schema}
        whole = {**old.tables, **made}
        seen = {name: spark.read.schema(t["schema"]).parquet(f"{folder}/{t['path']}") for name, t in whole.items()}
        broken = [x for name in whole for x in broken_rules(seen, name, (rules or {}).get(name, Rules()))]
        if broken:
            raise LoadError("; ".join(broken))
        new = Manifest(old.version + 1, whole)
        _put(spark, folder, new)
    return new


def _put(spark: SparkSession, folder: str, new: Manifest) -> None:
    """Write a manifest under another name and rename it; its own name must be free."""
    store, draft = _path(spark, f"{folder}/.draft-{uuid.uuid4().hex}")
    out = store.create(draft, False)
    try:
        out.write(bytearray(json.dumps({"tables": new.tables}, sort_keys=True).encode()))
    finally:
        out.close()
    options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if draft.isAbsolute() and draft.toUri().getScheme() else store.getUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(draft, _path(spark, f"{folder}/manifest-{new.version:010d}.json")[1], options)
    except Exception as e:
        store.delete(draft, False)
        raise LoadError(f"version {new.version} is there already") from e


def vacuum(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Delete all but the last `keep` manifests and every file that none of these needs; returns what was deleted.

    No load may run meanwhile: its tables are not in any manifest yet.
    """
    names = _names(spark, folder)
    known = sorted(int(m[1]) for n in names if (m := NAME.fullmatch(n)))
    held = {f"manifest-{v:010d}.json" for v in known[-keep:]}
    used = {t["path"] for v in known[-keep:] for t in manifest(spark, folder, v).tables.values()}
    gone = [n for n in names if n not in held and (NAME.fullmatch(n) or n.startswith(".draft-"))]
    for name in names:
        if name.startswith("load-"):
            parts = [f"{name}/{x}" for x in _names(spark, f"{folder}/{name}")]
            gone += [name] if not used.intersection(parts) else [x for x in parts if x not in used]
    for name in gone:
        store, at = _path(spark, f"{folder}/{name}")
        store.delete(at, True)
    return sorted(gone)


def _connection(spark: SparkSession, url: str, properties: dict[str, str]):
    told = spark._jvm.java.util.Properties()
    for k, v in properties.items():
        told.setProperty(k, v)
    return spark._jvm.java.sql.DriverManager.getConnection(url, told)


def load_jdbc(spark: SparkSession, url: str, given: dict[str, DataFrame], together: bool = True, batch: int = 10_000, **properties: str) -> dict[str, int]:
    """Replace the rows of database tables, in the given order, in which none refers to a later one; returns their counts.

    together: one transaction over all tables, else one a table, where those before a failure stay replaced. A table that is
    not there is created, empty, in the types that Spark picks. Names are plain identifiers.
    """
    for name in given:
        if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_]*", name):
            raise LoadError(f"{name} is no plain name")
    fresh = {name: f"{name}_new_{uuid.uuid4().hex[:8]}" for name in given}
    counts = {}
    db = _connection(spark, url, properties)
    try:
        for name, rows in given.items():
            rows.limit(0).write.mode("ignore").jdbc(url, name, properties=properties)
            rows.write.mode("error").option("batchsize", batch).jdbc(url, fresh[name], properties=properties)
        db.setAutoCommit(False)
        run = db.createStatement()
        for group in [list(given)] if together else [[name] for name in given]:
            for name in reversed(group):
                run.executeUpdate(f"DELETE FROM {name}")
            for name in group:
                columns = ", ".join(f'"{c}"' if url.startswith("jdbc:derby") else c for c in given[name].columns)
                counts[name] = run.executeUpdate(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {fresh[name]}")
            db.commit()
    except Exception as e:
        if not db.getAutoCommit():
            db.rollback()
        raise LoadError(f"rolled back: {str(e)[:500]}") from e
    finally:
        if not db.getAutoCommit():
            db.rollback()
        db.setAutoCommit(True)
        for name in fresh.values():
            if db.getMetaData().getTables(None, None, name, None).next() or db.getMetaData().getTables(None, None, name.upper(), None).next():
                db.createStatement().executeUpdate(f"DROP TABLE {name}")
        db.close()
    return counts
