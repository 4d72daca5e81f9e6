"""Sources: CSV by name, by position and with a byte-order mark, nested JSON, JDBC; rows and files counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All-text columns of a CSV with a header; quoted line ends stay inside a field, a byte-order mark is dropped."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, schema=schema, header=True, quote='"', escape='"', multiLine=True, enforceSchema=True)


def positional_csv(spark: SparkSession, path: str, width: int, wanted: dict[int, str], least: int, seen: Observation | None = None) -> DataFrame:
    """Columns of a headed CSV by position; rows with fewer than `least` fields are left out, wider ones are cut.

    A row that is not `width` fields wide is counted by its text: a comma inside quotes ends no field. seen, if any, gets
    `filas` and `filas_cortas` as the rows are read.
    """
    schema = T.StructType([*[T.StructField(f"_{i}", T.StringType()) for i in range(width)], T.StructField("_corrupt", T.StringType())])
    rows = spark.read.csv(path, schema=schema, header=True, quote='"', escape='"', multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", enforceSchema=True)
    bare = F.regexp_replace("_corrupt", '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    present = F.col("_corrupt").isNull() | (fields >= least)
    if seen is not None:
        rows = rows.observe(seen, F.count("*").alias("filas"), F.count_if(~present).alias("filas_cortas"))
    return rows.filter(present).select(*[F.col(f"_{i}").alias(n) for i, n in wanted.items()])


GEOGRAPHY = "id int, departamento string, ciudades array<string>"


def geography_json(spark: SparkSession, path: str) -> DataFrame:
    """(departamento, municipio, ord) of an array of {id, departamento, ciudades}; a department without cities stays."""
    rows = spark.read.json(path, schema=GEOGRAPHY, multiLine=True)
    return rows.select("id", "departamento", F.posexplode_outer("ciudades").alias("place", "municipio")).select("departamento", "municipio", (F.col("id") * 10_000 + F.coalesce("place", F.lit(0))).alias("ord"))


def jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query's rows from a database."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def jdbc_ranges(spark: SparkSession, url: str, table: str, key: str, rows: int = 1_000_000, ways: int = 64, **options: str) -> DataFrame:
    """A database table, read by one task for each range of an integer key that holds about `rows` rows.

    The database counts the rows of `ways` equal ranges, and again within each that is too full, so that keys which lie close
    together are split as well; a single key is never split. Rows without a key are a range of their own. Each task reads by
    a connection of its own: rows that change meanwhile may be seen or not.
    """
    ask = lambda q: spark.read.format("jdbc").options(url=url, query=q, **options).load().collect()  # noqa: E731  a row for each range
    least, most, keyed, total = (int(x or 0) for x in ask(f"SELECT MIN({key}) AS a, MAX({key}) AS b, COUNT({key}) AS c, COUNT(*) AS d FROM {table}")[0])

    def cuts(lo: int, hi: int, count: int) -> list[int]:
        """Where ranges begin in [lo, hi), lo among them."""
        if count <= rows or hi - lo <= 1:
            return [lo]
        width = max(1, -(-(hi - lo) // ways))
        within = f"SELECT FLOOR(({key} - ({lo})) / {width}) AS a FROM {table} WHERE {key} >= {lo} AND {key} < {hi}"
        counted = ask(f"SELECT q.a, COUNT(*) AS b FROM ({within}) q GROUP BY q.a")
        out, held = [lo], 0
        for bucket, n in sorted((int(r[0]), int(r[1])) for r in counted):
            begin, end = lo + bucket * width, min(hi, lo + (bucket + 1) * width)
            if held and held + n > rows:
                out.append(begin)
                held = 0
            if n > rows and end - begin > 1:
                inner = cuts(begin, end, n)
                out += [c for c in inner if c > out[-1]]
                held = rows  # the next bucket begins a range
            else:
                held += n
        return out

    if not total:
        return spark.read.jdbc(url, table, properties=options)
    starts = cuts(least, most + 1, keyed) if keyed else []
    parts = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(starts, [*starts, most + 1][1:], strict=True)] if starts else []
    if keyed < total:
        parts.append(f"{key} IS NULL")
    return spark.read.jdbc(url, table, predicates=parts, properties=options)


def line_count(spark: SparkSession, path: str) -> int:
    """Physical lines after the header, quoted line ends counted too."""
    return spark.read.text(path).count() - 1


def header_column(columns: list[str], *parts: str) -> str | None:
    """The last of the columns whose upper-case name holds all parts."""
    found = [c for c in columns if all(p in c.upper() for p in parts)]
    return found[-1] if found else None


def optional(rows: DataFrame, name: str, default: str = "") -> Column:
    """A column, or a default where the table has none."""
    return F.col(name) if name in rows.columns else F.lit(default).alias(name)


def csv_with_found_header(spark: SparkSession, path: str, mark: str, within: int = 15) -> DataFrame:
    """All-text columns of one CSV whose header, the first of its first rows with `mark` in the first field, follows a preamble.

    Of columns that share a name the last stays. A file without such a row is an error.
    """
    rows = spark.read.csv(path, header=False, inferSchema=False, quote='"', escape='"', multiLine=True)  # such a file is one partition
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    first = F.upper(F.trim(F.coalesce(F.col(rows.columns[0]), F.lit(""))))
    head = rows.filter((F.col("_at") < within) & first.contains(mark.upper())).orderBy("_at").first()
    if head is None:
        raise ValueError(f"no header with {mark} in the first {within} rows")
    named = {(name or "").strip(): c for c, name in head.asDict().items() if c != "_at"}
    return rows.filter(F.col("_at") > head["_at"]).select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for name, c in named.items() if name])


def last_wins(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """One row a key, the last in the given order."""
    last = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("_row"))
    return last.select("_row.*")
