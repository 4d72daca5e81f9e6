"""Data-quality audits: orphans, reconciliation, agreement, coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def orphans(relations: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(relacion, huerfanos) of (name, child, foreign key, parent, key); null keys refer to nothing.

    A child is read once for all its relations, and its keys are counted before they are dealt out. Keys are compared as
    whole numbers if all are, else as text.
    """
    spark = relations[0][1].sparkSession
    kinds = {df.schema[c].dataType for _, child, fk, parent, key in relations for df, c in ((child, fk), (parent, key))}
    kind = "bigint" if all(isinstance(k, T.IntegralType) for k in kinds) else "string"
    children: dict[int, tuple[DataFrame, list]] = {}
    for name, child, fk, _, _ in relations:
        children.setdefault(id(child), (child, []))[1].append(F.struct(F.lit(name).alias("relacion"), F.col(fk).cast(kind).alias("k")))
    referred = reduce(DataFrame.unionByName, [child.select(F.explode(F.array(*keys)).alias("x")).select("x.*") for child, keys in children.values()])
    counted = referred.filter("k IS NOT NULL").groupBy("relacion", "k").agg(F.count("*").alias("n"))
    there = reduce(DataFrame.unionByName, [parent.select(F.lit(name).alias("relacion"), F.col(key).cast(kind).alias("k")) for name, _, _, parent, key in relations])
    missing = counted.join(there, ["relacion", "k"], "left_anti").groupBy("relacion").agg(F.sum("n").alias("huerfanos"))
    names = spark.createDataFrame([(r[0],) for r in relations], "relacion string")
    return names.join(F.broadcast(missing), "relacion", "left").select("relacion", F.coalesce("huerfanos", F.lit(0).cast("bigint")).alias("huerfanos"))


def reconcile(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """How many keys only a, only b and both have, in one pass over either."""
    both = a.select(key).distinct().withColumn("x", F.lit(1)).join(b.select(key).distinct().withColumn("y", F.lit(1)), key, "full_outer")
    return both.agg(F.count_if(F.col("y").isNull()).alias("solo_a"), F.count_if(F.col("x").isNull()).alias("solo_b"), F.count_if(F.col("x").isNotNull() & F.col("y").isNotNull()).alias("ambos"))


def compare_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Counts of a key in two tables side by side, missing ones as 0."""
    x, y = a.groupBy(key).agg(F.count("*").alias("a")), b.groupBy(key).agg(F.count("*").alias("b"))
    zero = F.lit(0).cast("bigint")
    return x.join(y, key, "full_outer").select(key, F.coalesce("a", zero).alias("a"), F.coalesce("b", zero).alias("b"), (F.coalesce("a", zero) - F.coalesce("b", zero)).alias("diferencia"))


def verdict(share: Column, ok: float, warn: float) -> Column:
    """ok, warn or fail of a share in percent."""
    return F.when(share >= ok, "ok").when(share >= warn, "warn").otherwise("fail")


def agreement(rows: DataFrame, checks: dict[str, Column], ok: float = 99, warn: float = 95) -> DataFrame:
    """(campo, aciertos, errores, veredicto) of boolean checks, in one pass."""
    one = rows.agg(*[F.count_if(c).alias(n) for n, c in checks.items()], *[F.count_if(~c).alias(f"no_{n}") for n, c in checks.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("campo"), F.col(n).alias("aciertos"), F.col(f"no_{n}").alias("errores")) for n in checks]))
    out = one.select(pairs.alias("x")).select("x.*")
    return out.withColumn("veredicto", verdict(F.col("aciertos") * 100 / F.greatest(F.col("aciertos") + F.col("errores"), F.lit(1)), ok, warn))


def coverage(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(campo, con_valor, porcentaje) of non-blank values, in one pass."""
    one = rows.agg(F.count("*").alias("n"), *[F.count_if(c).alias(name) for name, c in columns.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("campo"), F.col(name).alias("con_valor")) for name in columns]))
    return one.select("n", pairs.alias("x")).select("x.campo", "x.con_valor", F.round(F.col("x.con_valor") * 100 / F.col("n"), 2).alias("porcentaje"))


def sample(rows: DataFrame, key: str, share: int) -> DataFrame:
    """About one row in `share`, the same ones each time, chosen by key."""
    return rows.filter(F.col(key) % share == 0)


def sample_of(rows: DataFrame, key: str, n: int, seed: int = 42, heap: int = 10_000) -> DataFrame:
    """Exactly n rows, or all if there are fewer: those of the least seeded hashes of their key.

    The same rows for any partitioning; rows of one key compete by their other columns. Up to `heap` rows come from a heap a
    partition and one merge; of more, those below the hash range in which the last of them lies are kept where they are, and
    only the rest of that range is merged.
    """
    told = rows.withColumn("_draw", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))), 256))
    order = ["_draw", *[f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]]
    if n <= heap:
        return told.orderBy(*order).limit(n).drop("_draw")
    begin = F.substring("_draw", 1, 4)
    below, last = 0, None
    for r in told.groupBy(begin.alias("begin")).count().orderBy("begin").collect():  # 65536 rows at most
        if below + r["count"] > n:
            last = r["begin"]
            break
        below += r["count"]
    if last is None:
        return rows
    return told.filter(begin < last).unionByName(told.filter(begin == last).orderBy(*order).limit(n - below)).drop("_draw")


def labelled(col: Column, label: str) -> Column:
    """The stripped text, or the label for null and blank."""
    return F.coalesce(F.nullif(F.trim(col), F.lit("")), F.lit(label))


def confidence(score: Column) -> Column:
    """The band of a similarity."""
    return F.when(score >= 0.92, "alta").when(score >= 0.85, "media").otherwise("baja")


def row_drift(tables: list[tuple[str, DataFrame, DataFrame]], most: float = 1.0) -> DataFrame:
    """(tabla, origen, destino, diferencia, porcentaje, veredicto) of (name, source, loaded): ok below `most` percent, an empty source only if nothing was loaded."""
    counts = [a.agg(F.lit(name).alias("tabla"), F.count("*").alias("origen")).join(b.agg(F.lit(name).alias("tabla"), F.count("*").alias("destino")), "tabla") for name, a, b in tables]
    both = reduce(DataFrame.unionByName, counts).withColumn("diferencia", F.col("destino") - F.col("origen"))
    share = F.when(F.col("origen") > 0, F.col("diferencia") * F.lit(100.0) / F.col("origen")).when(F.col("destino") == 0, 0.0)
    return both.withColumns({"porcentaje": F.round(share, 4), "veredicto": F.when(F.abs(share) < most, "ok").otherwise("fail")})


def report(title: str, figures: DataFrame) -> DataFrame:
    """A text report of a small table of figures: (n, linea), the title, a rule, and a line for each row in order of its columns."""
    line = F.concat_ws("  ", *[F.rpad(F.coalesce(F.col(c).cast("string"), F.lit("-")), 24, " ") for c in figures.columns])
    head = F.array(F.lit(title), F.lit("=" * len(title)), F.lit("  ".join(c.ljust(24) for c in figures.columns)))
    lines = figures.select(F.struct(*figures.columns).alias("k"), line.alias("linea")).agg(F.array_sort(F.collect_list(F.struct("k", "linea"))).alias("x"))
    return lines.select(F.posexplode(F.concat(head, F.transform("x", lambda e: e["linea"]))).alias("n", "linea")).select("n", F.rtrim("linea").alias("linea"))
