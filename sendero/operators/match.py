"""Matching names with registries: token overlap by an inverted index, residual duplicates, name audits."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sendero.functions.text import court_ordinal, court_subtype_key, key_words, norm_suggest, numbers


def tokens(norm: Column) -> Column:
    return F.array_distinct(F.filter(F.split(norm, " "), lambda w: w != ""))


def jaccard(a: Column, b: Column, x: Column, y: Column) -> Column:
    """Common over all tokens a, b of the names x, y; halved if both hold numbers and none in common."""
    score = F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))
    m, n = numbers(x), numbers(y)
    return F.when((F.size(m) > 0) & (F.size(n) > 0) & ~F.arrays_overlap(m, n), score * 0.5).otherwise(score)


def overlap(a: Column, b: Column) -> Column:
    """Common tokens over those of the longer name."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b))


def prefixes(lists: DataFrame, keep: list[str], words: str, counted: DataFrame, least: float) -> DataFrame:
    """lists(keep..., words) once for each of the rarest words (keep..., t, size), as many as a list can lack in common
    with another of which it shares at least `least` of the longer, and one more.

    Lists of sizes a and b that share least * max(a, b) words or more share one of the first a - ceil(least * a) + 1 of the
    one and of the first b - ceil(least * b) + 1 of the other, in any one order of all words. The order is by the number of
    lists that hold a word, so a word that most hold is a key only where a list has nothing else.
    """
    each = lists.select(*keep, F.size(words).alias("size"), F.explode(words).alias("t")).join(counted, "t", "left")
    ranked = each.groupBy(*keep, "size").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "t"))).alias("all"))
    need = F.ceil(F.col("size") * least - 1e-9)
    return ranked.select(*keep, "size", F.explode(F.slice("all", F.lit(1), (F.col("size") - need + 1).cast("int"))).alias("x")).select(*keep, "size", "x.t")


def word_counts(*lists: DataFrame) -> DataFrame:
    """(t, times) of the words of tables of one array column each."""
    each = [rows.select(F.explode(rows.columns[0]).alias("t")) for rows in lists]
    return reduce(DataFrame.unionByName, each).groupBy("t").agg(F.count("*").alias("times"))


def candidates(a: DataFrame, b: DataFrame, least: float, on: list[str] | None = None) -> DataFrame:
    """Pairs (on..., id, rid) of a(on..., id, a) and b(on..., rid, b) that may share `least` of the longer word list.

    No pair that does is left out; lists of unlike sizes do not meet.
    """
    on = on or []
    counted = word_counts(a.select("a"), b.select("b"))
    left = prefixes(a, [*on, "id"], "a", counted, least)
    right = prefixes(b, [*on, "rid"], "b", counted, least).withColumnRenamed("size", "rsize")
    alike = (F.col("size") >= F.col("rsize") * least - 1e-9) & (F.col("rsize") >= F.col("size") * least - 1e-9)
    return left.join(right, [*on, "t"]).filter(alike).select(*on, "id", "rid").distinct()


def best_matches(names: DataFrame, registry: DataFrame, score, least: float, bonus=None) -> DataFrame:
    """names(id, norm, ...) with the best of registry(rid, rnorm, ...): an equal name, else the highest score among
    those that share a token (least rid on ties).

    score(a, b, x, y) of the token lists and names, at most the share of common tokens in the longer list; bonus, if any, is
    added where the score reaches `least`. Pairs that cannot reach `least` are not formed (`candidates`).
    """
    first = registry.groupBy("rnorm").agg(F.min("rid").alias("rid"))
    equal = names.join(first, F.col("norm") == F.col("rnorm")).select("id", "rid", F.lit(1.0).alias("score"))
    rest = names.join(equal.select("id"), "id", "left_anti").withColumn("a", tokens(F.col("norm")))
    index = registry.withColumn("b", tokens(F.col("rnorm")))
    pairs = candidates(rest.select("id", "a"), index.select("rid", "b"), least)
    scored = pairs.join(rest, "id").join(index, "rid").withColumn("score", score(F.col("a"), F.col("b"), F.col("norm"), F.col("rnorm"))).filter(F.col("score") >= least)
    if bonus is not None:
        scored = scored.withColumn("score", F.col("score") + bonus)
    best = scored.withColumn("rn", F.row_number().over(W.partitionBy("id").orderBy(F.desc("score"), "rid"))).filter("rn = 1").select("id", "rid", "score")
    return equal.unionByName(best)


LETTERS = " ABCDEFGHIJKLMNOPQRSTUVWXYZÑ0123456789"


def letter_counts(norm: Column) -> Column:
    """How often each of LETTERS stands in a text, and then how many other characters do."""
    counted = F.transform(F.array(*[F.lit(c) for c in LETTERS]), lambda c: F.length(norm) - F.length(F.replace(norm, c, F.lit(""))))
    return F.concat(counted, F.array(F.length(F.translate(norm, LETTERS, ""))))


def most_ratio(a: Column, b: Column, counts_a: Column, counts_b: Column) -> Column:
    """A bound of sequence_ratio: twice the characters in common, wherever they stand, over those of both."""
    common = F.aggregate(F.zip_with(counts_a, counts_b, lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    both = F.length(a) + F.length(b)
    return F.when(both == 0, 1.0).otherwise(2.0 * common / both)


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity; no built-in expresses it."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])


def residual_candidates(ents: DataFrame) -> DataFrame:
    """Pairs child -> larger parent of one type that pass every guard but the similarity itself; `letters` of both bound it.

    ents(entidad_id, nombre, tipo, subtipo, municipio, departamento, total_registros). The 500 largest of a group
    (a type; for more than 200 courts also the subtype) are parents; pairs share a key word.
    """
    sized = ents.filter("tipo <> 'OTRO'").withColumn("g", F.count("*").over(W.partitionBy("tipo")))
    sized = sized.withColumn("grupo", F.when((F.col("tipo") == "JUZGADO") & (F.col("g") > 200), F.concat_ws("|", "tipo", "subtipo")).otherwise(F.col("tipo")))
    sized = sized.withColumns({"norm": norm_suggest(F.col("nombre")), "words": F.array_distinct(key_words(F.col("nombre"))), "rn": F.row_number().over(W.partitionBy("grupo").orderBy(F.desc("total_registros"), "entidad_id")), "ordinal": court_ordinal(F.col("nombre")), "clave": court_subtype_key(F.col("nombre"))})
    sized = sized.withColumns({"digits": F.array_sort(numbers(F.col("norm"))), "letters": letter_counts(F.col("norm"))})
    columns = ["entidad_id", "nombre", "municipio", "departamento", "total_registros", "norm", "words", "ordinal", "clave", "digits", "letters"]
    child = sized.filter(F.size("words") >= 2).select("grupo", "tipo", *[F.col(c).alias(f"c_{c}") for c in columns])
    parent = sized.filter("rn <= 500").select("grupo", *[F.col(c).alias(f"p_{c}") for c in columns])
    met = candidates(child.select("grupo", F.col("c_entidad_id").alias("id"), F.col("c_words").alias("a")), parent.select("grupo", F.col("p_entidad_id").alias("rid"), F.col("p_words").alias("b")), 0.5, ["grupo"])
    pairs = met.withColumnsRenamed({"id": "c_entidad_id", "rid": "p_entidad_id"}).join(child, ["grupo", "c_entidad_id"]).join(parent, ["grupo", "p_entidad_id"])
    court, office = F.col("tipo") == "JUZGADO", F.col("tipo").isin("ALCALDIA", "MUNICIPIO", "GOBERNACION")
    same = lambda c: (F.col(f"c_{c}") == "") | (F.col(f"p_{c}") == "") | (norm_suggest(F.col(f"c_{c}")) == norm_suggest(F.col(f"p_{c}")))
    digits = (F.size("c_digits") == 0) | (F.size("p_digits") == 0) | (F.col("c_digits") == F.col("p_digits"))
    ordinal = F.coalesce(F.col("c_ordinal") == F.col("p_ordinal"), F.lit(True))
    need = F.when(court, 0.88).when(office, 0.80).otherwise(0.82)
    lengths = F.least(F.length("c_norm"), F.length("p_norm")) / F.greatest(F.length("c_norm"), F.length("p_norm"))
    kept = pairs.filter((F.col("p_total_registros") > F.col("c_total_registros")) & (overlap(F.col("c_words"), F.col("p_words")) >= 0.5) & same("municipio") & same("departamento"))
    return kept.filter(~court | (digits & ordinal)).withColumn("need", need).filter(lengths >= F.col("need") * 0.85)


def within_reach(pairs: DataFrame) -> DataFrame:
    """Residual candidates whose similarity can reach what they need, by the characters in common: only these are given to
    the Python function."""
    bound = most_ratio(F.col("c_norm"), F.col("p_norm"), F.col("c_letters"), F.col("p_letters"))
    return pairs.filter(bound >= F.col("need") - 1e-9)


def residual_duplicates(ents: DataFrame) -> DataFrame:
    """For each entity the larger one of its type that it most likely repeats, with a confidence band."""
    pairs = within_reach(residual_candidates(ents))
    court = (F.col("tipo") == "JUZGADO") & (F.col("c_clave") != "") & (F.col("p_clave") != "")
    pairs = pairs.withColumn("sub", F.when(court, sequence_ratio(F.col("c_clave"), F.col("p_clave")))).filter("sub IS NULL OR sub >= 0.7")
    pairs = pairs.withColumn("similitud", sequence_ratio(F.col("c_norm"), F.col("p_norm"))).filter("similitud >= need")
    best = pairs.withColumn("rn", F.row_number().over(W.partitionBy("c_entidad_id").orderBy(F.desc("similitud"), F.desc("p_total_registros"), "p_entidad_id"))).filter("rn = 1")
    band = F.when(F.col("similitud") >= 0.92, "alta").when(F.col("similitud") >= 0.85, "media").otherwise("baja")
    out = [F.col(f"{side}_{c}").alias(f"{name}_{to}") for side, name in (("c", "child"), ("p", "parent")) for c, to in (("entidad_id", "id"), ("nombre", "nombre"), ("total_registros", "registros"), ("municipio", "municipio"), ("departamento", "departamento"))]
    return best.select(F.round("similitud", 3).alias("similitud"), F.col("tipo").alias("child_tipo"), *out, band.alias("confianza"))


def name_overlap(extracted: Column, loaded: Column) -> Column:
    """Share of the loaded name's words of more than three letters that the extracted name has too; null without any."""
    long = lambda c: F.array_distinct(F.filter(F.split(c, " "), lambda w: F.length(w) > 3))
    return F.when(F.size(long(loaded)) > 0, F.size(F.array_intersect(long(extracted), long(loaded))) / F.size(long(loaded)))
