"""Entity resolution of distinct names: blocking, anchor clusters, fuzzy recovery, canonical names, ids.

All of it runs on one row a spelling; facts are touched once, by a join on the spelling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sendero.functions.text import clean_text, levenshtein_ratio, mixed_case, remove_accents, replace_ordinals
from sendero.operators.model import numbered
from sendero.sources.stage import staged

#: Least similarity to an anchor, by type.
THRESHOLDS = {"JUZGADO": 0.85, "GOBERNACION": 0.90, "ALCALDIA": 0.85, "OTRO": 0.88, "CAR": 0.80, "RAMA_JUDICIAL": 0.80}
DEFAULT_THRESHOLD = 0.85
#: Words that carry no meaning in a name's core (personal names are left to the caller's `extra`).
NOISE = [r"\bDE\b", r"\bDEL\b", r"\bLA\b", r"\bLAS\b", r"\bLOS\b", r"\bEL\b", r"\bEN\b", r"\bY\b", r"\bPARA\b", r"\bPOR\b", r"\bCON\b", r"\bA\b", r"\bAL\b", r"\bD\.?\s*C\.?\b", r"\bDISTRITO\b", r"\bJUDICIAL\b", r"\bORALIDAD\b", r"\bSENTENCIAS?\b", r"\bCIRCUITO\b", r"\bORAL\b", r"\bSECCIONAL\b", r"\bDISTRITAL\b", r"\bMUNICIPAL\b", r"\bTURISTICO\b", r"\bCULTURAL\b", r"\bMAYOR\b", r"\bINDIAS\b", r"\bPAGINAS?\b", r"\b\d+\s+DE\s+\d+\b", r"\bOFICIO\b", r"\bNO\.\b", r"\bNIT\b", r"\bREPUBLICA\b", r"\bCOLOMBIA\b", r"\bPODER\b", r"\bPUBLICO\b", r"\bNO\s+ENCONTRADA\b", r"\bLEVANTAMIENTO\b", r"\bMEDIDA\b", r"\bCAUTELAR\b", r"\bREMITENTE\b", r"\bCERTIFIED\b", r"\bBANK\b", r"\bFUNCIONES\b", r"\bCONTROL\b", r"\bGARANTIAS\b", r"\bCONOCIMIENTO\b", r"\bUNICO\b", r"\bUNICA\b"]
#: Prefixes before the city by type, what ends it, and what is no city.
CITY_PREFIX = {
    "ALCALDIA": [r"^ALCALDI?A\s*(DISTRITAL|MUNICIPAL|MAYOR)?\s*(DE\s+LA|DEL|DE)?\s*"],
    "GOBERNACION": [r"^GOBERNACI[OÒ]N\s*(DEL?\s+DEPARTAMENTO)?\s*(DEL|DE\s+LA|DE)?\s*", r"^GBERANCION\s*(DEL|DE)?\s*", r"^OBERNACION\s*(DEL|DE)?\s*"],
    "MUNICIPIO": [r"^MUNICIPIO\s*(DE|DEL)?\s*"],
}
CITY_TAIL = [r"\s+(SECRETARI|DIRECCION|DESPACHO|HACIENDA|PROCESO|RESOLUCION|NIT|OFICIO|GESTION|FECHA).*", r"\s*\d+.*$", r"[^A-Z0-9Ñ\s]"]
#: Types whose place is guessed from the name.
RECOVERABLE = ["GOBERNACION", "ALCALDIA", "MUNICIPIO", "SECRETARIA", "CONTRALORIA", "PERSONERIA", "TRANSITO", "ESP", "TRIBUNAL"]
#: City portions that are no place; personal names are left to the caller's `extra`.
GARBAGE = [
    "CERTIFIED", "SOCIAL", "GFIC", "PROCESO", "TESORERIA", "PUERTO", "DEPARTAMENTO", "GEST", "TRANSITO", "MOVILIDAD", "CONSTRUYENDO", "CIUDAD", "ERTIFIE", "CER",
    "SECRETARIA", "HACIENDA", "VERDE", "CAKE", "ERINTED", "TRD", "RADICADO", "VERSION", "NEGRO", "ALCALDE", "ALCALDIAS", "GRON", "ST", "ES", "RE", "MP", "VI", "IBA",
    "BARRA", "BLOS", "MON", "SAN", "VILLA", "MUNICIPIO", "RETEN", "GESTION", "VENTANILLA", "ZONA", "DIGDDD", "ATTO", "ESPINBAL", "EDUMAS", "PRESIDENCIA", "PAZ", "ESTOS",
    "GENTE", "NIT", "MIT", "DIRECCIONAMIENTO", "CALL", "SU", "O 6", "POSTAL MUNICIPIO",
]
FUZZY = 0.70


def block_place(kind: Column, city: Column, dept: Column) -> Column:
    """The place part of a blocking key."""
    office = F.coalesce(dept, F.lit("__NO_DEPT__"))
    other = F.coalesce(city, F.concat(F.lit("__DEPT_"), dept, F.lit("__")), F.lit("__NO_LOC__"))
    return F.when(kind == "GOBERNACION", office).otherwise(other)


def blocks(named: DataFrame) -> DataFrame:
    """named(raw, n, tipo, subtipo, numero, municipio, departamento) with the column `lugar`."""
    return named.withColumn("lugar", block_place(F.col("tipo"), F.col("municipio"), F.col("departamento")))


def core_text(names: DataFrame, places: list[str], extra: list[str] | None = None, raw: str = "raw") -> DataFrame:
    """names with `core`: without places (longest first, in one pass) and noise, letters and digits only."""
    listed = "|".join(p.replace(".", r"\.") for p in sorted(places, key=lambda p: (-len(p), p)))
    t = F.regexp_replace(replace_ordinals(clean_text(F.col(raw))), rf"\b(?:{listed})\b", "")
    for pattern in [*NOISE, *(extra or [])]:
        t = F.regexp_replace(t, pattern, "")
    return names.withColumn("core", F.trim(F.regexp_replace(F.regexp_replace(t, "[^A-Z0-9Ñ]", " "), r"\s+", " ")))


def threshold(kind: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in THRESHOLDS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, kind), F.lit(DEFAULT_THRESHOLD))


def grams(text: Column, q: int) -> Column:
    """The runs of q characters of a text with q - 1 marks before and after it, each with the number of equal ones before."""
    edge = F.lit("\x01" * (q - 1))
    runs = F.transform(F.sequence(F.lit(1), F.length(text) + q - 1), lambda i: F.substring(F.concat(edge, text, edge), i, F.lit(q)))
    told = lambda held: F.transform(held, lambda g, i: F.struct(g.alias("g"), F.size(F.filter(F.slice(held, 1, i), lambda h: h == g)).alias("k")))
    return F.element_at(F.transform(F.array(runs), told), 1)  # the runs are made once, not once for each of them


def rare_grams(rows: DataFrame, keep: list[str], text: str, counted: DataFrame, q: int, most: float) -> DataFrame:
    """rows(keep...) once for each of the text's rarest grams, as many as two texts within `most` edits per character
    of the longer one cannot both be without.

    An edit touches at most q grams, so that such texts of lengths a <= L share L + q - 1 - q * most * L of them or more;
    of any order of all grams, each text's first 1 + q * most * a then hold one in common.
    """
    each = rows.select(*keep, F.length(text).alias("_l"), F.explode(grams(F.col(text), q)).alias("gram"))
    ranked = each.join(counted, "gram", "left").groupBy(*keep, "_l").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "gram"))).alias("all"))
    first = F.slice("all", 1, F.floor(1 + q * most * F.col("_l") + 1e-6).cast("int"))
    return ranked.select(*keep, F.explode(first).alias("x")).select(*keep, "x.gram")


def gram_counts(rows: DataFrame, text: str, q: int) -> DataFrame:
    return rows.select(F.explode(grams(F.col(text), q)).alias("gram")).groupBy("gram").agg(F.count("*").alias("times"))


def alike(pairs: DataFrame, told: DataFrame) -> DataFrame:
    """(ai, i) of pairs(ai, i) whose cores, or cleaned texts where a core is empty, are similar enough for the type of i."""
    a = told.select(F.col("i").alias("ai"), F.col("core").alias("ac"), F.col("clean").alias("at"))
    return _similar(pairs.join(a, "ai").join(told.select("i", "core", "clean", "tipo"), "i"))


def _similar(pairs: DataFrame) -> DataFrame:
    """pairs(ai, ac, at, i, core, clean, tipo) that are similar enough; lengths are compared first."""
    blank = (F.col("core") == "") | (F.col("ac") == "")
    x, y = F.when(blank, F.col("at")).otherwise(F.col("ac")), F.when(blank, F.col("clean")).otherwise(F.col("core"))
    need = threshold(F.col("tipo"))
    fits = F.least(F.length(x), F.length(y)) >= need * F.greatest(F.length(x), F.length(y)) - 1e-9
    return pairs.filter(fits).filter(F.when(fits, levenshtein_ratio(x, y)) >= need).select("ai", "i")


def all_pairs(batch: DataFrame, block: list[str]) -> DataFrame:
    """The similar pairs of small batches of a block."""
    a = batch.select(*block, F.col("i").alias("ai"), F.col("core").alias("ac"), F.col("clean").alias("at"))
    return _similar(batch.join(a, block).filter(F.col("ai") < F.col("i")))


Q, MOST = 3, 1 - min(*THRESHOLDS.values(), DEFAULT_THRESHOLD)


def gram_lists(told: DataFrame, block: list[str]) -> DataFrame:
    """(block..., i, blank, of, size, gram): the rare grams of each name's core, and of its cleaned text."""
    keep, lists = [*block, "i", "blank"], []
    for of, rows in (("core", told.filter(~F.col("blank"))), ("clean", told)):
        made = rare_grams(rows.withColumn("size", F.length(of)), [*keep, "size"], of, gram_counts(rows, of, Q), Q, MOST)
        lists.append(made.select(*keep, F.lit(of).alias("of"), "size", "gram"))
    return lists[0].unionByName(lists[1])


def listed_pairs(first: DataFrame, then: DataFrame, block: list[str]) -> DataFrame:
    """(ai, i), ai < i, of names in the lists `first` and `then` that share a rare gram of their cores, or, where one has
    none, of their cleaned texts, and whose lengths fit. No pair that is similar enough is left out."""
    a = first.select(*block, "of", "gram", F.col("i").alias("ai"), F.col("blank").alias("ab"), F.col("size").alias("as"))
    fits = F.least("size", "as") >= (1 - MOST) * F.greatest("size", "as") - 1e-9
    key, sides = [*block, "of", "gram"], []
    for x, y in (
        (then.filter("of = 'core'"), a.filter("of = 'core'")),
        (then.filter("of = 'clean' AND blank"), a.filter("of = 'clean'")),
        (then.filter("of = 'clean' AND NOT blank"), a.filter("of = 'clean' AND ab")),
    ):
        sides.append(x.join(y, key).filter((F.col("ai") < F.col("i")) & fits).select("ai", "i"))
    return sides[0].unionByName(sides[1]).unionByName(sides[2]).distinct()


def joined_by(edges: DataFrame) -> DataFrame:
    """The i of edges(ai, i), ai < i, that some ai opens no cluster before: all that are no anchors.

    Whatever has no earlier neighbour left is an anchor, and what is next to an anchor is none; each round decides those
    and leaves their edges out. The first undecided name is always decided, so the rounds end.
    """
    out, spark = [], edges.sparkSession
    while not edges.isEmpty():
        anchors = edges.select(F.col("ai").alias("a")).join(edges.select(F.col("i").alias("a")), "a", "left_anti").distinct()
        gone = staged(edges.join(anchors, F.col("ai") == F.col("a"), "left_semi").select("i").distinct(), "joined")
        out.append(gone)
        edges = staged(edges.join(gone, "i", "left_anti").join(gone.select(F.col("i").alias("ai")), "ai", "left_anti").select("ai", "i"), "edges")
    joined = spark.createDataFrame([], "i bigint")
    for gone in out:
        joined = joined.unionByName(gone)
    return joined


WIDTH = 200  # names of a block that are compared with each other at first
CROWD = 100  # pairs a name, on average, beyond which a later batch is cut down


def _batch(todo: DataFrame, block: list[str], width: int) -> DataFrame:
    """The first of the undecided names of each block."""
    starts = todo.groupBy(*block).agg(F.min("i").alias("start"))
    return staged(todo.join(starts, block).filter(F.col("i") < F.col("start") + width).drop("start"), "batch")


def _next_batch(todo: DataFrame, lists: DataFrame, block: list[str], width: int) -> tuple[DataFrame, DataFrame, int]:
    """A batch, its lists and its width, which shrinks while its lists, by their lengths, give too many pairs."""
    while True:
        batch = _batch(todo, block, width)
        own = lists.join(batch.select("i"), "i", "left_semi")
        by_gram = own.groupBy(*block, "of", "gram").agg(F.count("*").alias("_n"), F.count_if("blank").alias("_blank"))
        met = F.when(F.col("of") == "core", F.col("_n") * F.col("_n")).otherwise(F.col("_n") * F.col("_blank"))
        if width <= WIDTH or (by_gram.agg(F.sum(met)).first()[0] or 0) <= CROWD * batch.count():
            return batch, own, width
        width //= 4


def anchors_of(told: DataFrame, block: list[str]) -> DataFrame:
    """(i, anchor) of told(i, block..., core, clean, tipo, blank): each name's anchor, which may be itself.

    In batches: the first undecided names of each block are settled among themselves, then all later names are compared
    with the anchors this gave, and only those that no anchor takes wait for the next batch. A crowd of alike names is so
    taken by its first anchors and never compared with itself. Batches widen fourfold; those after the first, and the
    comparisons with anchors, go by rare grams.
    """
    todo, width, lists, done = told, WIDTH, None, []
    while True:
        if lists is None:
            batch = _batch(todo, block, width)
            edges = staged(all_pairs(batch, block), "edges")
        else:
            batch, own, width = _next_batch(todo, lists, block, width)
            edges = staged(alike(listed_pairs(own, own, block), batch), "edges")
        joined = staged(joined_by(edges), "joined")
        first = edges.join(joined.select(F.col("i").alias("ai")), "ai", "left_anti").join(joined, "i", "left_semi").groupBy("i").agg(F.min("ai").alias("anchor"))
        done.append(batch.select("i").join(first, "i", "left").select("i", F.coalesce("anchor", "i").alias("anchor")))
        rest = todo.join(batch.select("i"), "i", "left_anti")
        if rest.isEmpty():
            break
        if lists is None:
            lists = staged(gram_lists(told, block), "lists")
        anchors = lists.join(batch.select("i").join(joined, "i", "left_anti"), "i", "left_semi")
        pairs = listed_pairs(anchors, lists.join(rest.select("i"), "i", "left_semi"), block)
        taken = staged(alike(pairs, told).groupBy("i").agg(F.min("ai").alias("anchor")), "taken")
        done.append(taken)
        todo = staged(rest.join(taken, "i", "left_anti"), "todo")
        if todo.isEmpty():
            break
        width *= 4
    return reduce(DataFrame.unionByName, done)


def anchor_clusters(named: DataFrame, block: list[str], order: list[Column]) -> DataFrame:
    """named(raw, core, clean, tipo, block...) with `cluster`, the 0-based number of its cluster in its block.

    In order, a name joins the first cluster whose anchor (first member) is similar enough, or opens one. Nulls in core or
    clean count as empty. An empty table gives an empty one.
    """
    filled = named.withColumns({c: F.coalesce(c, F.lit("")) for c in ("core", "clean")})
    ranked = numbered(filled, [*block, *order], "i")
    told = ranked.select(*dict.fromkeys(["i", *block, "core", "clean", "tipo"]), (F.col("core") == "").alias("blank"))
    found = staged(anchors_of(told, block), "anchors")
    own = numbered(ranked.select(*block, F.col("i").alias("anchor")).join(found.filter("i = anchor").select("anchor"), "anchor"), ["anchor"], "at")
    opened = own.join(own.groupBy(*block).agg(F.min("at").alias("least")), block).select("anchor", (F.col("at") - F.col("least")).cast("int").alias("cluster"))
    return ranked.join(found, "i").join(opened, "anchor").select(*named.columns, "cluster")


def city_portion(kind: Column, clean: Column) -> Column:
    """What a cleaned name says after the prefix of its type, up to numbers and office words."""
    t = remove_accents(clean)
    cuts = {}
    for of, patterns in CITY_PREFIX.items():
        cuts[of] = t
        for p in patterns:
            cuts[of] = F.regexp_replace(cuts[of], p, "")
    t = F.when(kind == "GOBERNACION", cuts["GOBERNACION"]).when(kind == "MUNICIPIO", cuts["MUNICIPIO"]).otherwise(cuts["ALCALDIA"])
    for p in CITY_TAIL:
        t = F.regexp_replace(t, p, "")
    return F.trim(t)


def nearest(fragments: DataFrame, names: DataFrame, least: float = FUZZY) -> DataFrame:
    """fragments(part) with the columns of the most similar of names(norm, ord, ...), if similar enough.

    Candidates share a rare pair of characters, which all that are similar enough (`least` of 0.5 or more) do.
    """
    q, most = 2, 1 - least
    counted = gram_counts(names, "norm", q)
    parts = rare_grams(fragments.select("part").distinct().filter(F.length("part") >= 3), ["part"], "part", counted, q, most)
    listed = rare_grams(names.select("norm").distinct(), ["norm"], "norm", counted, q, most)
    pairs = parts.join(listed, "gram").select("part", "norm").distinct().withColumn("ratio", levenshtein_ratio(F.col("part"), F.col("norm"))).filter(F.col("ratio") >= least).join(names, "norm")
    return pairs.groupBy("part").agg(F.max_by(F.struct(*names.columns), F.struct("ratio", (-F.col("ord")).alias("o"))).alias("hit"), F.max("ratio").alias("ratio")).select("part", "hit.*", "ratio")


def recover_places(groups: DataFrame, names: DataFrame, departments: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """groups(tipo, lugar, cluster, raw, n, clean) with the place of groups without one, guessed from the most frequent
    name's city portion; `lugar2` is the new place, '' + the old one and its cluster where nothing was found. Portions in GARBAGE or `extra` are no place."""
    without = F.contains("lugar", F.lit("__NO_"))
    key = ["tipo", "subtipo", "numero", "lugar", "cluster"]
    prime = groups.filter(without & F.col("tipo").isin(*RECOVERABLE)).groupBy(*key).agg(F.max_by("clean", F.struct("n", (-F.col("seen")).alias("s"))).alias("prime"))
    prime = prime.withColumn("part", city_portion(F.col("tipo"), F.col("prime")))
    prime = staged(prime, "prime")  # one row a group without a place
    prime = prime.filter(~F.col("part").isin(*GARBAGE, *(extra or [])))
    cities = nearest(prime, names).select("part", F.col("municipio").alias("gm"), F.col("departamento").alias("gd"))
    depts = nearest(prime, departments).select("part", F.col("departamento").alias("od"))
    found = prime.join(cities, "part", "left").join(depts, "part", "left").withColumn("found", F.when(F.col("tipo") == "GOBERNACION", F.coalesce("od", "gd")).otherwise(F.col("gm")))
    out = groups.join(found.select(*key, "found", "gm", "gd"), key, "left")
    fresh = F.col("found").isNotNull()
    return out.withColumns({
        "lugar2": F.when(fresh, F.col("found")).when(without, F.concat("lugar", F.lit("_C"), F.col("cluster").cast("string"))).otherwise(F.col("lugar")),
    })


def entities(grouped: DataFrame, key: list[str]) -> DataFrame:
    """One row for each key: the canonical name, the primary variant's place, totals, and an id by total.

    Canonical: the first by count of the mixed-case variants that reach 20 % of the top count and 2, else the top one.
    """
    top = F.struct("n", (-F.col("seen")).alias("s"))
    sized = grouped.withColumn("most", F.max("n").over(W.partitionBy(*key)))
    fit = mixed_case(F.col("raw")) & (F.col("n") >= F.greatest(F.col("most") * 0.2, F.lit(2.0)))
    made = sized.groupBy(*key).agg(
        F.trim(F.coalesce(F.max_by(F.when(fit, F.col("raw")), F.when(fit, top)), F.max_by("raw", top))).alias("nombre"),
        F.max_by(F.struct("municipio", "departamento"), top).alias("lugar_de"),
        F.sum("n").alias("total_registros"),
        F.count("*").alias("num_variantes"),
        F.min("seen").alias("seen"),
    )
    ordered = numbered(made, [F.desc("total_registros"), F.col("seen")], "entidad_id")
    return ordered.select("entidad_id", *key, "nombre", F.coalesce("lugar_de.municipio", F.lit("")).alias("municipio"), F.coalesce("lugar_de.departamento", F.lit("")).alias("departamento"), "total_registros", "num_variantes")
