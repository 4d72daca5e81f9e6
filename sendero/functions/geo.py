"""Geography of names: department and municipality tables, longest-match location, city cascades.

Tables are DataFrames that a caller may replace; the seeds below hold public place names enough for tests. A name occurs
in a text where its words follow one another between word boundaries. Texts are therefore cut into word n-grams, of the
lengths that the names have, and joined to the names by equality; only what joins is checked with the boundary pattern.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from weakref import WeakKeyDictionary

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sendero.functions.text import norm_fold, remove_accents, strip
from sendero.operators.model import numbered
from sendero.sources.stage import broadcast_if_small, staged

ALIAS_ORD = 1 << 30  # the place of the first alias, after all municipalities
DEPARTMENTS = ["Amazonas", "Antioquia", "Atlántico", "Bolívar", "Boyacá", "Caldas", "Cauca", "Cesar", "Córdoba", "Cundinamarca", "Huila", "Magdalena", "Meta", "Nariño", "Norte de Santander", "Quindío", "Risaralda", "Santander", "Sucre", "Tolima", "Valle del Cauca"]
MUNICIPALITIES = [
    ("Medellín", "Antioquia"), ("Armenia", "Antioquia"), ("Rionegro", "Antioquia"), ("Caldas", "Antioquia"), ("Barranquilla", "Atlántico"), ("Cartagena de Indias", "Bolívar"),
    ("Córdoba", "Bolívar"), ("Tunja", "Boyacá"), ("Manizales", "Caldas"), ("La Dorada", "Caldas"), ("Popayán", "Cauca"), ("Sucre", "Cauca"), ("Valledupar", "Cesar"),
    ("Montería", "Córdoba"), ("Bogotá D.C.", "Cundinamarca"), ("Mosquera", "Cundinamarca"), ("Neiva", "Huila"), ("Santa Marta", "Magdalena"), ("Villavicencio", "Meta"),
    ("Pasto", "Nariño"), ("Mosquera", "Nariño"), ("Cúcuta", "Norte de Santander"), ("Armenia", "Quindío"), ("Pereira", "Risaralda"), ("San Gil", "Santander"), ("Rionegro", "Santander"),
    ("Sincelejo", "Sucre"), ("Ibagué", "Tolima"), ("Cali", "Valle del Cauca"), ("Buga", "Valle del Cauca"),
]
#: Ambiguous names and the department that is meant without context.
PREFERRED = [("ARMENIA", "Quindío"), ("RIONEGRO", "Antioquia"), ("MOSQUERA", "Cundinamarca")]
#: Other spellings, the last of a spelling wins.
CITY_ALIASES = [("BOGOTA", "Bogotá D.C.", "Cundinamarca"), ("BOGOTA DC", "Bogotá D.C.", "Cundinamarca"), ("SANTIAGO DE CALI", "Cali", "Valle del Cauca"), ("CARTAGENA", "Cartagena de Indias", "Bolívar"), ("SAN JOSE DE CUCUTA", "Cúcuta", "Norte de Santander"), ("GUADALAJARA DE BUGA", "Buga", "Valle del Cauca"), ("BOGOTA", "Bogotá", "Bogotá, D.C.")]
#: Other spellings of departments, and a city that stands for its own.
DEPT_ALIASES = [("VALLE DEL CAUCA", "Valle del Cauca"), ("VALLE", "Valle del Cauca"), ("N DE SANTANDER", "Norte de Santander"), ("BOLIBAR", "Bolívar"), ("NORTE", "Norte de Santander"), ("CALI", "Valle del Cauca")]


@dataclass
class Geography:
    """departments(norm, departamento, ord), dept_aliases(norm, departamento, ord), cities(norm, municipio,
    departamento, ord), homonyms(norm, municipio, departamento, ord); rows: of all, sizes: in words, of the names."""

    departments: DataFrame
    dept_aliases: DataFrame
    cities: DataFrame
    homonyms: DataFrame
    rows: int
    sizes: list[int]


def plain(col: Column) -> Column:
    """Upper case without accents, Ñ kept."""
    return remove_accents(F.upper(col))


def geography(spark: SparkSession, departments=DEPARTMENTS, municipalities=MUNICIPALITIES, preferred=PREFERRED, city_aliases=CITY_ALIASES, dept_aliases=DEPT_ALIASES) -> Geography:
    """The name tables. A city name with one meaning stands for it, one of several for the preferred or else the first
    listed; an alias overrides both, and of equal aliases the last counts.

    These tables are lists of the caller's; they are worked out once and held as they are, those of the seeds once a session.
    """
    seeds = (departments, municipalities, preferred, city_aliases, dept_aliases) == (DEPARTMENTS, MUNICIPALITIES, PREFERRED, CITY_ALIASES, DEPT_ALIASES)
    if seeds and spark in _SEEDS:
        return _SEEDS[spark]
    depts = _listed(spark, [(d, i) for i, d in enumerate(departments)], departamento=pa.string(), ord=pa.int32())
    cities = _listed(spark, [(m, d, i) for i, (m, d) in enumerate(municipalities)], municipio=pa.string(), departamento=pa.string(), ord=pa.int32())
    made = _geography(depts, cities, preferred, city_aliases, dept_aliases)
    city = lambda rows: F.col("municipio") if "municipio" in rows.columns else F.lit(None).cast("string").alias("municipio")
    whole = reduce(DataFrame.unionByName, [rows.select(F.lit(k).alias("of"), "norm", city(rows), "departamento", "ord") for k, rows in enumerate(made)]).toArrow()  # the caller's lists
    parts = [whole.filter(pc.equal(whole["of"], k)).select([c for c in whole.column_names if c in rows.columns]) for k, rows in enumerate(made)]
    sizes = {len([w for w in re.split(r"[^A-Z0-9Ñ]+", norm) if w]) for norm in whole["norm"].to_pylist()}
    held = Geography(*(spark.createDataFrame(part) for part in parts), whole.num_rows, sorted(sizes - {0}))
    if seeds:
        _SEEDS[spark] = held
    return held


_SEEDS: WeakKeyDictionary[SparkSession, Geography] = WeakKeyDictionary()


def _listed(spark: SparkSession, rows: list[tuple], **columns: pa.DataType) -> DataFrame:
    """A table of the rows of a list."""
    each = list(zip(*rows, strict=True)) or [()] * len(columns)
    return spark.createDataFrame(pa.table({c: pa.array(values, kind) for (c, kind), values in zip(columns.items(), each, strict=True)}))


def geography_of(listed: DataFrame, preferred=PREFERRED, city_aliases=CITY_ALIASES, dept_aliases=DEPT_ALIASES) -> Geography:
    """The name tables of listed(departamento, municipio, ord), as readers.geography_json gives them: departments and
    municipalities in the order of ord, a null municipality being a department without any. A row without a department
    and repeated rows count once or not at all. More than ALIAS_ORD municipalities are an error."""
    rows = listed.filter("departamento IS NOT NULL")
    depts = numbered(rows.groupBy("departamento").agg(F.min("ord").alias("first")), ["first", "departamento"], "n")
    cities = numbered(rows.filter("municipio IS NOT NULL").groupBy("municipio", "departamento").agg(F.min("ord").alias("first")), ["first", "departamento", "municipio"], "n")
    if (count := cities.count()) > ALIAS_ORD:
        raise ValueError(f"{count} municipalities, at most {ALIAS_ORD} can be told from aliases")
    place = (F.col("n") - 1).cast("int").alias("ord")
    made = _geography(depts.select("departamento", place), cities.select("municipio", "departamento", place), preferred, city_aliases, dept_aliases)
    return Geography(*made, *name_sizes(*made))


def _geography(departments: DataFrame, municipalities: DataFrame, preferred, city_aliases, dept_aliases) -> tuple[DataFrame, ...]:
    """The departments, their aliases, the cities and the homonyms of a Geography."""
    spark = departments.sparkSession
    depts = departments.select(plain(F.col("departamento")).alias("norm"), "departamento", "ord")
    text = pa.string()
    aliases = _listed(spark, [(a, d, i) for i, (a, d) in enumerate(dept_aliases)], norm=text, departamento=text, ord=pa.int32())
    raw = municipalities.select(plain(F.col("municipio")).alias("norm"), "municipio", "departamento", "ord")
    pref = _listed(spark, list(preferred), norm=text, departamento=text).withColumn("preferred", F.lit(1))
    listed = raw.join(pref, ["norm", "departamento"], "left").select("norm", "municipio", "departamento", "ord", F.when(F.col("preferred").isNotNull(), 1).otherwise(2).alias("rank"), F.col("ord").alias("place"))
    named = _listed(spark, [(a, m, d, ALIAS_ORD + i, 0, -i) for i, (a, m, d) in enumerate(city_aliases)], norm=text, municipio=text, departamento=text, ord=pa.int32(), rank=pa.int32(), place=pa.int32())
    first = W.partitionBy("norm").orderBy("rank", "place")
    cities = listed.unionByName(named).withColumn("ord", F.min("ord").over(W.partitionBy("norm"))).withColumn("rn", F.row_number().over(first)).filter("rn = 1").select("norm", "municipio", "departamento", "ord")
    return depts, aliases, cities, raw


def words(text: Column) -> Column:
    return F.split(text, r"[^A-Z0-9Ñ]+")


def name_words(norm: Column) -> Column:
    """A name as word n-grams of texts have it."""
    return F.filter(words(norm), lambda w: w != "")


def name_sizes(*names: DataFrame) -> tuple[int, list[int]]:
    """How many rows names(norm) have, and the numbers of words of their names."""
    each = [rows.select(F.size(name_words(F.col("norm"))).alias("n")) for rows in names]
    counted = reduce(DataFrame.unionByName, each).groupBy("n").count().filter("n > 0").collect()  # a row for each length
    return sum(r["count"] for r in counted), sorted(r["n"] for r in counted)


def named_in(texts: DataFrame, text: str, names: DataFrame, rows: int, sizes: list[int]) -> DataFrame:
    """Rows (text, columns of names) for each name that occurs in a text, however many words it has."""
    own = words(F.col(text))

    def runs(n: int) -> Column:
        """Every n words that follow one another; all of a text that has fewer."""
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(own) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(own, i, n), " "))

    found = texts.select(text).distinct().select(text, F.explode(F.array_distinct(F.concat(*map(runs, sizes or [1])))).alias("gram"))
    keyed = names.withColumn("gram", F.array_join(name_words(F.col("norm")), " "))
    return found.join(broadcast_if_small(keyed, rows), "gram").drop("gram").filter(F.rlike(F.col(text), F.concat(F.lit(r"\b\Q"), F.col("norm"), F.lit(r"\E\b")))).distinct()


def place_hits(texts: DataFrame, text: str, geo: Geography) -> DataFrame:
    """Every department, alias of one, and city that is named in a text, found in one join, with what kind of name it is.

    A city whose name is a department's too, or an alias of one, is marked to be passed over.
    """
    also = geo.departments.select("norm", F.col("departamento").alias("passed")).unionByName(geo.dept_aliases.select("norm", F.lit(None).cast("string").alias("passed")))
    also = also.groupBy("norm").agg(F.max("passed").alias("passed")).withColumn("skip", F.lit(True))
    empty, no = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    cities = geo.cities.filter(F.length("norm") >= 3).join(also, "norm", "left").select(F.lit("city").alias("of"), "norm", "municipio", "departamento", "ord", "passed", "skip")
    depts = [rows.select(F.lit(of).alias("of"), "norm", empty.alias("municipio"), "departamento", "ord", empty.alias("passed"), no.alias("skip")) for of, rows in (("department", geo.departments), ("alias", geo.dept_aliases))]
    return staged(named_in(texts, text, reduce(DataFrame.unionByName, [cities, *depts]), geo.rows, geo.sizes), "places")


def department_of(texts: DataFrame, text: str, geo: Geography, hits: DataFrame | None = None) -> DataFrame:
    """(text, departamento) of the longest department name in each text, else of the first alias."""
    hits = place_hits(texts, text, geo) if hits is None else hits
    rank = F.when(F.col("of") == "department", -F.length("norm")).otherwise(0)
    return hits.filter("of <> 'city'").groupBy(text).agg(F.min_by("departamento", F.struct(rank.alias("rank"), "ord")).alias("departamento"))


def municipality_of(texts: DataFrame, text: str, geo: Geography, hint: str = "hint", hits: DataFrame | None = None) -> DataFrame:
    """(text, hint, municipio, departamento) of the longest municipality name in each text of texts(text, hint).

    A name that is also a department's, or an alias of one, is passed over and remembered as context. The hint, or else
    what was passed over before, chooses among cities of the same name; without such a city the hit stands.
    """
    hits = place_hits(texts, text, geo) if hits is None else hits
    hits = hits.filter("of = 'city'").withColumn("place", F.struct((-F.length("norm")).alias("l"), F.col("ord").alias("o")))
    real = hits.filter("skip IS NULL").groupBy(text).agg(F.min_by(F.struct("norm", "municipio", "departamento", "place"), "place").alias("hit"))
    passed = hits.filter("skip AND passed IS NOT NULL").select(text, "passed", F.col("place").alias("before"))
    context = real.join(passed, text).filter(F.col("before") < F.col("hit.place")).groupBy(text).agg(F.min_by("passed", "before").alias("context"))
    found = texts.select(text, hint).distinct().join(real, text).join(context, text, "left").select(text, hint, "hit", plain(F.coalesce(hint, "context")).alias("wanted"))
    same = geo.homonyms.select(F.col("norm").alias("hnorm"), F.col("municipio").alias("hcity"), F.col("departamento").alias("hdept"), plain(F.col("departamento")).alias("wanted2"))
    direct = plain(F.col("hit.departamento")) == F.col("wanted")
    joined = found.join(broadcast_if_small(same, geo.rows), (F.col("hit.norm") == F.col("hnorm")) & (F.col("wanted") == F.col("wanted2")), "left")
    use = F.coalesce(~direct, F.lit(False)) & F.col("hcity").isNotNull()
    return joined.select(text, hint, F.when(use, F.col("hcity")).otherwise(F.col("hit.municipio")).alias("municipio"), F.when(use, F.col("hdept")).otherwise(F.col("hit.departamento")).alias("departamento"))


def locate(texts: DataFrame, geo: Geography, text: str = "clean", kind: str = "tipo") -> DataFrame:
    """texts with municipio and departamento: the municipality and its department, else the department alone; for a
    governor's office the department alone, if need be that of a city it names."""
    base = texts.select(text, kind).distinct()
    hits = place_hits(base, text, geo)
    depts = department_of(base, text, geo, hits).withColumnRenamed("departamento", "hint")
    hinted = base.join(depts, text, "left").withColumn("hint2", F.when(F.col(kind) != "GOBERNACION", F.col("hint")))
    cities = municipality_of(hinted.select(text, "hint2"), text, geo, "hint2", hits).select(F.col(text).alias("t2"), F.col("hint2").alias("h2"), F.col("municipio").alias("m"), F.col("departamento").alias("d"))
    both = hinted.join(cities, (F.col(text) == F.col("t2")) & F.col("hint2").eqNullSafe(F.col("h2")), "left")
    office = F.col(kind) == "GOBERNACION"
    found = both.select(text, kind, F.when(~office, F.col("m")).alias("municipio"), F.when(office, F.coalesce("hint", "d")).when(F.col("m").isNotNull(), F.col("d")).otherwise(F.col("hint")).alias("departamento"))
    return texts.join(found, [text, kind])


def resolve_cities(raw: DataFrame, geo: Geography, col: str = "ciudad") -> DataFrame:
    """(col, municipio, departamento) of distinct spellings: the name itself, without a D.C. or D.T. suffix, before a
    suffix that is part of some department's name, or its first one, two or three words."""
    names = geo.homonyms.select(norm_fold(F.col("municipio")).alias("key"), "municipio", "departamento", F.col("ord").alias("place"), F.lit(1).alias("rank"))
    alias = geo.cities.filter(F.col("ord") >= ALIAS_ORD).select(norm_fold(F.col("norm")).alias("key"), "municipio", "departamento", F.lit(0).alias("place"), F.lit(0).alias("rank"))
    table = names.unionByName(alias).groupBy("key").agg(F.min_by(F.struct("municipio", "departamento"), F.struct("rank", "place")).alias("to"))
    n = norm_fold(F.col(col))
    words = F.split("n", " ")
    short = F.trim(F.regexp_replace(F.trim(F.regexp_replace("n", r"\bD\s*\.?\s*C\s*\.?\s*$", "")), r"\bD\s*\.?\s*T\s*\.?\s*(Y\s*C\s*\.?)?\s*$", ""))
    at = F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1)))
    split = F.transform(at, lambda i: F.struct((1000 - i).alias("rank"), F.array_join(F.slice(words, 1, i), " ").alias("key"), F.array_join(F.slice(words, i + 1, 99), " ").alias("suffix")))
    lead = [F.struct(F.lit(2000 + k).alias("rank"), F.when((F.size(words) >= max(2, k)) & ((k > 1) | (F.length(words[0]) >= 4)), F.array_join(F.slice(words, 1, k), " ")).alias("key"), F.lit("").alias("suffix")) for k in (1, 2, 3)]
    fixed = [F.struct(F.lit(0).alias("rank"), F.col("n").alias("key"), F.lit("").alias("suffix")), F.struct(F.lit(1).alias("rank"), short.alias("key"), F.lit("").alias("suffix"))]
    tried = raw.select(col).distinct().select(col, n.alias("n")).filter("n <> ''").select(col, F.explode(F.concat(F.array(*fixed), split, F.array(*lead))).alias("c")).select(col, "c.*")
    depts = geo.departments.select(norm_fold(F.col("departamento")).alias("dn"))
    part = tried.filter("rank BETWEEN 2 AND 1999").join(F.broadcast(depts), F.contains("dn", "suffix"), "left_semi")
    whole = tried.filter("rank < 2 OR rank >= 2000")
    return whole.unionByName(part).join(F.broadcast(table), "key").groupBy(col).agg(F.min_by("to", "rank").alias("to")).select(col, "to.municipio", "to.departamento")


def provenance(entity_city: Column, entity_dept: Column, city: Column, city_dept: Column, raw: Column) -> tuple[Column, Column, Column]:
    """(municipio, departamento, source): of the entity, else of the resolved city, else the raw city as it is."""
    own, found, some = F.coalesce(entity_city, F.lit("")) != "", city.isNotNull(), strip(raw) != ""
    source = F.when(own, "entidad").when(found, "ciudad_original").when(some, "ciudad_sin_resolver").otherwise("sin_dato")
    return F.when(own, entity_city).when(found, city).when(some, strip(raw)), F.when(own, entity_dept).when(found, city_dept).otherwise(entity_dept), source


#: Names that stand for no place, and departments that are no municipality.
NO_PLACE = ["NO ENCONTRADO", "NO ENCONTRADA", "NO REGISTRA", "SIN INFORMACION", "BANCO SANTANDER", "CREDIFINANCIERA SANTANDER", "CONSEJO SECCIONAL DE LA JUDICATURA DEL ATLANTICO"]
DEPT_ONLY = ["ATLANTICO", "MAGDALENA", "VALLE DEL CAUCA", "HUILA", "CUNDINAMARCA", "ANTIOQUIA", "SANTANDER", "CASANARE", "NORTE DE SANTANDER", "TOLIMA", "QUINDIO", "CHOCO", "PUTUMAYO", "CAQUETA", "GUAVIARE", "VAUPES", "GUAINIA", "AMAZONAS", "VICHADA", "SAN ANDRES Y PROVIDENCIA", "SOCORRO", "META", "CESAR", "CORDOBA", "SUCRE"]
#: A name holding the key means the value; applied in order.
REWRITES = [("BOGOTA", "BOGOTA D C"), ("CARTAGENA", "CARTAGENA DE INDIAS"), ("MOMPOX", "MOMPOS"), ("MOMPOS", "MOMPOS"), ("SOCORRO", "SOCORRO"), ("FUENTEDEORO", "FUENTE DE ORO"), ("FUENTE DE ORO", "FUENTE DE ORO"), ("DORADA", "LA DORADA")]


def municipality_key(norm: Column) -> Column:
    """The normalised name under which a municipality is looked up; null for what is no municipality."""
    held = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)  # noqa: E731  each value is computed once
    rewrite = lambda part, to: lambda x: F.when(F.contains(x, F.lit(part)), to).otherwise(x)
    t = norm
    for part, to in REWRITES:
        t = held(t, rewrite(part, to))
    t = held(t, lambda x: F.when(x.isin(*NO_PLACE), None).when(F.contains(x, F.lit("SOCORRO")), "EL SOCORRO").otherwise(x))
    return held(t, lambda x: F.when(~x.isin(*DEPT_ONLY) & (x != ""), x))


def resolve_ids(rows: DataFrame, municipios: DataFrame, departamentos: DataFrame) -> DataFrame:
    """rows(key, dept_key) with municipio_id and departamento_id.

    municipios(norm, departamento_id, municipio_id), departamentos(norm, departamento_id), with `ord` if their order is not that
    of the ids: by name and department, else by a name that only one department has. A department is matched whole, else
    with the first that holds it or is held.
    """
    order = "ord" if "ord" in departamentos.columns else "departamento_id"
    exact = departamentos.select(F.col("norm").alias("dept_key"), F.col("departamento_id").alias("d1"))
    held = F.contains("norm", "dept_key") | F.contains("dept_key", "norm")
    partial = rows.select("dept_key").distinct().filter("dept_key <> ''").join(F.broadcast(departamentos), held).groupBy("dept_key").agg(F.min_by("departamento_id", order).alias("d2"))
    alone = municipios.groupBy(F.col("norm").alias("key")).agg(F.min("municipio_id").alias("m2"), F.count("*").alias("c")).filter("c = 1").drop("c")
    own = municipios.select(F.col("norm").alias("key"), F.col("departamento_id").alias("d1"), F.col("municipio_id").alias("m1"))
    out = rows.join(F.broadcast(exact), "dept_key", "left").join(F.broadcast(own), ["key", "d1"], "left").join(F.broadcast(alone), "key", "left").join(F.broadcast(partial), "dept_key", "left")
    return out.select(*rows.columns, F.coalesce("m1", "m2").alias("municipio_id"), F.coalesce("d1", "d2").alias("departamento_id"))
