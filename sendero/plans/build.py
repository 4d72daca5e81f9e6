"""One run from two raw files to the loaded model: read, resolve, build five tables, and let them take effect together.

Every table of facts is written once; rows are counted where they pass, by metrics observed in the jobs that run anyway.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sendero.functions import classify, geo, text
from sendero.operators import model, resolve
from sendero.sources import load, readers, sinks
from sendero.sources.stage import broadcast_if_small, staged, staging

KEY = ["tipo", "subtipo", "numero", "lugar"]
#: Positions of the columns that are used, how many a file has, and the fewest that a row must have.
ORDER_COLUMNS = {
    0: "id", 3: "confirmed_at", 4: "correo", 6: "created_at", 9: "direccion", 12: "remitente", 13: "estado", 15: "fecha_oficio", 16: "fecha_recepcion", 17: "funcionario",
    20: "monto", 22: "numero_oficio", 25: "processed_at", 27: "referencia", 29: "titulo_orden", 30: "titulo_embargo", 35: "banco",
}
ORDER_WIDTH, ORDER_LEAST = 44, 36
CHILD_COLUMNS = {5: "expediente", 7: "id_demandado", 10: "monto_a_embargar", 12: "nombre_demandado", 15: "embargo_id", 17: "tipo_id_demandado"}
CHILD_WIDTH, CHILD_LEAST = 19, 18
#: Texts that mean no mail and no address.
NO_MAIL = ["noencontrada", "no encontrada", "no encontrado", ""]
NO_ADDRESS = ["no encontrada", "no encontrado", ""]
#: Other spellings under which departments are looked up.
DEPARTMENT_KEYS = [
    ("BOGOTA", "Bogotá, D.C."), ("BOGOTA D C", "Bogotá, D.C."), ("BOGOTA DC", "Bogotá, D.C."), ("BOGOTA D.C.", "Bogotá, D.C."), ("BOGOTA  D.C.", "Bogotá, D.C."), ("BOGOTA D.C", "Bogotá, D.C."),
    ("SAN ANDRES", "San Andrés y Providencia"), ("SAN ANDRES Y PROVIDENCIA", "San Andrés y Providencia"), ("SAN ANDRES ISLAS", "San Andrés y Providencia"), ("SAN ANDRES  PROVIDENCIA Y SANTA CATALINA", "San Andrés y Providencia"),
    ("NORTE DE SANTANDER", "Norte de Santander"), ("VALLE DEL CAUCA", "Valle del Cauca"), ("VALLE", "Valle del Cauca"),
]
#: The 26 columns of the cleaned orders, and where each comes from; '' for those that are always blank.
CLEAN = {
    "embargo_id": "id", "entidad_remitente_id": "entidad_id", "entidad_bancaria_id": "banco", "estado_embargo": "estado", "numero_oficio": "numero_oficio", "fecha_oficio": "fecha_oficio", "fecha_recepcion": "fecha_recepcion",
    "titulo_embargo": "titulo_embargo", "titulo_orden": "titulo_orden", "monto": "monto", "monto_a_embargar": "monto_a_embargar", "nombre_demandado": "nombre_demandado", "id_demandado": "id_demandado", "tipo_id_demandado": "tipo_id_demandado",
    "nombre_demandante": "", "id_demandante": "", "tipo_id_demandante": "", "nombre_remitente": "nombre", "direccion_remitente": "direccion", "correo_remitente": "correo", "nombre_personal_remitente": "funcionario",
    "referencia": "referencia", "expediente": "expediente", "created_at": "created_at", "confirmed_at": "confirmed_at", "processed_at": "processed_at",
}
RULES = {
    "dim_departamentos": load.Rules(key=("departamento_id",)),
    "dim_municipios": load.Rules(key=("municipio_id",), refers=(("departamento_id", "dim_departamentos", "departamento_id"),)),
    "dim_entidades": load.Rules(key=("entidad_id",), refers=(("municipio_id", "dim_municipios", "municipio_id"), ("departamento_id", "dim_departamentos", "departamento_id"))),
    "dim_variantes": load.Rules(key=("variante_id",), refers=(("entidad_id", "dim_entidades", "entidad_id"),)),
    "fact_oficios": load.Rules(key=("oficio_id",), refers=(("entidad_remitente_id", "dim_entidades", "entidad_id"), ("municipio_id", "dim_municipios", "municipio_id"), ("departamento_id", "dim_departamentos", "departamento_id"))),
}


@dataclass(frozen=True)
class Built:
    """The manifest of a load and how many rows came, went and lacked something on the way."""

    manifest: load.Manifest
    counts: dict[str, int]


def read_orders(spark: SparkSession, path: str, read: Observation, kept: Observation, city: str = "ciudad") -> DataFrame:
    """Orders, cleaned, with `pos`, their place in the files; rows of too few fields and of excluded status are left out.

    The city is taken from the column of that name, wherever it stands, and blank without one.
    """
    header = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True).columns
    wanted = dict(ORDER_COLUMNS)
    if at := readers.header_column(header, city.upper()):
        wanted[header.index(at)] = "ciudad"
    rows = readers.positional_csv(spark, path, max(ORDER_WIDTH, len(header)), wanted, ORDER_LEAST, read)
    rows = rows.withColumn("pos", F.monotonically_increasing_id())
    trimmed = rows.select("pos", *[text.strip(F.col(c)).alias(c) for c in wanted.values()], *([] if at else [F.lit("").alias("ciudad")]))
    made = trimmed.withColumns({"correo": text.blank_if(F.col("correo"), NO_MAIL), "direccion": text.blank_if(F.col("direccion"), NO_ADDRESS), "banco": text.whole_number(F.col("banco"))})
    known = model.known_status(F.col("estado"))
    made = made.observe(kept, F.count_if(~known).alias("estado_excluido"), F.count_if(known).alias("oficios"))
    return staged(made.filter(known), "orders")


def read_children(spark: SparkSession, path: str, read: Observation) -> DataFrame:
    """The first defendant of each order, in the order of the file."""
    rows = readers.positional_csv(spark, path, CHILD_WIDTH, CHILD_COLUMNS, CHILD_LEAST, read).withColumn("pos", F.monotonically_increasing_id())
    trimmed = rows.select("pos", *[text.strip(F.col(c)).alias(c) for c in CHILD_COLUMNS.values()]).withColumn("nombre_demandado", text.strip_commas(F.col("nombre_demandado")))
    fields = [c for c in CHILD_COLUMNS.values() if c != "embargo_id"]
    first = trimmed.filter("embargo_id <> ''").groupBy("embargo_id").agg(F.min_by(F.struct(*fields), "pos").alias("child"))
    return staged(first.select(F.col("embargo_id").alias("id"), "child.*"), "children")


def resolved_names(orders: DataFrame, g: geo.Geography, places: list[str]) -> tuple[DataFrame, DataFrame]:
    """(spellings with the key of their entity, entities) of the senders of orders."""
    names = orders.groupBy(F.col("remitente").alias("raw")).agg(F.count("*").alias("n"), F.min("pos").alias("seen"))
    named = classify.with_default_places(geo.locate(staged(classify.classified(names), "classified"), g))
    blocked = staged(resolve.blocks(named), "placed")
    free = resolve.core_text(blocked.filter(F.contains("lugar", F.lit("__NO_"))), places)
    clusters = resolve.anchor_clusters(free, KEY, [F.desc("n"), F.col("seen")]).select("raw", "cluster")
    grouped = staged(blocked.join(clusters, "raw", "left").withColumn("cluster", F.coalesce("cluster", F.lit(0))), "clustered")
    depts = g.departments.unionByName(g.dept_aliases.withColumn("ord", F.col("ord") + geo.ALIAS_ORD))
    spelled = staged(resolve.recover_places(grouped, g.cities, depts).drop("lugar").withColumnRenamed("lugar2", "lugar"), "recovered")
    return spelled, staged(resolve.entities(spelled, KEY), "entities")


def place_tables(g: geo.Geography) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """dim_departamentos, dim_municipios, and the two under the keys by which names are looked up, in listed order."""
    spark = g.departments.sparkSession
    listed = g.departments.select(F.col("departamento").alias("nombre"), "ord").unionByName(g.cities.select(F.col("departamento").alias("nombre"), (F.col("ord").cast("bigint") + geo.ALIAS_ORD).alias("ord")))
    departments = staged(model.numbered(listed.groupBy("nombre").agg(F.min("ord").alias("ord")), ["ord", "nombre"], "departamento_id"), "departments")
    own = departments.select(text.norm_keep(F.col("nombre")).alias("norm"), "departamento_id", F.col("ord").cast("bigint").alias("ord"))
    other = spark.createDataFrame([(a, d, i) for i, (a, d) in enumerate(DEPARTMENT_KEYS)], "alias string, nombre string, i int").join(departments, "nombre")
    other = other.select(text.norm_keep(F.col("alias")).alias("norm"), "departamento_id", (F.col("i").cast("bigint") + 4 * geo.ALIAS_ORD).alias("ord"))
    keys = own.unionByName(other).groupBy("norm").agg(F.max_by("departamento_id", "ord").alias("departamento_id"), F.min("ord").alias("ord"))
    cities = g.homonyms.groupBy(text.norm_keep(F.col("municipio")).alias("norm"), "departamento").agg(F.min_by("municipio", "ord").alias("nombre"), F.min("ord").alias("ord"))
    cities = cities.join(departments.select(F.col("nombre").alias("departamento"), "departamento_id"), "departamento")
    cities = staged(model.numbered(cities, ["ord", "departamento_id", "norm"], "municipio_id"), "cities")
    return departments.select("departamento_id", "nombre"), cities.select("municipio_id", "nombre", "departamento_id"), staged(keys, "keys"), cities.select("norm", "departamento_id", "municipio_id")


def placed_ids(rows: DataFrame, keys: DataFrame, cities: DataFrame) -> DataFrame:
    """rows(municipio, departamento, ...) with municipio_id and departamento_id; each pair of names is looked up once."""
    pairs = rows.select("municipio", "departamento").distinct()
    asked = pairs.withColumns({"key": F.coalesce(geo.municipality_key(text.norm_keep(F.coalesce("municipio", F.lit("")))), F.lit("")), "dept_key": text.norm_keep(F.coalesce("departamento", F.lit("")))})
    found = staged(geo.resolve_ids(asked, cities, keys).select("municipio", "departamento", "municipio_id", "departamento_id"), "ids")
    known = broadcast_if_small(found.withColumnsRenamed({"municipio": "_m", "departamento": "_d"}), found.count())
    return rows.join(known, F.col("municipio").eqNullSafe(F.col("_m")) & F.col("departamento").eqNullSafe(F.col("_d")), "left").drop("_m", "_d")


def clean_orders(fact: DataFrame) -> DataFrame:
    """The 26 columns of resolved orders as text, '' for what is missing; a sender without an entity keeps its spelling."""
    source = {**{c: F.col(c) for c in fact.columns}, "nombre": F.coalesce("nombre", "remitente"), "": F.lit("")}
    return fact.select(*[F.coalesce(source[c].cast("string"), F.lit("")).alias(name) for name, c in CLEAN.items()])


def build(spark: SparkSession, orders_path: str, children_path: str, folder: str, g: geo.Geography | None = None, places: list[str] | None = None, clean_csv: str | None = None) -> Built:
    """Read both files, resolve their senders and load the model's five tables into a folder, all or none.

    clean_csv: a folder for the cleaned orders as CSV, which are written before the load and replaced by each run.

    places: names that are no part of an entity's core; by default those of the geography. Counts: filas, filas_cortas (of
    either file), estado_excluido, oficios, sin_entidad, con_demandado, sin_municipio and sin_departamento of the facts.
    """
    with staging(spark):
        return _build(spark, orders_path, children_path, folder, g, places, clean_csv)


def _build(spark: SparkSession, orders_path: str, children_path: str, folder: str, g: geo.Geography | None, places: list[str] | None, clean_csv: str | None) -> Built:
    g = g or geo.geography(spark)
    seen = {name: Observation(name) for name in ("orders", "kept", "children", "facts")}
    orders = read_orders(spark, orders_path, seen["orders"], seen["kept"])
    children = read_children(spark, children_path, seen["children"])
    if places is None:
        places = sorted({r[0] for r in g.departments.select("norm").unionByName(g.homonyms.select("norm")).collect()})  # the listing of places
    spelled, entities = resolved_names(orders, g, places)
    dim_d, dim_m, keys, cities = place_tables(g)
    dim_e = placed_ids(entities, keys, cities).select("entidad_id", F.col("nombre").alias("nombre_normalizado"), "tipo", "subtipo", "municipio_id", "departamento_id", "total_registros", "num_variantes")
    variants = staged(spelled.join(entities.select("entidad_id", "nombre", F.col("municipio").alias("em"), F.col("departamento").alias("ed"), *KEY), KEY), "variants")
    ranked = model.numbered(variants.select("entidad_id", F.col("nombre").alias("nombre_normalizado"), F.col("raw").alias("variante_original"), F.col("n").alias("conteo")), ["entidad_id", F.desc("conteo"), "variante_original"], "variante_id")
    towns = geo.resolve_cities(orders, g).withColumnsRenamed({"municipio": "cm", "departamento": "cd"})
    by_name = broadcast_if_small(variants.select(F.col("raw").alias("remitente"), "entidad_id", "nombre", "em", "ed"), variants.count())
    fact = orders.join(by_name, "remitente", "left").join(children, "id", "left").join(towns, "ciudad", "left")
    if clean_csv:
        sinks.write_csv(clean_orders(fact), clean_csv, list(CLEAN))
    city, dept, source = geo.provenance(F.col("em"), F.col("ed"), F.col("cm"), F.col("cd"), F.col("ciudad"))
    fact = placed_ids(fact.withColumns({"municipio": city, "departamento": dept, "fuente_ubicacion": source}), keys, cities)
    same = ["estado", "numero_oficio", "fecha_oficio", "fecha_recepcion", "titulo_embargo", "titulo_orden", "monto", "monto_a_embargar", "nombre_demandado", "id_demandado", "tipo_id_demandado", "municipio_id", "departamento_id", "fuente_ubicacion", "referencia", "expediente", "created_at", "confirmed_at", "processed_at"]
    renamed = {"id": "oficio_id", "entidad_id": "entidad_remitente_id", "banco": "entidad_bancaria_id", "direccion": "direccion_remitente", "correo": "correo_remitente", "funcionario": "nombre_funcionario"}
    fact = fact.select(*[F.col(c).cast("string").alias(c) for c in same], *[F.col(c).cast("string").alias(to) for c, to in renamed.items()])
    missing = {"sin_entidad": "entidad_remitente_id", "sin_municipio": "municipio_id", "sin_departamento": "departamento_id"}
    fact = fact.observe(seen["facts"], *[F.count_if(F.col(c).isNull()).alias(n) for n, c in missing.items()], F.count_if(F.col("nombre_demandado").isNotNull()).alias("con_demandado"))
    given = {"dim_departamentos": dim_d, "dim_municipios": dim_m, "dim_entidades": dim_e, "dim_variantes": ranked, "fact_oficios": fact}
    done = load.load(spark, folder, {name: model.typed(rows, name) for name, rows in given.items()}, RULES)
    counts = {**seen["kept"].get, **seen["facts"].get}
    counts |= {f"{k}{suffix}": v for name, suffix in (("orders", ""), ("children", "_demandado")) for k, v in seen[name].get.items()}
    return Built(done, counts)
