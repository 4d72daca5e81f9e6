"""Queries of the third model: enrichment from registries, its dimension, and the counters and guards around it."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sendero.functions import geo, text
from sendero.operators import enrich, model, quality, schema
from sendero.plans.registry import query, table
from sendero.sources import load
from sendero.sources.stage import shared_folder

# Entities and registries derived from parts and suppliers, by the same expressions for Spark and for DuckDB.
_ENTITY = {
    "entidad_id": "p_partkey",
    "nombre_extraido": "p_name || CASE WHEN p_partkey % 2 = 0 THEN ' ' || (p_partkey % 5) ELSE '' END",
    "ciudad": "CASE WHEN p_partkey % 3 = 0 THEN 'null' ELSE 'ciudad ' || (p_partkey % 7) END",
    "email_extraido": "CASE WHEN p_partkey % 4 = 0 THEN ' ' ELSE 'e' || p_partkey || '@a.co' END",
    "numero_despacho": "'n' || (p_partkey % 9)",
    "total_registros": "p_partkey * 2",
}
_LISTED = {
    "rid": "rid",
    "nombre": "p_name || CASE WHEN rid % 3 = 1 THEN ' ' || (rid % 7) || ' sede' ELSE '' END",
    "ciudad": "CASE WHEN rid % 5 = 0 THEN 'NULL' ELSE 'sede ' || (rid % 4) END",
    **{c: f"CASE WHEN rid % 6 = {i % 6} THEN 'nan' ELSE ' {c} ' || (rid % 11) END" for i, c in enumerate(dict.fromkeys(["nit", "cod_institucion", "email_real", "orden", "sector", "naturaleza_juridica", "tipo_institucion", "direccion", "telefono", "pagina_web", "estado", "representante", "cargo_representante", "codigo_despacho", "jurisdiccion", "distrito", "circuito", "juez", "area"]))},
}
_NAMED = "SELECT p_name, min(p_partkey) AS rid FROM part GROUP BY p_name"


def _selected(expressions):
    return ", ".join(f"{e} AS {c}" for c, e in expressions.items())


def _clean(c):
    return f"CASE WHEN upper(trim(coalesce({c}, ''))) IN ('', 'NULL', 'NONE', 'NAN') THEN '' ELSE trim({c}) END"


_TOKENS = "list_distinct(list_filter(string_split({}, ' '), lambda w: w <> ''))"
_NUMBERS = "list_distinct(regexp_extract_all({}, '\\d+'))"
_SCORE = f"len(list_intersect(a, b))::DOUBLE / len(list_distinct(list_concat(a, b))) * CASE WHEN len({_NUMBERS.format('norm')}) > 0 AND len({_NUMBERS.format('rnorm')}) > 0 AND len(list_intersect({_NUMBERS.format('norm')}, {_NUMBERS.format('rnorm')})) = 0 THEN 0.5 ELSE 1 END"
_MATCHED = f"""e AS (SELECT {_selected(_ENTITY)} FROM part), l AS (SELECT {_selected(_LISTED)} FROM ({_NAMED})),
en AS (SELECT DISTINCT upper(nombre_extraido) AS norm FROM e), ea AS (SELECT norm, {_TOKENS.format('norm')} AS a FROM en),
lb AS (SELECT rid, upper(nombre) AS rnorm, {_TOKENS.format('upper(nombre)')} AS b FROM l),
m AS (SELECT norm, rid, norm = rnorm AS same, CASE WHEN norm = rnorm THEN 1.0::DOUBLE ELSE {_SCORE} END AS score FROM ea, lb WHERE len(list_intersect(a, b)) > 0),
best AS (SELECT norm, rid FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY same DESC, score DESC, rid) AS rn FROM m WHERE score >= 0.6) WHERE rn = 1),
j AS (SELECT e.*, {", ".join(f"{_clean(f'l.{c}')} AS l_{c}" for c in _LISTED if c != "rid")} FROM e LEFT JOIN best ON norm = upper(nombre_extraido) LEFT JOIN l USING (rid))"""


def _out(columns, taken):
    """SQL of the columns of an enriched table."""
    made = {
        "entidad_id": "entidad_id",
        "total_registros": "total_registros",
        "nombre_extraido": "upper(nombre_extraido)",
        "numero_despacho": f"upper({_clean('numero_despacho')})",
        "nombre_real": "upper(l_nombre)",
    }
    named = {c: made.get(c) or (f"l_{c}" if c in enrich.AS_SPELLED else f"upper(l_{c})") for c in columns}
    named["ciudad"] = f"upper({_clean('j.ciudad')})"
    named["email_extraido"] = f"upper({_clean('email_extraido')})"
    if "nit" in taken:
        named["email_extraido"] = f"coalesce(nullif({named['email_extraido']}, ''), upper(l_email_real))"
    else:
        named |= {"ciudad": f"coalesce(nullif({named['ciudad']}, ''), upper(l_ciudad))", "email_real": "''"}
    return ", ".join(f"{e} AS {c}" for c, e in named.items())


_COERCIVE = f"coa AS (SELECT {_out(enrich.COERCIVE, enrich.FROM_COERCIVE)} FROM j WHERE entidad_id % 3 <> 1)"
_JUDICIAL = f"jud AS (SELECT {_out(enrich.JUDICIAL, enrich.FROM_JUDICIAL)} FROM j WHERE entidad_id % 3 = 1)"
_JUDGES = "entidad_id % 3 = 1"  # the third of the entities that are courts


def _entities(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(*(f"{e} AS {c}" for c, e in _ENTITY.items()))


def _listed(spark, sf_dir, taken, city=None):
    named = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("rid"))
    return enrich.registry(named.selectExpr(*(f"{e} AS {c}" for c, e in _LISTED.items())), taken, "nombre", city)


@query(f"WITH {_MATCHED}, {_COERCIVE} SELECT * FROM coa")
def q_enrich_coercive(spark, sf_dir):
    return enrich.enrich_coercive(_entities(spark, sf_dir).filter(f"NOT ({_JUDGES})"), _listed(spark, sf_dir, enrich.FROM_COERCIVE))


@query(f"WITH {_MATCHED}, {_JUDICIAL} SELECT * FROM jud")
def q_enrich_judicial(spark, sf_dir):
    return enrich.enrich_judicial(_entities(spark, sf_dir).filter(_JUDGES), _listed(spark, sf_dir, enrich.FROM_JUDICIAL, "ciudad"))


_BASE = {"entidad_id": "p_partkey", "nombre_normalizado": "p_name", "tipo": "p_brand", "subtipo": "p_type", "municipio_id": "p_size", "departamento_id": "p_size % 5", "num_variantes": "p_size % 3"}


@query(f"""WITH {_MATCHED}, {_COERCIVE}, {_JUDICIAL}, base AS (SELECT {_selected(_BASE)} FROM part WHERE p_partkey % 10 <> 0),
u AS (SELECT entidad_id, nombre_extraido, nombre_real, direccion, telefono, ciudad, total_registros, 'COACTIVA' AS categoria, nit, cod_institucion, coalesce(nullif(email_extraido, ''), email_real) AS email, orden, sector, naturaleza_juridica, estado, representante FROM coa
UNION ALL SELECT entidad_id, nombre_extraido, nombre_real, direccion, telefono, ciudad, total_registros, 'JUDICIAL', '', codigo_despacho, email_extraido, jurisdiccion, area, '', '', juez FROM jud)
SELECT entidad_id, upper(coalesce(nombre_normalizado, nombre_extraido)) AS nombre_normalizado, nombre_real, upper(coalesce(tipo, '')) AS tipo, upper(coalesce(subtipo, '')) AS subtipo, categoria, nit, cod_institucion, email, direccion, telefono, ciudad, municipio_id, departamento_id, orden, sector, naturaleza_juridica, estado, representante, total_registros, coalesce(num_variantes, 0) AS num_variantes FROM u LEFT JOIN base USING (entidad_id)""")
def q_dim_entities_v3(spark, sf_dir):
    base = table(spark, sf_dir, "part").selectExpr(*(f"{e} AS {c}" for c, e in _BASE.items())).filter("entidad_id % 10 <> 0")
    return enrich.unified(base, q_enrich_coercive(spark, sf_dir), q_enrich_judicial(spark, sf_dir))


_RAW_AMOUNT = "CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'no consta' WHEN 2 THEN NULL ELSE ' ' || CAST(o_orderkey AS VARCHAR) || '.25 ' END"


@query(f"SELECT o_orderstatus AS estado, CAST(sum(m) AS DECIMAL(30, 2)) AS suma, count(m) AS con_monto, count(*) AS filas FROM (SELECT o_orderstatus, TRY_CAST(nullif(trim({_RAW_AMOUNT}), '') AS DECIMAL(20, 2)) AS m FROM orders) GROUP BY 1")
def q_parsable_amounts(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderstatus", text.amount(F.expr(_RAW_AMOUNT.replace("VARCHAR", "STRING"))).alias("m"))
    return o.groupBy(F.col("o_orderstatus").alias("estado")).agg(F.sum("m").cast("decimal(30,2)").alias("suma"), F.count("m").alias("con_monto"), F.count("*").alias("filas"))


_DEPT = "CASE c_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE 'd' || c_nationkey END"


@query(f"SELECT coalesce(nullif(trim({_DEPT}), ''), 'Sin departamento') AS departamento, count(*) AS entidades, CAST(sum(c_custkey) AS BIGINT) AS registros FROM customer GROUP BY 1")
def q_department_counters(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(quality.labelled(F.expr(_DEPT), "Sin departamento").alias("departamento"), "c_custkey")
    return c.groupBy("departamento").agg(F.count("*").alias("entidades"), F.sum("c_custkey").alias("registros"))


_DELETED = "CASE event_id % 5 WHEN 0 THEN TRUE WHEN 1 THEN NULL ELSE FALSE END"


@query(f"SELECT event_id, event_type FROM events WHERE ({_DELETED}) = FALSE")
def q_not_deleted(spark, sf_dir):
    """Rows that are not marked as deleted; an unknown mark leaves a row out, as = does."""
    return model.not_deleted(table(spark, sf_dir, "events").withColumn("deleted", F.expr(_DELETED))).select("event_id", "event_type")


_COMMAS = "CASE o_orderkey % 5 WHEN 0 THEN ' , ' || o_orderpriority || ' ,, ' WHEN 1 THEN ',a, b,' WHEN 2 THEN NULL WHEN 3 THEN ' ,, ' ELSE o_orderpriority END"


@query(f"SELECT o_orderkey, coalesce(trim(trim(trim({_COMMAS}), ',')), '') AS texto FROM orders")
def q_strip_commas(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", text.strip_commas(F.expr(_COMMAS)).alias("texto"))


@query("SELECT CAST(row_number() OVER (ORDER BY p_name, p_brand) AS BIGINT) AS variante_id, p_name AS nombre, p_brand AS variante, count(*) AS conteo FROM part GROUP BY p_name, p_brand")
def q_variant_ids(spark, sf_dir):
    v = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("nombre"), F.col("p_brand").alias("variante")).agg(F.count("*").alias("conteo"))
    return model.numbered(v, ["nombre", "variante"], "variante_id")


_PAIR_E = "SELECT event_id, user_id, event_type, event_id % 3 AS ref FROM events"
_LEVELS = [("user_id", "event_type", "ref"), ("user_id", "event_type"), ("user_id",)]


def _level(k, keys):
    return f"l{k} AS (SELECT {', '.join(keys)}, min(event_id) AS par FROM e WHERE event_id % 10 = 0 GROUP BY ALL)"


@query(f"""WITH e AS ({_PAIR_E}), {', '.join(_level(k, keys) for k, keys in enumerate(_LEVELS, 1))}
SELECT event_id, coalesce(l1.par, l2.par, l3.par) AS par, CASE WHEN l1.par IS NOT NULL THEN 1 WHEN l2.par IS NOT NULL THEN 2 ELSE 3 END AS nivel
FROM e {' '.join(f"LEFT JOIN l{k} ON " + " AND ".join(f"l{k}.{c} = e.{c}" for c in keys) for k, keys in enumerate(_LEVELS, 1))} WHERE event_id % 10 <> 0 AND l3.par IS NOT NULL""")
def q_fallback_three_levels(spark, sf_dir):
    """Matches by person, type and reference, else by person and type, else by person alone."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", (F.col("event_id") % 3).alias("ref"))
    base, own = e.filter("event_id % 10 = 0"), e.filter("event_id % 10 <> 0")
    levels = [own.join(base.groupBy(*keys).agg(F.min("event_id").alias("par")), list(keys)).select("event_id", "par") for keys in _LEVELS]
    return model.cascade(own, "event_id", levels)


@query("SELECT o_orderkey, coalesce(c_name, 'cliente ' || (o_custkey + o_orderkey % 2 * 1000000000)) AS remitente FROM orders LEFT JOIN customer ON c_custkey = o_custkey + o_orderkey % 2 * 1000000000")
def q_entity_name_or_raw(spark, sf_dir):
    """The canonical name of a sender's id, else the text as it came."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.expr("o_custkey + o_orderkey % 2 * 1000000000").alias("c_custkey"))
    raw = F.concat(F.lit("cliente "), "c_custkey")
    return o.join(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", "left").select("o_orderkey", F.coalesce("c_name", raw).alias("remitente"))


_SIMILAR = "CAST(0.80 + (o_orderkey % 20) / 100.0 AS DOUBLE)"


@query(f"SELECT CASE WHEN x >= 0.92 THEN 'alta' WHEN x >= 0.85 THEN 'media' ELSE 'baja' END AS confianza, count(*) AS pares, CAST(sum(o_custkey) AS BIGINT) AS registros FROM (SELECT {_SIMILAR} AS x, o_custkey FROM orders) GROUP BY 1")
def q_confidence_buckets(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(quality.confidence(F.expr(_SIMILAR)).alias("confianza"), "o_custkey")
    return o.groupBy("confianza").agg(F.count("*").alias("pares"), F.sum("o_custkey").alias("registros"))


@query("SELECT p_name AS nombre, count(*) AS piezas, len(list_distinct(list(p_type))) AS variantes FROM part GROUP BY p_name HAVING contains(lower(p_name), 'an') OR len(list_filter(list(p_type), lambda v: contains(lower(v), 'brass'))) > 0")
def q_search_any_variant(spark, sf_dir):
    """Groups whose name or any variant holds the text that is sought, whatever its case."""
    g = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("nombre")).agg(F.count("*").alias("piezas"), F.collect_set("p_type").alias("v"))
    hit = F.lower("nombre").contains("an") | F.exists("v", lambda v: F.lower(v).contains("brass"))
    return g.filter(hit).select("nombre", "piezas", F.size("v").cast("bigint").alias("variantes"))


_FOUR = {"estado": "o_orderstatus", "tipo": "o_orderpriority", "remitente": "'r' || (o_custkey % 50)", "banco": "'b' || (o_custkey % 9)"}


@query(" UNION ALL ".join(f"SELECT '{n}' AS que, {e} AS valor, count(*) AS n FROM orders GROUP BY 2" for n, e in _FOUR.items()))
def q_four_counters(spark, sf_dir):
    """Frequencies of status, type, sender and bank in one scan."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("que"), F.expr(e).alias("valor")) for n, e in _FOUR.items()]))
    return table(spark, sf_dir, "orders").select(pairs.alias("x")).groupBy("x.que", "x.valor").agg(F.count("*").alias("n"))


_DRIFT = [("orders", "o_orderkey % 200 <> 0"), ("lineitem", "l_orderkey % 11 <> 0"), ("customer", "c_custkey > 0")]


@query(" UNION ALL ".join(f"SELECT '{t}' AS tabla, origen, destino, destino - origen AS diferencia, round((destino - origen) * 100.0::DOUBLE / origen, 4) AS porcentaje, CASE WHEN abs(destino - origen) * 100.0::DOUBLE / origen < 1 THEN 'ok' ELSE 'fail' END AS veredicto FROM (SELECT count(*) AS origen, count_if({kept}) AS destino FROM {t})" for t, kept in _DRIFT))
def q_row_drift(spark, sf_dir):
    """Rows of a source against those that were loaded."""
    return quality.row_drift([(t, table(spark, sf_dir, t), table(spark, sf_dir, t).filter(kept)) for t, kept in _DRIFT])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY sha256('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 1000")
def q_sample_of(spark, sf_dir):
    """A thousand orders, exactly, by seeded hash: sampling is the operator."""
    return quality.sample_of(table(spark, sf_dir, "orders"), "o_orderkey", 1000).select("o_orderkey", "o_custkey", "o_totalprice")


# A listing of places with names of up to eight words, and offices that name them whole, in part, or only their region.
_LONG = "n_name || CASE WHEN n_nationkey % 2 = 0 THEN ' de la Segunda Zona del Norte' ELSE '' END"
_SHORT = "n_nationkey % 2 = 0 AND s_suppkey % 4 = 0"


@query(f"WITH x AS (SELECT s_suppkey, {_LONG} AS m, r.r_name AS d, o.r_name AS other, {_SHORT} AS short FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region r ON r.r_regionkey = n_regionkey JOIN region o ON o.r_regionkey = s_suppkey % 5) SELECT s_suppkey, CASE WHEN NOT short THEN m END AS municipio, CASE WHEN NOT short THEN d WHEN s_suppkey % 3 = 0 THEN other END AS departamento FROM x")
def q_listing_places(spark, sf_dir):
    """Places of a whole listing, of any number of words, in the names of offices."""
    nations = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    listed = nations.select(F.col("r_name").alias("departamento"), F.expr(_LONG).alias("municipio"), F.col("n_nationkey").cast("int").alias("ord"))
    g = geo.geography_of(listed, preferred=[], city_aliases=[], dept_aliases=[])
    other = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("o"), F.col("r_name").alias("other"))
    offices = table(spark, sf_dir, "supplier").join(F.broadcast(nations), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(other), F.col("s_suppkey") % 5 == F.col("o"))
    told = F.expr(f"upper('oficina de ' || CASE WHEN {_SHORT} THEN n_name ELSE {_LONG} END || CASE WHEN s_suppkey % 3 = 0 THEN ' ' || other ELSE '' END)")
    return geo.locate(offices.select("s_suppkey", told.alias("clean"), F.lit("ALCALDIA").alias("tipo")), g).select("s_suppkey", "municipio", "departamento")


_OFFICE = "CASE p_partkey % 4 WHEN 0 THEN 'JUZGADO' WHEN 1 THEN 'ALCALDIA' WHEN 2 THEN 'FISCALIA' ELSE 'OTRO' END"


@query(f"SELECT CASE WHEN p_partkey % 2 = 0 THEN 'judicial' ELSE 'coactiva' END AS vista, CAST(p_partkey AS INT) AS entidad_id, p_name AS nombre_extraido, {_OFFICE} AS tipo, n_name AS ciudad, CAST(p_size AS INT) AS total_registros FROM part LEFT JOIN nation ON n_nationkey = p_size AND p_size < 20")
def q_entity_views(spark, sf_dir):
    """Both views of the third model, over entities in the columns and types of its tables."""
    entities = table(spark, sf_dir, "part").selectExpr("p_partkey AS entidad_id", "p_name AS nombre_normalizado", f"{_OFFICE} AS tipo", "CASE WHEN p_size < 20 THEN p_size END AS municipio_id", "p_size AS total_registros")
    cities = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS municipio_id", "n_name AS nombre", "n_regionkey AS departamento_id")
    schema.create_views({"dim_entidades": schema.fitted(entities, "dim_entidades"), "dim_municipios": schema.fitted(cities, "dim_municipios")})
    seen = [spark.table(f"vista_entidades_{name}").withColumn("vista", F.lit(label)) for name, label in (("judiciales", "judicial"), ("coactivas", "coactiva"))]
    return seen[0].unionByName(seen[1]).select("vista", "entidad_id", "nombre_extraido", "tipo", "ciudad", "total_registros")


@query("SELECT r_name, count(*) AS clientes, CAST(sum(CAST(c_acctbal AS DECIMAL(20, 2))) AS DECIMAL(30, 2)) AS saldo, 2 AS version FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1")
def q_transactional_load(spark, sf_dir):
    """Three tables loaded together twice, and a third load, whose customers name no nation, that leaves them as they were."""
    folder = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    given = {name: table(spark, sf_dir, name) for name in ("region", "nation", "customer")}
    rules = {"region": load.Rules(key=("r_regionkey",)), "nation": load.Rules(key=("n_nationkey",), refers=(("n_regionkey", "region", "r_regionkey"),)), "customer": load.Rules(key=("c_custkey",), refers=(("c_nationkey", "nation", "n_nationkey"),))}
    load.load(spark, folder, given | {"customer": given["customer"].limit(0)}, rules)
    version = load.load(spark, folder, {"customer": given["customer"]}, rules).version
    try:
        load.load(spark, folder, {"customer": given["customer"].withColumn("c_nationkey", F.col("c_nationkey") - 1000)}, rules)
    except load.LoadError:
        loaded = load.tables(spark, folder)
    nations = loaded["nation"].join(F.broadcast(loaded["region"]), F.col("n_regionkey") == F.col("r_regionkey"))
    star = loaded["customer"].join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    return star.groupBy("r_name").agg(F.count("*").alias("clientes"), F.sum(F.col("c_acctbal").cast("decimal(20,2)")).cast("decimal(30,2)").alias("saldo"), F.lit(version).alias("version"))
