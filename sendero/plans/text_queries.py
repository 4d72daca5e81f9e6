"""Queries of the text, classification and geography layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from sendero.functions import classify, geo, text
from sendero.plans import duck
from sendero.plans.registry import query, table
from sendero.plans.sender import SENDERS, distinct_senders, senders
from sendero.sources.stage import staged


def classified(spark, sf_dir):
    """Distinct senders with clean, tipo, subtipo, numero; staged, as one row a spelling is all that the rest reads."""
    return staged(classify.classified(distinct_senders(spark, sf_dir)), "classified")


def located(spark, sf_dir):
    """classified() with municipio and departamento, defaults of types that name no place included."""
    return classify.with_default_places(geo.locate(classified(spark, sf_dir), geo.geography(spark)))


def _each(name, column, sql):
    """A query of one text function over the distinct senders."""

    def run(spark, sf_dir):
        return distinct_senders(spark, sf_dir).select("raw", column(F.col("raw")).alias("out"))

    run.__name__ = name
    query(f"WITH {SENDERS} SELECT raw, {sql('raw')} AS out FROM u")(run)


def _upper_words(x, stop):
    return f"list_filter(string_split({x}, ' '), lambda w: length(w) > 1 AND NOT list_contains([{', '.join(duck.q(s) for s in stop)}], w))"


_COURT = duck.sub(duck.norm_keep("raw"), r"^JUZGADO\s+")
_PHRASES = " ".join(f"WHEN contains({_COURT}, {duck.q(p)}) THEN {n}" for p, n in text.court_phrases())
_WORDS = "MAP {" + ", ".join(f"{duck.q(w)}: {n}" for w, n in text.COURT_WORDS.items()) + "}"
_ORDINAL_STOP = [*sorted({w for p, _ in text.court_phrases() for w in p.split()} | set(text.COURT_WORDS)), *text.KEY_STOPWORDS]
_each("q_clean_text", text.clean_text, duck.clean_text)
_each("q_norm_keep_enie", text.norm_keep, duck.norm_keep)
_each("q_norm_fold_all", text.norm_fold, duck.norm_fold)
_each("q_norm_registry", text.norm_registry, duck.norm_registry)
_each("q_norm_suggest", text.norm_suggest, duck.norm_keep)
_each("q_norm_city", text.norm_city, duck.norm_city)
_each("q_norm_audit", text.norm_audit, duck.norm_audit)
_each("q_replace_ordinals", lambda c: text.replace_ordinals(text.clean_text(c)), lambda x: duck.replace_ordinals(duck.clean_text(x)))
_each("q_extract_number", text.extract_number, lambda x: duck.extract(duck.replace_ordinals(duck.clean_text(x)), r"\b(\d+)\b"))
_each("q_office_number", text.office_number, lambda x: duck.extract(x, r"\b(\d{1,3})\b"))
_each("q_keyword_tokens", lambda c: F.array_join(text.key_words(c), " "), lambda x: f"array_to_string({_upper_words(duck.norm_keep(x), text.STOPWORDS)}, ' ')")
_each("q_subtype_key", text.court_subtype_key, lambda x: f"array_to_string({_upper_words(duck.squeeze(duck.sub(duck.sub(duck.sub(duck.norm_keep(x), r'^JUZGADO\s+'), text.CITY_TAIL), text.PLACE_WORDS)), _ORDINAL_STOP)}, ' ')")
_each("q_court_ordinal", text.court_ordinal, lambda x: f"CASE {_PHRASES} ELSE coalesce(list_filter(list_transform(string_split({_COURT}, ' ')[1:3], lambda w: {_WORDS}[w]), lambda n: n IS NOT NULL)[1], TRY_CAST({duck.extract(_COURT, r'\b(\d{1,3})\b')} AS INT)) END")
_each("q_mixed_case", text.mixed_case, lambda x: f"({x} <> upper({x}) AND {x} <> lower({x})) OR upper({x}) = lower({x})")
_each("q_numbers", lambda c: F.array_join(text.numbers(c), ","), lambda x: f"array_to_string(list_distinct(regexp_extract_all({x}, '\\d+')), ',')")
_each("q_slice_pad", lambda c: F.concat(F.substring(c, 1, 20), F.lit("|"), F.lpad(F.length(c).cast("string"), 5, "0")), lambda x: f"substring({x}, 1, 20) || '|' || lpad(CAST(length({x}) AS VARCHAR), 5, '0')")


_SUPPLIER = "s_name || CASE s_suppkey % 4 WHEN 0 THEN ' NIT: 900.' || s_suppkey || '-' || (s_suppkey % 10) WHEN 1 THEN ' nit 8001' || s_suppkey WHEN 2 THEN ' NIT' ELSE '' END"


@query(f"SELECT s_suppkey, translate(regexp_extract({_SUPPLIER}, '(?i)NIT\\s*[:\\-]?\\s*(\\d[\\d.\\-]+)', 1), '.-', '') AS nit FROM supplier")
def q_nit_extract(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.tax_id(F.expr(_SUPPLIER)).alias("nit"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE lower(s_name) || '@courts.example.org' END AS email FROM supplier")
def q_email_synth(spark, sf_dir):
    code = F.when(F.col("s_suppkey") % 3 == 0, " ").otherwise(F.col("s_name"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.court_mail(code, "courts.example.org").alias("email"))


_MAIL = "CASE c_custkey % 5 WHEN 0 THEN ' No Encontrada ' WHEN 1 THEN '' WHEN 2 THEN 'noencontrada' ELSE ' ' || lower(c_name) || '@x.org ' END"


@query(f"SELECT c_custkey, CASE WHEN lower(trim({_MAIL})) IN ('noencontrada', 'no encontrada', 'no encontrado', '') THEN '' ELSE trim({_MAIL}) END AS mail, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE upper(c_mktsegment) END AS segmento FROM customer")
def q_sentinel_null(spark, sf_dir):
    segment = F.when(F.col("c_custkey") % 3 == 0, "none").otherwise(F.upper("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.blank_if(F.expr(_MAIL), text.NO_MAIL).alias("mail"), text.blank_if(segment, text.NO_FIELD, F.upper).alias("segmento"))


_ADDRESS = "CASE event_id % 5 WHEN 0 THEN '{\"direccionGenerada\": \"Calle ' || user_id || '\"}' WHEN 1 THEN '{\"complemento\": \"vacia\"}' WHEN 2 THEN '{\"direccionGenerada\": \"Carrera ' || user_id || '\", broken' WHEN 3 THEN ' av. ' || user_id || ' ' ELSE props END"
_DUCK_ADDRESS = f"WITH a AS (SELECT event_id, user_id, trim({_ADDRESS}) AS r FROM events)"


@query(f"{_DUCK_ADDRESS} SELECT event_id, CASE event_id % 5 WHEN 0 THEN upper(json_extract_string(r, '$.direccionGenerada')) WHEN 1 THEN '' WHEN 2 THEN 'CARRERA ' || user_id WHEN 3 THEN upper(r) ELSE '' END AS direccion FROM a")
def q_json_field_fallback(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(text.address(F.expr(_ADDRESS)), F.lit("")).alias("direccion"))


@query("SELECT event_id, coalesce(CAST(TRY_CAST(trim(v) AS BIGINT) AS VARCHAR), '') AS banco, TRY_CAST(nullif(a, '') AS DECIMAL(20, 2)) AS monto, TRY_CAST(nullif(a, '') AS DOUBLE) AS flotante FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN ' 00' || user_id WHEN 1 THEN 'x' ELSE CAST(user_id AS VARCHAR) END AS v, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN '28594000900609481.25' ELSE CAST(user_id AS VARCHAR) || '.50' END AS a FROM events)")
def q_safe_amount(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    v = F.expr("CASE event_id % 4 WHEN 0 THEN ' 00' || user_id WHEN 1 THEN 'x' ELSE CAST(user_id AS STRING) END")
    a = F.expr("CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN '28594000900609481.25' ELSE CAST(user_id AS STRING) || '.50' END")
    return e.select("event_id", text.whole_number(v).alias("banco"), text.amount(a).alias("monto"), F.nullif(text.strip(a), F.lit("")).try_cast("double").alias("flotante"))


@query(f"WITH {duck.CLASSIFIED} SELECT raw, n, tipo, subtipo, numero FROM c")
def q_detect_type(spark, sf_dir):
    return classified(spark, sf_dir).select("raw", "n", "tipo", "subtipo", "numero")


_NAMES = "SELECT unnest(['JUZGADO DE PEQUENAS CAUSAS Y COMPETENCIA MULTIPLE', 'DATT CARTAGENA', 'SENA REGIONAL', 'SENAMIHI SENA', 'COLPENSIONES', 'EMCALI', 'CAS DE SANTANDER', 'CONSEJO SECCIONAL DE LA JUDICATURA', 'JUEZ LABORAL DE PEQUENAS CAUSAS', 'CENTRO DE SERVICIOS JUDICIALES', 'GBERANCION DEL CESAR', 'SUPERINTENDENCIA DE INDUSTRIA', 'SUPERINTENDENCIA X', 'SECRETARIA DE TRANSITO', 'MINHACIENDA', 'MINISTERIO DE MINAS Y ENERGIA DE LA REPUBLICA', 'U.G.P.P', 'DIRECCION EJECUTIVA', 'IDU', 'INSTITUTO DE MOVILIDAD', 'DIRECCION DE TRANSITO', 'AGUAS E.S.P.', 'POLICIA', 'CORTE SUPREMA', 'CORTE CONSTITUCIONAL', 'CONTRALORIA', 'PERSONERIA', 'TRIBUNAL ADMINISTRATIVO', 'NADA', '']) AS clean"


_LISTED = _NAMES[_NAMES.index("[") + 1 : _NAMES.rindex("]")]
_COUNT = len(_LISTED.split("', '"))


@query(f"WITH t AS (SELECT list_extract([{_LISTED}], CAST(o_orderkey % {_COUNT} AS INT) + 1) AS clean FROM orders) SELECT clean, {duck.entity_type('clean')} AS tipo, {duck.subtype(f'({duck.entity_type("clean")})', 'clean')} AS subtipo, count(*) AS n FROM t GROUP BY ALL")
def q_subtype_misc(spark, sf_dir):
    """Every branch of the ladder, on names given to all orders."""
    named = table(spark, sf_dir, "orders").select(F.expr(f"element_at(array({_LISTED}), CAST(o_orderkey % {_COUNT} AS INT) + 1)").alias("clean"))
    out = named.groupBy("clean").agg(F.count("*").alias("n")).withColumn("tipo", classify.entity_type(F.col("clean")))
    return out.withColumn("subtipo", classify.subtype(F.col("tipo"), F.col("clean")))


@query(f"WITH {duck.CLASSIFIED}, {duck.GEO} SELECT raw, departamento FROM dept")
def q_extract_department(spark, sf_dir):
    c = classified(spark, sf_dir)
    return c.join(geo.department_of(c, "clean", geo.geography(spark)), "clean").select("raw", "departamento")


@query(f"WITH {duck.CLASSIFIED}, {duck.GEO} SELECT raw, m AS municipio, d AS departamento FROM city WHERE raw IN (SELECT raw FROM c WHERE tipo <> 'GOBERNACION')")
def q_extract_municipality(spark, sf_dir):
    g = geo.geography(spark)
    c = classified(spark, sf_dir).filter("tipo <> 'GOBERNACION'")
    hinted = c.join(geo.department_of(c, "clean", g).withColumnRenamed("departamento", "hint"), "clean", "left")
    found = geo.municipality_of(hinted.select("clean", "hint"), "clean", g).select("clean", "municipio", "departamento")
    return c.join(found, "clean").select("raw", "municipio", "departamento")


@query(f"WITH {duck.CLASSIFIED}, {duck.GEO} SELECT raw, municipio, departamento FROM l")
def q_location_two_pass(spark, sf_dir):
    return geo.locate(classified(spark, sf_dir), geo.geography(spark)).select("raw", "municipio", "departamento")


_N = duck.norm_fold("ciudad")
_SHORT = f"trim({duck.sub(f'trim({duck.sub("n", r"\bD\s*\.?\s*C\s*\.?\s*$")})', r"\bD\s*\.?\s*T\s*\.?\s*(Y\s*C\s*\.?)?\s*$")})"
CITY_SQL = f"""{SENDERS}, {duck.GEO.split("dh AS")[0].rstrip().rstrip(",")},
ck AS (SELECT key, municipio, departamento FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY rank, place) AS rn FROM (SELECT {duck.norm_fold("municipio")} AS key, municipio, departamento, ord AS place, 1 AS rank FROM gmn UNION ALL SELECT {duck.norm_fold("norm")}, municipio, departamento, 0, 0 FROM db WHERE ord >= 10000)) WHERE rn = 1),
cs AS (SELECT DISTINCT ciudad, {_N} AS n FROM s),
ct AS (
 SELECT ciudad, 0 AS rank, n AS key FROM cs UNION ALL SELECT ciudad, 1, {_SHORT} FROM cs
 UNION ALL SELECT ciudad, 1000 - i, array_to_string(w[1:i], ' ') FROM (SELECT ciudad, string_split(n, ' ') AS w, unnest(range(1, greatest(len(string_split(n, ' ')) - 1, 1) + 1)) AS i FROM cs) WHERE EXISTS (SELECT 1 FROM gd WHERE contains({duck.norm_fold("gd.departamento")}, array_to_string(w[i + 1:], ' ')))
 UNION ALL SELECT ciudad, 2000 + k, array_to_string(w[1:k], ' ') FROM (SELECT ciudad, string_split(n, ' ') AS w, unnest([1, 2, 3]) AS k FROM cs) WHERE len(w) >= greatest(2, k) AND (k > 1 OR length(w[1]) >= 4)),
cr AS (SELECT ciudad, municipio, departamento FROM (SELECT ct.ciudad, ck.municipio, ck.departamento, row_number() OVER (PARTITION BY ct.ciudad ORDER BY rank) AS rn FROM ct JOIN ck ON ct.key = ck.key JOIN cs ON cs.ciudad = ct.ciudad AND cs.n <> '') WHERE rn = 1)"""


@query(f"WITH {CITY_SQL} SELECT * FROM cr")
def q_city_cascade(spark, sf_dir):
    return geo.resolve_cities(senders(spark, sf_dir), geo.geography(spark))


@query(f"""WITH {duck.CLASSIFIED}, {duck.GEO}, {CITY_SQL[CITY_SQL.index("ck AS"):]}
SELECT s.o_orderkey, CASE WHEN coalesce(l.municipio, '') <> '' THEN l.municipio WHEN cr.municipio IS NOT NULL THEN cr.municipio WHEN trim(s.ciudad) <> '' THEN trim(s.ciudad) END AS municipio,
 CASE WHEN coalesce(l.municipio, '') <> '' THEN l.departamento WHEN cr.municipio IS NOT NULL THEN cr.departamento ELSE l.departamento END AS departamento,
 CASE WHEN coalesce(l.municipio, '') <> '' THEN 'entidad' WHEN cr.municipio IS NOT NULL THEN 'ciudad_original' WHEN trim(s.ciudad) <> '' THEN 'ciudad_sin_resolver' ELSE 'sin_dato' END AS fuente
FROM s JOIN l ON s.raw = l.raw LEFT JOIN cr ON cr.ciudad = s.ciudad""")
def q_location_provenance(spark, sf_dir):
    g = geo.geography(spark)
    fact = senders(spark, sf_dir)
    entity = geo.locate(classified(spark, sf_dir), g).select("raw", F.col("municipio").alias("em"), F.col("departamento").alias("ed"))
    cities = geo.resolve_cities(fact, g).withColumnsRenamed({"municipio": "cm", "departamento": "cd"})
    m, d, source = geo.provenance(F.col("em"), F.col("ed"), F.col("cm"), F.col("cd"), F.col("ciudad"))
    return fact.join(entity, "raw").join(cities, "ciudad", "left").select("o_orderkey", m.alias("municipio"), d.alias("departamento"), source.alias("fuente"))


_KEY = duck.norm_keep("ciudad")
def _municipality_key_sql() -> str:
    t = "k0"
    for part, to in geo.REWRITES:
        t = f"CASE WHEN contains({t}, '{part}') THEN '{to}' ELSE {t} END"
    return t


_DIMS = f"""dd AS (SELECT {duck.norm_keep("departamento")} AS norm, row_number() OVER (ORDER BY departamento) AS departamento_id FROM gd),
dm AS (SELECT x.norm, departamento_id, row_number() OVER (ORDER BY ord) AS municipio_id FROM (SELECT {duck.norm_keep("municipio")} AS norm, {duck.norm_keep("departamento")} AS dn, ord FROM gm) x JOIN dd ON dd.norm = dn)"""


def _id_rows(spark, sf_dir):
    g = geo.geography(spark)
    depts = g.departments.select(text.norm_keep(F.col("departamento")).alias("norm"), "departamento")
    dim_d = dim_by_name(depts)
    munis = g.homonyms.select(text.norm_keep(F.col("municipio")).alias("norm"), text.norm_keep(F.col("departamento")).alias("dn"), "ord").join(dim_d.select(F.col("norm").alias("dn"), "departamento_id"), "dn")
    return dim_d, munis.withColumn("municipio_id", ordinal(F.col("ord"))).select("norm", "departamento_id", "municipio_id")


def ordinal(*order):
    """1, 2, ... in the order given; for dimension tables, whose size does not grow with the facts."""
    from pyspark.sql import Window as W

    return F.row_number().over(W.orderBy(*order)).cast("bigint")


def dim_by_name(depts):
    return depts.withColumn("departamento_id", ordinal(F.col("departamento"))).select("norm", "departamento_id")


@query(f"""WITH {SENDERS}, {duck.GEO.split("dh AS")[0].rstrip().rstrip(",")}, {_DIMS},
a AS (SELECT DISTINCT ciudad, {_KEY} AS k0, CASE WHEN o_orderkey % 2 = 0 THEN 'ANTIOQUIA' ELSE 'VALLE' END AS dept_key FROM s),
b AS (SELECT ciudad, dept_key, {_municipality_key_sql()} AS k1 FROM a),
k AS (SELECT ciudad, dept_key, CASE WHEN k1 IN ({", ".join(map(duck.q, geo.NO_PLACE))}) OR k1 = '' THEN NULL ELSE CASE WHEN contains(k1, 'SOCORRO') THEN 'EL SOCORRO' ELSE k1 END END AS k2 FROM b),
r AS (SELECT ciudad, dept_key, CASE WHEN k2 NOT IN ({", ".join(map(duck.q, geo.DEPT_ONLY))}) THEN k2 END AS key FROM k)
SELECT ciudad, dept_key, coalesce(m1.municipio_id, m2.municipio_id) AS municipio_id, coalesce(d1.departamento_id, (SELECT min(departamento_id) FROM dd WHERE contains(dd.norm, r.dept_key) OR contains(r.dept_key, dd.norm))) AS departamento_id
FROM r LEFT JOIN dd d1 ON d1.norm = r.dept_key LEFT JOIN dm m1 ON m1.norm = r.key AND m1.departamento_id = d1.departamento_id
LEFT JOIN (SELECT norm, min(municipio_id) AS municipio_id FROM dm GROUP BY norm HAVING count(*) = 1) m2 ON m2.norm = r.key""")
def q_resolve_municipio_fk(spark, sf_dir):
    dim_d, dim_m = _id_rows(spark, sf_dir)
    rows = senders(spark, sf_dir).select("ciudad", F.when(F.col("o_orderkey") % 2 == 0, "ANTIOQUIA").otherwise("VALLE").alias("dept_key")).distinct()
    keyed = rows.withColumn("key", geo.municipality_key(text.norm_keep(F.col("ciudad"))))
    return geo.resolve_ids(keyed, dim_m, dim_d).select("ciudad", "dept_key", "municipio_id", "departamento_id")


@query(f"WITH {duck.GEO.split('dh AS')[0].rstrip().rstrip(',')} SELECT row_number() OVER (ORDER BY nombre) AS departamento_id, nombre FROM (SELECT departamento AS nombre FROM gd UNION ALL SELECT 'Bogotá, D.C.')")
def q_dim_departments(spark, sf_dir):
    names = geo.geography(spark).departments.select(F.col("departamento").alias("nombre")).unionByName(spark.createDataFrame([("Bogotá, D.C.",)], "nombre string"))
    return names.select(ordinal(F.col("nombre")).alias("departamento_id"), "nombre")


@query(f"WITH {duck.GEO.split('dh AS')[0].rstrip().rstrip(',')}, o AS (SELECT municipio, departamento, ord, {duck.norm_keep('municipio')} AS norm FROM gm), f AS (SELECT *, row_number() OVER (PARTITION BY norm, departamento ORDER BY ord) AS rn FROM o), d AS (SELECT row_number() OVER (ORDER BY departamento) AS departamento_id, departamento FROM gd) SELECT row_number() OVER (ORDER BY ord) AS municipio_id, municipio AS nombre, departamento_id FROM f JOIN d USING (departamento) WHERE rn = 1")
def q_dim_municipalities(spark, sf_dir):
    """Municipalities in listed order, repeated ones once."""
    g = geo.geography(spark)
    depts = g.departments.select("departamento", ordinal(F.col("departamento")).alias("departamento_id"))
    once = g.homonyms.groupBy(text.norm_keep(F.col("municipio")).alias("norm"), "departamento").agg(F.min_by("municipio", "ord").alias("nombre"), F.min("ord").alias("ord"))
    return once.join(F.broadcast(depts), "departamento").select(ordinal(F.col("ord")).alias("municipio_id"), "nombre", "departamento_id")
