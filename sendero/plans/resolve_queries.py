"""Queries of entity resolution and matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from sendero.functions import geo, text
from sendero.operators import match, resolve
from sendero.plans import duck
from sendero.plans.registry import query, table
from sendero.plans.sender import SENDERS, distinct_senders, senders
from sendero.plans.text_queries import classified
from sendero.sources.stage import broadcast_if_small, staged

PLACES = sorted({*geo.DEPARTMENTS, *[m for m, _ in geo.MUNICIPALITIES]})
_FOLD = str.maketrans(*text.KEEP_ENIE)
PLACE_NAMES = sorted({p.upper().translate(_FOLD) for p in PLACES})
KEY = ["tipo", "subtipo", "numero", "lugar"]

#: g: classified senders with place and block; cores; clusters; recovered groups.
_PLACED = f"""{duck.CLASSIFIED}, {duck.GEO}, g AS (SELECT c.*, l.municipio, l.departamento, CASE WHEN tipo = 'GOBERNACION' THEN coalesce(l.departamento, '__NO_DEPT__') ELSE coalesce(l.municipio, '__DEPT_' || l.departamento || '__', '__NO_LOC__') END AS lugar FROM c JOIN l ON l.raw = c.raw)"""


def _core_sql() -> str:
    listed = "|".join(p.replace(".", r"\.") for p in sorted(PLACE_NAMES, key=lambda p: (-len(p), p)))
    t = duck.sub("numbered", rf"\b(?:{listed})\b")
    for p in resolve.NOISE:
        t = duck.sub(t, p)
    return f"trim({duck.sub(duck.sub(t, '[^A-Z0-9Ñ]', ' '), r'\s+', ' ')})"


def _portion_sql(kind: str, x: str) -> str:
    cuts = {}
    for of, patterns in resolve.CITY_PREFIX.items():
        t = x
        for p in patterns:
            t = duck.sub(t, p.replace("Ò", ""))
        cuts[of] = t
    t = f"CASE {kind} WHEN 'GOBERNACION' THEN {cuts['GOBERNACION']} WHEN 'MUNICIPIO' THEN {cuts['MUNICIPIO']} ELSE {cuts['ALCALDIA']} END"
    for p in resolve.CITY_TAIL:
        t = duck.sub(t, p)
    return f"trim({t})"


_RANKED = f"""k AS (SELECT *, {_core_sql()} AS core FROM g WHERE contains(lugar, '__NO_')),
r AS (SELECT *, row_number() OVER (PARTITION BY tipo, subtipo, numero, lugar ORDER BY n DESC, seen) AS i FROM k),
near AS (SELECT r.tipo, r.subtipo, r.numero, r.lugar, r.i, list(a.i) AS near FROM r JOIN r a ON a.tipo = r.tipo AND a.subtipo = r.subtipo AND a.numero = r.numero AND a.lugar = r.lugar AND a.i < r.i
 WHERE CASE WHEN r.core = '' OR a.core = '' THEN {duck.ratio("a.clean", "r.clean")} ELSE {duck.ratio("a.core", "r.core")} END >= CASE r.tipo {" ".join(f"WHEN '{k}' THEN {v}" for k, v in resolve.THRESHOLDS.items())} ELSE {resolve.DEFAULT_THRESHOLD} END GROUP BY ALL),
rn AS (SELECT r.*, coalesce(near.near, []::BIGINT[]) AS near FROM r LEFT JOIN near USING (tipo, subtipo, numero, lugar, i)),
f(tipo, subtipo, numero, lugar, raw, i, anchors, cluster) AS (
 SELECT tipo, subtipo, numero, lugar, raw, i, [i], 0::BIGINT FROM rn WHERE i = 1
 UNION ALL SELECT rn.tipo, rn.subtipo, rn.numero, rn.lugar, rn.raw, rn.i,
  CASE WHEN len(list_filter(f.anchors, lambda x: list_contains(rn.near, x))) > 0 THEN f.anchors ELSE list_append(f.anchors, rn.i) END,
  CASE WHEN len(list_filter(f.anchors, lambda x: list_contains(rn.near, x))) > 0 THEN list_position(f.anchors, list_filter(f.anchors, lambda x: list_contains(rn.near, x))[1]) - 1 ELSE len(f.anchors) END
 FROM f JOIN rn ON rn.tipo = f.tipo AND rn.subtipo = f.subtipo AND rn.numero = f.numero AND rn.lugar = f.lugar AND rn.i = f.i + 1)"""
_RECOVERED = f"""gc2 AS (SELECT g.*, coalesce(f.cluster, 0) AS cluster FROM g LEFT JOIN f ON f.raw = g.raw),
pr AS (SELECT tipo, subtipo, numero, lugar, cluster, {_portion_sql("tipo", "clean")} AS part FROM (SELECT *, row_number() OVER (PARTITION BY tipo, subtipo, numero, lugar, cluster ORDER BY n DESC, seen) AS rn FROM gc2 WHERE contains(lugar, '__NO_') AND tipo IN ({", ".join(map(duck.q, resolve.RECOVERABLE))})) WHERE rn = 1),
pp AS (SELECT DISTINCT part FROM pr WHERE length(part) >= 3 AND part NOT IN ({", ".join(map(duck.q, resolve.GARBAGE))})),
nc AS (SELECT part, municipio, departamento FROM (SELECT part, municipio, departamento, row_number() OVER (PARTITION BY part ORDER BY {duck.ratio("part", "norm")} DESC, ord) AS rn FROM pp, db WHERE {duck.ratio("part", "norm")} >= 0.7) WHERE rn = 1),
nd AS (SELECT part, departamento FROM (SELECT part, departamento, row_number() OVER (PARTITION BY part ORDER BY {duck.ratio("part", "norm")} DESC, ord) AS rn FROM pp, (SELECT norm, departamento, ord FROM gdn UNION ALL SELECT norm, departamento, 1000 + ord FROM ga) x WHERE {duck.ratio("part", "norm")} >= 0.7) WHERE rn = 1),
fo AS (SELECT pr.*, CASE WHEN pr.tipo = 'GOBERNACION' THEN coalesce(nd.departamento, nc.departamento) ELSE nc.municipio END AS found FROM pr LEFT JOIN nc ON nc.part = pr.part LEFT JOIN nd ON nd.part = pr.part),
rec AS (SELECT gc2.*, CASE WHEN fo.found IS NOT NULL THEN fo.found WHEN contains(gc2.lugar, '__NO_') THEN gc2.lugar || '_C' || gc2.cluster ELSE gc2.lugar END AS lugar2 FROM gc2 LEFT JOIN fo USING (tipo, subtipo, numero, lugar, cluster))"""


def _entities_sql(source: str, place: str) -> str:
    return f"""z AS (SELECT *, {place} AS lug, max(n) OVER (PARTITION BY tipo, subtipo, numero, {place}) AS most FROM {source}),
zr AS (SELECT *, row_number() OVER (PARTITION BY tipo, subtipo, numero, lug ORDER BY n DESC, seen) AS rk, CASE WHEN ((raw <> upper(raw) AND raw <> lower(raw)) OR upper(raw) = lower(raw)) AND n >= greatest(most * 0.2, 2) THEN 1 ELSE 0 END AS fit FROM z),
zf AS (SELECT *, row_number() OVER (PARTITION BY tipo, subtipo, numero, lug ORDER BY fit DESC, n DESC, seen) AS fk FROM zr),
en AS (SELECT tipo, subtipo, numero, lug, trim(coalesce(max(CASE WHEN fk = 1 AND fit = 1 THEN raw END), max(CASE WHEN rk = 1 THEN raw END))) AS nombre, coalesce(max(CASE WHEN rk = 1 THEN municipio END), '') AS municipio, coalesce(max(CASE WHEN rk = 1 THEN departamento END), '') AS departamento, CAST(sum(n) AS BIGINT) AS total_registros, count(*) AS num_variantes, min(seen) AS seen FROM zf GROUP BY tipo, subtipo, numero, lug),
ent AS (SELECT row_number() OVER (ORDER BY total_registros DESC, seen) AS entidad_id, * FROM en)"""


def placed(spark, sf_dir):
    """located() without the default places, blocked."""
    return staged(resolve.blocks(geo.locate(classified(spark, sf_dir), geo.geography(spark))), "placed")


def clustered(spark, sf_dir):
    """placed() with clusters in the blocks that have no place; 0 elsewhere."""
    p = placed(spark, sf_dir)
    free = resolve.core_text(p.filter(F.contains("lugar", F.lit("__NO_"))), PLACE_NAMES)
    made = resolve.anchor_clusters(free, KEY, [F.desc("n"), F.col("seen")]).select("raw", "cluster")
    return staged(p.join(made, "raw", "left").withColumn("cluster", F.coalesce("cluster", F.lit(0))), "clustered")


def recovered(spark, sf_dir):
    g = geo.geography(spark)
    depts = g.departments.unionByName(g.dept_aliases.withColumn("ord", F.col("ord") + 1000))
    return staged(resolve.recover_places(clustered(spark, sf_dir), g.cities, depts).drop("lugar").withColumnRenamed("lugar2", "lugar"), "recovered")


@query(f"WITH {SENDERS} SELECT raw, n, seen FROM u")
def q_variant_counts(spark, sf_dir):
    return distinct_senders(spark, sf_dir)


@query(f"WITH {_PLACED} SELECT tipo, subtipo, numero, lugar, CAST(sum(n) AS BIGINT) AS total, count(*) AS variantes FROM g GROUP BY ALL")
def q_block_groups(spark, sf_dir):
    return placed(spark, sf_dir).groupBy(*KEY).agg(F.sum("n").alias("total"), F.count("*").alias("variantes"))


@query(f"WITH {duck.CLASSIFIED}, k AS (SELECT raw, {_core_sql()} AS core FROM c) SELECT raw, core FROM k")
def q_core_text(spark, sf_dir):
    return resolve.core_text(distinct_senders(spark, sf_dir), PLACE_NAMES).select("raw", "core")


@query(f"WITH p AS (SELECT DISTINCT p_name AS x FROM part) SELECT a.x AS a, b.x AS b, {duck.ratio('a.x', 'b.x')} AS ratio FROM p a JOIN p b ON a.x < b.x AND left(a.x, 1) = left(b.x, 1)")
def q_levenshtein_ratio(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_name").distinct()
    a, b = p.select(F.col("p_name").alias("a"), F.substring("p_name", 1, 1).alias("k")), p.select(F.col("p_name").alias("b"), F.substring("p_name", 1, 1).alias("k"))
    return a.join(b, "k").filter("a < b").select("a", "b", text.levenshtein_ratio(F.col("a"), F.col("b")).alias("ratio"))


@query(f"WITH {SENDERS}, {duck.GEO.split('dh AS')[0].rstrip().rstrip(',')}, p AS (SELECT DISTINCT {duck.norm_city('ciudad')} AS part FROM s), x AS (SELECT part, norm, municipio, {duck.ratio('part', 'norm')} AS ratio, ord FROM p, db WHERE length(part) >= 3) SELECT part, municipio, ratio FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY ratio DESC, ord) AS rn FROM x WHERE ratio >= 0.7) WHERE rn = 1")
def q_fuzzy_city(spark, sf_dir):
    parts = senders(spark, sf_dir).select("ciudad").distinct().select(text.norm_city(F.col("ciudad")).alias("part"))
    return resolve.nearest(parts, geo.geography(spark).cities).select("part", "municipio", "ratio")


@query(f"WITH RECURSIVE {_PLACED}, {_RANKED} SELECT tipo, subtipo, numero, lugar, raw, CAST(cluster AS INT) AS cluster FROM f")
def q_anchor_clusters(spark, sf_dir):
    return clustered(spark, sf_dir).filter(F.contains("lugar", F.lit("__NO_"))).select(*KEY, "raw", F.col("cluster").cast("int").alias("cluster"))


@query(f"WITH RECURSIVE {_PLACED}, {_RANKED}, {_RECOVERED} SELECT raw, tipo, subtipo, numero, lugar2 AS lugar FROM rec")
def q_fuzzy_recover_merge(spark, sf_dir):
    return recovered(spark, sf_dir).select("raw", *KEY)


@query(f"WITH {_PLACED}, {_entities_sql('g', 'lugar')} SELECT tipo, subtipo, numero, lug AS lugar, nombre, num_variantes FROM ent")
def q_canonical_name(spark, sf_dir):
    return resolve.entities(placed(spark, sf_dir), KEY).select(*KEY, "nombre", "num_variantes")


_FULL = f"WITH RECURSIVE {_PLACED}, {_RANKED}, {_RECOVERED}, {_entities_sql('rec', 'lugar2')}"


@query(f"{_FULL} SELECT entidad_id, tipo, subtipo, numero, lug AS lugar, nombre, municipio, departamento, total_registros, num_variantes FROM ent")
def q_entity_ids(spark, sf_dir):
    return resolve.entities(recovered(spark, sf_dir), KEY)


@query(f"{_FULL} SELECT rec.raw AS variante_original, ent.entidad_id, ent.nombre, rec.n AS conteo FROM rec JOIN ent ON ent.tipo = rec.tipo AND ent.subtipo = rec.subtipo AND ent.numero = rec.numero AND ent.lug = rec.lugar2")
def q_variant_map(spark, sf_dir):
    return _variant_map(recovered(spark, sf_dir))


def _variant_map(r):
    return r.join(resolve.entities(r, KEY).select("entidad_id", "nombre", *KEY), KEY).select(F.col("raw").alias("variante_original"), "entidad_id", "nombre", F.col("n").alias("conteo"))


@query(f"{_FULL}, v AS (SELECT rec.raw, ent.entidad_id, ent.nombre FROM rec JOIN ent ON ent.tipo = rec.tipo AND ent.subtipo = rec.subtipo AND ent.numero = rec.numero AND ent.lug = rec.lugar2) SELECT r_name, v.entidad_id, v.nombre, count(*) AS oficios, CAST(sum(CAST(o_totalprice AS DECIMAL(20, 2))) AS DECIMAL(30, 2)) AS monto FROM s JOIN v ON v.raw = s.raw JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL ORDER BY monto DESC, entidad_id, r_name LIMIT 20")
def q_top_entities(spark, sf_dir):
    """The flagship: senders cleaned, classified, located, clustered, named; the top of them by region and amount."""
    r = recovered(spark, sf_dir)
    variants = broadcast_if_small(_variant_map(r).select(F.col("variante_original").alias("raw"), "entidad_id", "nombre"), r.count())
    fact = senders(spark, sf_dir).join(variants, "raw")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    nation = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    star = fact.join(customer, "o_custkey").join(F.broadcast(nation), "n_nationkey")
    return star.groupBy("r_name", "entidad_id", "nombre").agg(F.count("*").alias("oficios"), F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("decimal(30,2)").alias("monto")).orderBy(F.desc("monto"), "entidad_id", "r_name").limit(20)


_PART = "SELECT DISTINCT p_name FROM part"
_NAMES_SQL = f"WITH d AS ({_PART}), ids AS (SELECT p_name, row_number() OVER (ORDER BY p_name) AS id FROM d), nm AS (SELECT id, upper(p_name) || CASE WHEN id % 2 = 0 THEN ' ' || (id % 5) ELSE '' END AS norm FROM ids WHERE id % 2 = 0 OR id % 3 = 0), rg AS (SELECT id AS rid, upper(p_name) || CASE WHEN id % 3 = 1 THEN ' ' || (id % 7) || ' X' ELSE '' END AS rnorm FROM ids), t AS (SELECT id, norm, list_distinct(string_split(norm, ' ')) AS a FROM nm), v AS (SELECT rid, rnorm, list_distinct(string_split(rnorm, ' ')) AS b FROM rg)"


def _names(spark, sf_dir):
    from sendero.plans.text_queries import ordinal

    ids = table(spark, sf_dir, "part").select("p_name").distinct().withColumn("id", ordinal(F.col("p_name")))
    names = ids.filter("id % 2 = 0 OR id % 3 = 0").select("id", F.expr("upper(p_name) || CASE WHEN id % 2 = 0 THEN ' ' || (id % 5) ELSE '' END").alias("norm"))
    registry = ids.select(F.col("id").alias("rid"), F.expr("upper(p_name) || CASE WHEN id % 3 = 1 THEN ' ' || (id % 7) || ' X' ELSE '' END").alias("rnorm"))
    return names, registry


_DIGITS = lambda x: f"regexp_extract_all({x}, '\\d+')"
_JACCARD = f"len(list_intersect(a, b))::DOUBLE / len(list_distinct(list_concat(a, b))) * CASE WHEN len({_DIGITS('norm')}) > 0 AND len({_DIGITS('rnorm')}) > 0 AND len(list_intersect({_DIGITS('norm')}, {_DIGITS('rnorm')})) = 0 THEN 0.5 ELSE 1 END"
_BEST = "SELECT id, rid, score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY same DESC, score DESC, rid) AS rn FROM m WHERE score >= {least}) WHERE rn = 1"


@query(f"{_NAMES_SQL}, m AS (SELECT id, rid, norm = rnorm AS same, CASE WHEN norm = rnorm THEN 1.0::DOUBLE ELSE {_JACCARD} END AS score FROM t, v) {_BEST.format(least=0.6)}")
def q_jaccard_match(spark, sf_dir):
    return match.best_matches(*_names(spark, sf_dir), match.jaccard, 0.6)


@query(f"{_NAMES_SQL}, m AS (SELECT id, rid, same, CASE WHEN same THEN 1.0::DOUBLE WHEN sc >= 0.7 THEN sc + CASE WHEN id % 4 = rid % 4 THEN 0.2::DOUBLE ELSE 0 END ELSE 0 END AS score FROM (SELECT id, rid, norm = rnorm AS same, len(list_intersect(a, b))::DOUBLE / greatest(len(a), len(b)) AS sc FROM t, v)) {_BEST.format(least=0.7)}")
def q_overlap_match(spark, sf_dir):
    bonus = F.when(F.col("id") % 4 == F.col("rid") % 4, 0.2).otherwise(0.0)
    return match.best_matches(*_names(spark, sf_dir), lambda a, b, x, y: match.overlap(a, b), 0.7, bonus)


_KEYED = duck.norm_keep("nombre")
@query(f"""{_FULL}, e AS (SELECT *, {_KEYED} AS norm, list_distinct(list_filter(string_split({_KEYED}, ' '), lambda w: length(w) > 1 AND NOT list_contains([{", ".join(map(duck.q, text.STOPWORDS))}], w))) AS words FROM ent WHERE tipo NOT IN ('OTRO', 'JUZGADO')),
p AS (SELECT *, row_number() OVER (PARTITION BY tipo ORDER BY total_registros DESC, entidad_id) AS rn FROM e)
SELECT c.entidad_id AS child_id, p.entidad_id AS parent_id FROM e c JOIN p ON p.tipo = c.tipo AND p.rn <= 500 AND p.total_registros > c.total_registros
WHERE len(c.words) >= 2 AND len(list_intersect(c.words, p.words)) > 0 AND len(list_intersect(c.words, p.words))::DOUBLE / greatest(len(c.words), len(p.words)) >= 0.5
 AND (c.municipio = '' OR p.municipio = '' OR c.municipio = p.municipio) AND (c.departamento = '' OR p.departamento = '' OR c.departamento = p.departamento)
 AND least(length(c.norm), length(p.norm))::DOUBLE / greatest(length(c.norm), length(p.norm)) >= CASE WHEN c.tipo IN ('ALCALDIA', 'MUNICIPIO', 'GOBERNACION') THEN 0.80 ELSE 0.82 END * 0.85""")
def q_residual_guards(spark, sf_dir):
    """Candidate pairs of residual duplicates, courts apart."""
    found = match.residual_candidates(q_entity_ids(spark, sf_dir).filter("tipo <> 'JUZGADO'"))
    return found.select(F.col("c_entidad_id").alias("child_id"), F.col("p_entidad_id").alias("parent_id"))


@query()
def q_residual_duplicates(spark, sf_dir):
    """Residual duplicates by sequence similarity, which SQL does not have; tests hold it against difflib."""
    return match.residual_duplicates(q_entity_ids(spark, sf_dir))


@query("SELECT a.event_id, CASE WHEN len(lw) > 0 THEN len(list_intersect(ew, lw))::DOUBLE / len(lw) END AS share FROM (SELECT event_id, list_distinct(list_filter(string_split(upper(event_type) || ' ' || CASE WHEN event_id % 3 = 0 THEN 'ALCALDIA' ELSE 'JUZGADO CIVIL' END, ' '), lambda w: length(w) > 3)) AS ew, list_distinct(list_filter(string_split(upper(event_type) || CASE WHEN event_id % 2 = 0 THEN ' CIVIL MUNICIPAL' ELSE '' END, ' '), lambda w: length(w) > 3)) AS lw FROM events) a")
def q_name_overlap(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    x = F.expr("upper(event_type) || ' ' || CASE WHEN event_id % 3 = 0 THEN 'ALCALDIA' ELSE 'JUZGADO CIVIL' END")
    y = F.expr("upper(event_type) || CASE WHEN event_id % 2 = 0 THEN ' CIVIL MUNICIPAL' ELSE '' END")
    return e.select("event_id", match.name_overlap(x, y).alias("share"))


