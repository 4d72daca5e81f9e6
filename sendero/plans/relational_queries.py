"""Queries of the relational, quality and report layers on the star tables and on events."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sendero.functions import text
from sendero.operators import model, quality
from sendero.plans import duck
from sendero.plans.registry import query, table
from sendero.plans.sender import SENDERS, senders
from sendero.plans.text_queries import classified
from sendero.sources.stage import broadcast_if_small

MONEY = "decimal(20,2)"
STATUS = {"P": 1, "F": 2, "O": 3}


def money(c):
    return F.col(c).cast(MONEY)


def total(c):
    return F.sum(money(c)).cast("decimal(30,2)")


def _m(c):
    return f"CAST({c} AS DECIMAL(20, 2))"


def _t(c):
    return f"CAST(sum({_m(c)}) AS DECIMAL(30, 2))"


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS oficio_id, o_orderstatus AS estado, CAST(o_orderdate AS DATE) AS fecha, {_m('o_totalprice')} AS monto, '' AS referencia FROM orders")
def q_scan_project_cast(spark, sf_dir):
    o = table(spark, sf_dir, "orders").drop("o_orderpriority").withColumnsRenamed({"o_orderkey": "oficio_id", "o_orderstatus": "estado"})
    return o.select(F.col("oficio_id").cast("string").alias("oficio_id"), "estado", F.col("o_orderdate").cast("date").alias("fecha"), money("o_totalprice").alias("monto"), F.lit("").alias("referencia"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE coalesce(CASE o_orderstatus WHEN 'P' THEN 'SIN_CONFIRMAR' ELSE o_orderstatus END, '') <> 'SIN_CONFIRMAR'")
def q_status_filter(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "P", "SIN_CONFIRMAR").otherwise(F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").filter(model.known_status(status)).select("o_orderkey", "o_orderstatus")


_BLANKS = "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'm' || c_nationkey END AS muni, CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE 'd' || c_nationkey END AS dept FROM customer"


@query(f"WITH b AS ({_BLANKS}) SELECT count(*) AS n, count_if(trim(muni) <> '') AS con_muni, count_if(trim(dept) <> '') AS con_dept, count_if(trim(muni) <> '' AND trim(dept) <> '') AS ambos, count_if(trim(muni) = '' AND trim(dept) <> '') AS solo_dept, count_if(trim(muni) <> '' AND trim(dept) = '') AS solo_muni FROM b")
def q_blank_coverage_flags(spark, sf_dir):
    b = table(spark, sf_dir, "customer").select(F.expr("CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'm' || c_nationkey END").alias("muni"), F.expr("CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE 'd' || c_nationkey END").alias("dept"))
    m, d = F.trim("muni") != "", F.trim("dept") != ""
    return b.agg(F.count("*").alias("n"), F.count_if(m).alias("con_muni"), F.count_if(d).alias("con_dept"), F.count_if(m & d).alias("ambos"), F.count_if(~m & d).alias("solo_dept"), F.count_if(m & ~d).alias("solo_muni"))


@query("SELECT p_partkey, p_name FROM part WHERE (lower(p_name) LIKE '%an%' AND p_brand <> 'Brand#11') OR contains(lower(p_type), 'brass')")
def q_like_variant_search(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.filter((F.lower("p_name").like("%an%") & (F.col("p_brand") != "Brand#11")) | F.lower("p_type").contains("brass")).select("p_partkey", "p_name")


_LINE = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query(f"SELECT o_orderkey, l_partkey, l_suppkey, {_m('l_extendedprice')} AS monto FROM orders LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE}) AS rn FROM lineitem) ON l_orderkey = o_orderkey AND rn = 1")
def q_first_child(spark, sf_dir):
    first = model.first_child(table(spark, sf_dir, "orders").select("o_orderkey"), table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", [F.col(c) for c in _LINE.split(", ")])
    return first.select("o_orderkey", "l_partkey", "l_suppkey", money("l_extendedprice").alias("monto"))


@query(f"WITH f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE}) AS rn FROM lineitem) SELECT {_t('l_extendedprice')} AS todo, CAST(sum(CASE WHEN rn = 1 THEN {_m('l_extendedprice')} END) AS DECIMAL(30, 2)) AS primero, count(*) AS filas, count_if(rn = 1) AS padres FROM f")
def q_child_amount_loss(spark, sf_dir):
    f = table(spark, sf_dir, "lineitem").withColumn("rn", F.row_number().over(W.partitionBy("l_orderkey").orderBy(*_LINE.split(", "))))
    return f.agg(total("l_extendedprice").alias("todo"), F.sum(F.when(F.col("rn") == 1, money("l_extendedprice"))).cast("decimal(30,2)").alias("primero"), F.count("*").alias("filas"), F.count_if(F.col("rn") == 1).alias("padres"))


_NUM = "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'N' || (o_orderkey % 500) END"
_WHO = "CASE WHEN o_custkey % 2 = 0 THEN ' ana ' ELSE 'ANA' END"
_DEDUP = f"WITH d AS (SELECT o_orderkey, o_orderstatus, {_NUM} AS numero, o_custkey % 9 AS banco, {_WHO} AS nombre FROM orders)"
_KEEP = "numero IS NULL OR row_number() OVER (PARTITION BY numero, banco, upper(trim(nombre)) ORDER BY CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'F' THEN 2 WHEN 'O' THEN 3 ELSE 99 END, CAST(o_orderkey AS VARCHAR) DESC) = 1"


def _deduped(spark, sf_dir):
    d = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.expr(_NUM).alias("numero"), (F.col("o_custkey") % 9).alias("banco"), F.expr(_WHO).alias("nombre"))
    return model.dedup_by_priority(d, "numero", [F.col("numero"), F.col("banco"), F.upper(F.trim("nombre"))], F.col("o_orderstatus"), "o_orderkey", STATUS)


@query(f"{_DEDUP} SELECT o_orderkey, {_KEEP} AS keep FROM d")
def q_dedup_priority(spark, sf_dir):
    return _deduped(spark, sf_dir).select("o_orderkey", "keep")


@query(f"{_DEDUP}, k AS (SELECT *, {_KEEP} AS keep FROM d) SELECT count(*) AS repetidas FROM (SELECT numero, banco, nombre FROM k WHERE keep AND numero IS NOT NULL GROUP BY ALL HAVING count(*) > 1)")
def q_dedup_check(spark, sf_dir):
    """Repeated keys after dedup, on the columns as spelled."""
    return _deduped(spark, sf_dir).filter("keep AND numero IS NOT NULL").groupBy("numero", "banco", "nombre").count().filter("count > 1").agg(F.count("*").alias("repetidas"))


@query("SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey")
def q_star_left_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    return o.join(c, "c_custkey", "left").join(F.broadcast(n), "n_nationkey", "left").join(F.broadcast(table(spark, sf_dir, "region")), "r_regionkey", "left").select("o_orderkey", "c_name", "n_name", "r_name")


def _view(judicial):
    sql = f"WITH {duck.CLASSIFIED} SELECT s.o_orderkey, c.tipo, {_m('s.o_totalprice')} AS monto FROM s JOIN c ON c.raw = s.raw WHERE c.tipo {'' if judicial else 'NOT '}IN ('JUZGADO', 'TRIBUNAL', 'CORTE', 'RAMA_JUDICIAL', 'CENTRO_SERVICIOS', 'OFICINA_APOYO', 'FISCALIA', 'DIRECCION_EJECUTIVA')"

    def run(spark, sf_dir):
        c = classified(spark, sf_dir).select("raw", "tipo")
        own = model.judicial(F.col("tipo"))
        return senders(spark, sf_dir).join(c.filter(own if judicial else ~own), "raw").select("o_orderkey", "tipo", money("o_totalprice").alias("monto"))

    run.__name__ = "q_view_judicial" if judicial else "q_view_coercive"
    query(sql)(run)


_view(True)
_view(False)


@query("SELECT 'C' || c_custkey AS id, c_name AS nombre, 'CLIENTE' AS categoria, coalesce(nullif(CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END, ''), n_name) AS ciudad FROM customer JOIN nation ON n_nationkey = c_nationkey UNION ALL SELECT 'P' || s_suppkey, s_name, 'PROVEEDOR', n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def q_split_unify(spark, sf_dir):
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey").join(n, "n_nationkey")
    s = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey").join(n, "n_nationkey")
    city = F.coalesce(F.nullif(F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.col("c_mktsegment")), F.lit("")), "n_name")
    a = c.select(F.concat(F.lit("C"), "c_custkey").alias("id"), F.col("c_name").alias("nombre"), F.lit("CLIENTE").alias("categoria"), city.alias("ciudad"))
    return a.unionByName(s.select(F.concat(F.lit("P"), "s_suppkey").alias("id"), F.col("s_name").alias("nombre"), F.lit("PROVEEDOR").alias("categoria"), F.col("n_name").alias("ciudad")))


@query("SELECT user_id, event_type AS correo, n FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, min(event_id)) AS rn FROM events GROUP BY user_id, event_type) WHERE rn = 1")
def q_mode_per_entity(spark, sf_dir):
    c = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))
    return c.groupBy("user_id").agg(F.max_by("event_type", F.struct("n", (-F.col("first")).alias("f"))).alias("correo"), F.max("n").alias("n"))


_RELATIONS = [("orders_customer", "orders", "o_custkey", "customer", "c_custkey"), ("customer_nation", "customer", "c_nationkey", "nation", "n_nationkey"), ("supplier_nation", "supplier", "s_nationkey", "nation", "n_nationkey"), ("nation_region", "nation", "n_regionkey", "region", "r_regionkey"), ("lineitem_orders", "lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem_part", "lineitem", "l_partkey", "part", "p_partkey"), ("lineitem_supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"), ("events_customer", "events", "user_id", "customer", "c_custkey")]


@query(" UNION ALL ".join(f"SELECT '{n}' AS relacion, count(*) AS huerfanos FROM {c} LEFT JOIN {p} ON {fk} = {k} WHERE {k} IS NULL AND {fk} IS NOT NULL" for n, c, fk, p, k in _RELATIONS))
def q_fk_orphans(spark, sf_dir):
    read = {t: table(spark, sf_dir, t) for r in _RELATIONS for t in (r[1], r[3])}
    return quality.orphans([(n, read[c], fk, read[p], k) for n, c, fk, p, k in _RELATIONS])


@query("SELECT count(*) AS fuera FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def q_semi_membership(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey").join(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").agg(F.count("*").alias("fuera"))


@query("WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer), b AS (SELECT DISTINCT user_id AS k FROM events) SELECT count_if(b.k IS NULL) AS solo_a, count_if(a.k IS NULL) AS solo_b, count_if(a.k IS NOT NULL AND b.k IS NOT NULL) AS ambos FROM a FULL OUTER JOIN b ON a.k = b.k")
def q_id_reconcile(spark, sf_dir):
    return quality.reconcile(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "events").select(F.col("user_id").alias("k")), "k")


@query("WITH a AS (SELECT list_sort(list_distinct(list(c_nationkey))) AS x FROM customer), b AS (SELECT list_sort(list_distinct(list(s_nationkey))) AS y FROM supplier) SELECT len(list_intersect(x, y)) AS comunes, len(x) AS clientes, len(y) AS proveedores, array_to_string(list_sort(list_filter(x, lambda v: NOT list_contains(y, v))), ',') AS sobrantes FROM a, b")
def q_set_ops(spark, sf_dir):
    a = table(spark, sf_dir, "customer").agg(F.collect_set("c_nationkey").alias("x"))
    b = table(spark, sf_dir, "supplier").agg(F.collect_set("s_nationkey").alias("y"))
    both = a.withColumn("k", F.lit(1)).join(b.withColumn("k", F.lit(1)), "k")
    return both.select(F.size(F.array_intersect("x", "y")).cast("bigint").alias("comunes"), F.size("x").cast("bigint").alias("clientes"), F.size("y").cast("bigint").alias("proveedores"), F.array_join(F.array_sort(F.array_except("x", "y")), ",").alias("sobrantes"))


@query("WITH a AS (SELECT o_orderkey % 7 AS k, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT event_id % 9 AS k, count(*) AS n FROM events GROUP BY 1) SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS a, coalesce(b.n, 0) AS b, coalesce(a.n, 0) - coalesce(b.n, 0) AS diferencia FROM a FULL OUTER JOIN b ON a.k = b.k")
def q_dist_compare(spark, sf_dir):
    return quality.compare_counts(table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 7).alias("k")), table(spark, sf_dir, "events").select((F.col("event_id") % 9).alias("k")), "k")


_LOADED = "SELECT o_orderkey, o_orderstatus AS s1, CASE WHEN o_orderkey % 97 = 0 THEN 'X' ELSE o_orderstatus END AS s2, o_totalprice AS m1, o_totalprice + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0.001 END AS m2, CAST(o_orderdate AS DATE) AS d1, o_orderdate AS d2 FROM orders"


@query(f"WITH l AS ({_LOADED}), a AS (SELECT 'estado' AS campo, count_if(s1 = s2) AS aciertos, count_if(s1 <> s2) AS errores FROM l WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'monto', count_if(abs(m1 - m2) < 0.01), count_if(NOT abs(m1 - m2) < 0.01) FROM l WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'fecha', count_if(CAST(d1 AS VARCHAR) = substring(CAST(d2 AS VARCHAR), 1, 10)), count_if(CAST(d1 AS VARCHAR) <> substring(CAST(d2 AS VARCHAR), 1, 10)) FROM l WHERE o_orderkey % 2 = 0) SELECT *, CASE WHEN aciertos * 100.0 / (aciertos + errores) >= 99 THEN 'ok' WHEN aciertos * 100.0 / (aciertos + errores) >= 95 THEN 'warn' ELSE 'fail' END AS veredicto FROM a")
def q_field_agreement(spark, sf_dir):
    """Agreement of a sample; the sample is the operator's own."""
    rows = quality.sample(table(spark, sf_dir, "orders"), "o_orderkey", 2).select("o_orderkey", F.col("o_orderstatus").alias("s1"), F.expr("CASE WHEN o_orderkey % 97 = 0 THEN 'X' ELSE o_orderstatus END").alias("s2"), F.col("o_totalprice").alias("m1"), (F.col("o_totalprice") + F.when(F.col("o_orderkey") % 13 == 0, 1.0).otherwise(0.001)).alias("m2"), F.col("o_orderdate").cast("date").alias("d1"), F.col("o_orderdate").alias("d2"))
    return quality.agreement(rows, {"estado": F.col("s1") == F.col("s2"), "monto": F.abs(F.col("m1") - F.col("m2")) < 0.01, "fecha": F.col("d1").cast("string") == F.substring(F.col("d2").cast("string"), 1, 10)})


@query("SELECT o_orderkey, bool_or(contains(l.s, substring(o.s, 1, 20)) OR contains(o.s, substring(l.s, 1, 20))) AS coincide FROM (SELECT o_orderkey, 'pieza ' || (o_custkey % 40) AS s FROM orders) o JOIN (SELECT l_orderkey, 'pieza ' || (l_partkey % 40) AS s FROM lineitem) l ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def q_child_any_agreement(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("pieza "), F.col("o_custkey") % 40).alias("s"))
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.concat(F.lit("pieza "), F.col("l_partkey") % 40).alias("t"))
    hit = F.contains("t", F.substring("s", 1, 20)) | F.contains("s", F.substring("t", 1, 20))
    return o.join(li, "o_orderkey").groupBy("o_orderkey").agg(F.bool_or(hit).alias("coincide"))


@query(f"SELECT l_returnflag, {_t('l_extendedprice')} AS suma, round(avg(CAST(l_extendedprice AS DOUBLE)), 2) AS media, min({_m('l_extendedprice')}) AS minimo, max({_m('l_extendedprice')}) AS maximo, count_if(l_discount > 0) AS con_descuento FROM lineitem GROUP BY l_returnflag")
def q_money_recon(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(total("l_extendedprice").alias("suma"), F.round(F.avg("l_extendedprice"), 2).alias("media"), F.min(money("l_extendedprice")).alias("minimo"), F.max(money("l_extendedprice")).alias("maximo"), F.count_if(F.col("l_discount") > 0).alias("con_descuento"))


@query("WITH o AS (SELECT count(*) AS n, count_if(o_custkey IS NOT NULL) AS cliente, count_if(o_totalprice > 1000) AS monto, count_if(o_orderkey % 4 <> 0) AS ref FROM orders) SELECT 'cliente' AS campo, cliente AS con_valor, round(cliente * 100 / n::DOUBLE, 2) AS porcentaje FROM o UNION ALL SELECT 'monto', monto, round(monto * 100 / n::DOUBLE, 2) FROM o UNION ALL SELECT 'ref', ref, round(ref * 100 / n::DOUBLE, 2) FROM o")
def q_dim_coverage(spark, sf_dir):
    return quality.coverage(table(spark, sf_dir, "orders"), {"cliente": F.col("o_custkey").isNotNull(), "monto": F.col("o_totalprice") > 1000, "ref": F.col("o_orderkey") % 4 != 0})


@query(f"WITH {duck.CLASSIFIED} SELECT tipo, count(*) AS variantes, CAST(sum(n) AS BIGINT) AS registros, count_if(numero <> '') AS con_numero, round(sum(n) * 100 / sum(sum(n)) OVER ()::DOUBLE, 2) AS porcentaje FROM c GROUP BY tipo")
def q_kpi_by_type(spark, sf_dir):
    c = classified(spark, sf_dir).groupBy("tipo").agg(F.count("*").alias("variantes"), F.sum("n").alias("registros"), F.count_if(F.col("numero") != "").alias("con_numero"))
    whole = c.agg(F.sum("registros").alias("todo"))
    return c.join(F.broadcast(whole)).select("tipo", "variantes", "registros", "con_numero", F.round(F.col("registros") * 100 / F.col("todo"), 2).alias("porcentaje"))


@query(f"WITH {duck.CLASSIFIED} SELECT count(*) AS variantes, CAST(sum(n) AS BIGINT) AS registros, count(DISTINCT tipo) AS tipos, CAST(sum(CASE WHEN tipo = 'OTRO' THEN n ELSE 0 END) AS BIGINT) AS sin_tipo, count_if(n = 1) AS unicas FROM c")
def q_kpi_global(spark, sf_dir):
    return classified(spark, sf_dir).agg(F.count("*").alias("variantes"), F.sum("n").alias("registros"), F.count_distinct("tipo").alias("tipos"), F.sum(F.when(F.col("tipo") == "OTRO", F.col("n")).otherwise(0)).alias("sin_tipo"), F.count_if(F.col("n") == 1).alias("unicas"))


@query("SELECT 'estado' AS que, o_orderstatus AS valor, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'prioridad', o_orderpriority, count(*) FROM orders GROUP BY 2")
def q_freq_counters(spark, sf_dir):
    """Several frequency tables in one scan."""
    pairs = F.explode(F.array(F.struct(F.lit("estado").alias("que"), F.col("o_orderstatus").alias("valor")), F.struct(F.lit("prioridad").alias("que"), F.col("o_orderpriority").alias("valor"))))
    return table(spark, sf_dir, "orders").select(pairs.alias("x")).groupBy("x.que", "x.valor").agg(F.count("*").alias("n"))


@query(f"WITH {SENDERS}, r AS (SELECT ciudad, {duck.norm_city('ciudad')} AS k, count(*) AS n FROM s WHERE ciudad <> '' GROUP BY 1), a AS (SELECT k, CAST(sum(n) AS BIGINT) AS n, (list(ciudad ORDER BY length(ciudad) DESC, ciudad))[1] AS nombre FROM r GROUP BY k) SELECT nombre, n, round(n * 100 / max(n) OVER ()::DOUBLE, 1) AS barra FROM a")
def q_city_rollup(spark, sf_dir):
    r = senders(spark, sf_dir).filter("ciudad <> ''").groupBy("ciudad").agg(F.count("*").alias("n")).withColumn("k", text.norm_city(F.col("ciudad")))
    a = r.groupBy("k").agg(F.sum("n").alias("n"), F.min_by("ciudad", F.struct((-F.length("ciudad")).alias("l"), "ciudad")).alias("nombre"))
    return a.join(F.broadcast(a.agg(F.max("n").alias("m")))).select("nombre", "n", F.round(F.col("n") * 100 / F.col("m"), 1).alias("barra"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS mes, count(*) AS n FROM orders GROUP BY 1")
def q_month_counts(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("mes")).agg(F.count("*").alias("n"))


@query("SELECT n_name, count(*) AS clientes FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name")
def q_geo_dist(spark, sf_dir):
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("clientes"))
    return c.join(F.broadcast(table(spark, sf_dir, "nation")), "n_nationkey").select("n_name", "clientes")


@query(f"WITH {duck.CLASSIFIED} SELECT tipo, {_t('o_totalprice')} AS suma, round(avg(CAST(o_totalprice AS DOUBLE)), 2) AS media FROM s JOIN c ON c.raw = s.raw WHERE o_totalprice IS NOT NULL GROUP BY tipo")
def q_amount_by_type(spark, sf_dir):
    c = classified(spark, sf_dir).select("raw", "tipo")
    c = broadcast_if_small(c, c.count())
    return senders(spark, sf_dir).filter("o_totalprice IS NOT NULL").join(c, "raw").groupBy("tipo").agg(total("o_totalprice").alias("suma"), F.round(F.avg("o_totalprice"), 2).alias("media"))


@query("SELECT r_name, c_mktsegment, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL")
def q_dept_type_report(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey").join(F.broadcast(n), "n_nationkey").groupBy("r_name", "c_mktsegment").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 50 OFFSET 50")
def q_topn_page(spark, sf_dir):
    """The second page of fifty."""
    return table(spark, sf_dir, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").offset(50).limit(50).select("c_custkey", "c_name")


@query("SELECT c_custkey, row_number() OVER (ORDER BY coalesce(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END, 'zzz'), c_acctbal DESC, c_custkey) AS lugar FROM customer")
def q_user_sort(spark, sf_dir):
    """All customers by segment (missing last) and balance, numbered range by range."""
    key = F.coalesce(F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")), F.lit("zzz"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", key.alias("k"))
    return model.numbered(rows, ["k", F.desc("c_acctbal"), "c_custkey"], "lugar").select("c_custkey", "lugar")


@query("SELECT r.event_id AS desembargo_id, o.event_id AS embargo_id, o.user_id AS usuario FROM events r JOIN events o ON o.event_id = r.event_id - 1 WHERE r.event_type = 'purchase' AND o.event_type <> 'purchase' ORDER BY 1 LIMIT 30")
def q_release_pairs(spark, sf_dir):
    """Thirty releases and the orders that their secondary ids name."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", (F.col("event_id") - 1).alias("secondary_id"))
    pairs = model.release_pairs(e, F.col("event_type") == "purchase", F.col("event_type") != "purchase", "secondary_id", "event_id")
    return pairs.select(F.col("event_id").alias("desembargo_id"), F.col("order_event_id").alias("embargo_id"), F.col("order_user_id").alias("usuario")).orderBy("desembargo_id").limit(30)


@query("WITH e AS (SELECT event_id, user_id, event_type FROM events), a AS (SELECT user_id, event_type, min(event_id) AS m FROM e WHERE event_id % 10 = 0 GROUP BY ALL), b AS (SELECT user_id, min(event_id) AS m FROM e WHERE event_id % 10 = 0 GROUP BY ALL) SELECT e.event_id, coalesce(a.m, b.m) AS par, CASE WHEN a.m IS NOT NULL THEN 1 ELSE 2 END AS nivel FROM e LEFT JOIN a ON a.user_id = e.user_id AND a.event_type = e.event_type LEFT JOIN b ON b.user_id = e.user_id WHERE e.event_id % 10 <> 0 AND (a.m IS NOT NULL OR b.m IS NOT NULL)")
def q_fallback_match(spark, sf_dir):
    """Events matched by user and type, else by user alone."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    base, own = e.filter("event_id % 10 = 0"), e.filter("event_id % 10 <> 0")
    levels = [own.join(base.groupBy(*key).agg(F.min("event_id").alias("par")), list(key)).select("event_id", "par") for key in (("user_id", "event_type"), ("user_id",))]
    return model.cascade(own, "event_id", levels)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 10 = 0")
def q_seeded_sample(spark, sf_dir):
    """About a tenth of orders, the same each time: sampling is the operator."""
    return quality.sample(table(spark, sf_dir, "orders"), "o_orderkey", 10).select("o_orderkey", "o_totalprice")
