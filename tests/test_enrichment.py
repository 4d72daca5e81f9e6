from pyspark.sql import functions as F

from sendero.operators import enrich, model, quality
from sendero.sources import readers


def test_enrichment_fills_and_cleans(spark):
    names = spark.createDataFrame([(1, "Alcaldía de Tunja", " ", None, 5), (2, "Alcaldia de Tunja 3", "cali", "x@y.co", 1), (3, "", "", "", 0), (4, "sin par", "NaN", "none", 2)], "entidad_id long, nombre_extraido string, ciudad string, email_extraido string, total_registros long").withColumn("numero_despacho", F.lit("n1"))
    rows = spark.createDataFrame([(1, "ALCALDIA DE TUNJA", " 900 ", "a@b.co", "null"), (2, "alcaldía de tunja", "901", "c@d.co", "Tunja"), (3, " ", "1", "", "")], "rid long, nombre string, nit string, email_real string, municipio string")
    got = {r.entidad_id: r for r in enrich.enrich_coercive(names, enrich.registry(rows, enrich.FROM_COERCIVE)).collect()}
    assert got[1].asDict() | {} == got[1].asDict() and list(got[1].asDict()) == enrich.COERCIVE
    assert (got[1].nombre_real, got[1].nit, got[1].email_extraido, got[1].email_real, got[1].ciudad) == ("ALCALDIA DE TUNJA", "900", "A@B.CO", "A@B.CO", "")
    assert (got[2].nombre_real, got[2].email_extraido, got[2].ciudad) == ("ALCALDIA DE TUNJA", "X@Y.CO", "CALI")
    assert (got[3].nombre_real, got[4].nombre_real, got[4].ciudad, got[4].email_extraido) == ("", "", "", "")
    courts = {r.entidad_id: r for r in enrich.enrich_judicial(names, enrich.registry(rows.filter("rid = 2"), enrich.FROM_JUDICIAL, city="municipio")).collect()}
    assert (courts[1].ciudad, courts[1].nombre_real, courts[1].numero_despacho, courts[1].email_real) == ("TUNJA", "ALCALDÍA DE TUNJA", "N1", "")
    assert len(enrich.UNIFIED) == 21


def test_header_after_a_preamble(spark, tmp_path):
    (tmp_path / "r.csv").write_text("listado,,\n,\"dos\nlineas\",\nJURISDICCIÓN,NOMBRE,NOMBRE\nORDINARIA,a,b\nJURISDICCIÓN,x\n")
    got = readers.csv_with_found_header(spark, str(tmp_path / "r.csv"), "jurisdi")
    assert [tuple(r) for r in got.collect()] == [("ORDINARIA", "b"), ("JURISDICCIÓN", "")]
    assert got.columns == ["JURISDICCIÓN", "NOMBRE"]
    try:
        readers.csv_with_found_header(spark, str(tmp_path / "r.csv"), "nada")
        raise AssertionError
    except ValueError:
        pass
    rows = spark.createDataFrame([("a", 1, 1), ("a", 2, 5), ("b", 3, 0)], "k string, n int, v int")
    assert sorted(tuple(r) for r in readers.last_wins(rows, "k", F.col("n")).collect()) == [("a", 2, 5), ("b", 3, 0)]


def test_numbers_reports_and_drift(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    assert [(r.k, r.n) for r in model.numbered(rows, ["k"], "n").orderBy("k").collect()] == [(k, k + 1) for k in range(1000)]
    assert model.numbered(rows.limit(0), ["k"], "n").count() == 0
    figures = spark.createDataFrame([("b", 2), ("a", None)], "que string, n int")
    assert [r.linea for r in quality.report("INFORME", figures).orderBy("n").collect()] == ["INFORME", "=======", "que                       n".ljust(0), "a                         -", "b                         2"]
    empty = spark.range(0)
    got = {r.tabla: (r.porcentaje, r.veredicto) for r in quality.row_drift([("x", spark.range(1000), spark.range(995)), ("y", spark.range(100), spark.range(90)), ("e", empty, empty), ("f", empty, spark.range(2))]).collect()}
    assert got == {"x": (-0.5, "ok"), "y": (-10.0, "fail"), "e": (0.0, "ok"), "f": (None, "fail")}
    ddl = model.rebuild_ddl()
    assert ddl[0].startswith("DROP TABLE IF EXISTS fact_oficios") and len(ddl) == 2 * len(model.SCHEMAS) and ddl[6].startswith("CREATE TABLE dim_departamentos")
