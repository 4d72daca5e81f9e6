import itertools
import re
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from sendero.functions import geo
from sendero.operators import match, model, quality, resolve
from sendero.sources import readers, sinks
from sendero.streaming.lookup import resolve_stream


def test_location_quirks(spark):
    g = geo.geography(spark)
    names = {"JUZGADO DE MOSQUERA NARIÑO": ("Mosquera", "Nariño"), "ALCALDIA DE MOSQUERA": ("Mosquera", "Cundinamarca"), "OFICINA DE CALI": (None, "Valle del Cauca"), "ALCALDIA DE SANTIAGO DE CALI": ("Cali", "Valle del Cauca"), "ALCALDIA DE BOGOTA": ("Bogotá", "Bogotá, D.C."), "NADA": (None, None), "ALCALDIA DE PASTO SANTANDER": ("Pasto", "Nariño")}
    rows = spark.createDataFrame([(n, "ALCALDIA") for n in names], "clean string, tipo string")
    assert {r.clean: (r.municipio, r.departamento) for r in geo.locate(rows, g).collect()} == names
    office = spark.createDataFrame([("GOBERNACION DE PEREIRA", "GOBERNACION"), ("GOBERNACION DEL CESAR", "GOBERNACION")], "clean string, tipo string")
    assert {(r.municipio, r.departamento) for r in geo.locate(office, g).collect()} == {(None, "Risaralda"), (None, "Cesar")}


def test_anchor_clusters_follow_order(spark):
    rows = [("a", "ABCDEFGHIJ", 9), ("b", "ABCDEFGHIX", 5), ("c", "ABCDEFGHXX", 4), ("d", "ZZZZZZZZZZ", 3), ("e", "", 2)]
    named = spark.createDataFrame([(r, c, c or "ZZZ", n, "JUZGADO", "x") for r, c, n in rows], "raw string, core string, clean string, n long, tipo string, b string")
    got = {r.raw: r.cluster for r in resolve.anchor_clusters(named, ["b"], [F.desc("n")]).collect()}
    assert got == {"a": 0, "b": 0, "c": 1, "d": 2, "e": 3}


def test_residual_duplicates_score(spark):
    rows = [(1, "ALCALDIA MUNICIPAL DE TUNJA", "ALCALDIA", "", "", "", 90), (2, "ALCALDIA MUNICIPAL DE TUNJAA", "ALCALDIA", "", "", "", 3), (3, "ALCALDIA DE CALI", "ALCALDIA", "", "", "", 2)]
    out = match.residual_duplicates(spark.createDataFrame(rows, "entidad_id long, nombre string, tipo string, subtipo string, municipio string, departamento string, total_registros long")).collect()
    assert [(r.child_id, r.parent_id) for r in out] == [(2, 1)]
    assert out[0].similitud == round(SequenceMatcher(None, rows[1][1], rows[0][1]).ratio(), 3)


def test_dedup_is_idempotent(spark):
    rows = [(1, "N", "P"), (2, "N", "F"), (10, "N", "P"), (9, "N", "P"), (3, None, "P"), (4, None, "P")]
    fact = spark.createDataFrame(rows, "id long, numero string, estado string")
    run = lambda f: model.dedup_by_priority(f, "numero", [F.col("numero")], F.col("estado"), "id", {"P": 1, "F": 2}).filter("keep").drop("keep")
    once = run(fact)
    assert sorted(r.id for r in once.collect()) == [3, 4, 9]
    assert sorted(r.id for r in run(once).collect()) == [3, 4, 9]


def test_orphans_skip_nulls(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "f int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert [tuple(r) for r in quality.orphans([("r", child, "f", parent, "k")]).collect()] == [("r", 1)]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿id,texto\n1,\"dos\nlineas\"\n2,x\n".encode())
    assert [tuple(r) for r in readers.named_csv(spark, str(tmp_path / "a.csv"), ["id", "texto"]).collect()] == [("1", "dos\nlineas"), ("2", "x")]
    assert readers.line_count(spark, str(tmp_path / "a.csv")) == 3
    (tmp_path / "b.csv").write_text("a,b,c\n1,2,3\n4\n5,6\n")
    assert [tuple(r) for r in readers.positional_csv(spark, str(tmp_path / "b.csv"), 3, {0: "x", 1: "y"}, 2).collect()] == [("1", "2"), ("5", "6")]
    (tmp_path / "g.json").write_text('[{"id": 0, "departamento": "A", "ciudades": ["x", "y"]}, {"id": 1, "departamento": "B", "ciudades": []}]')
    assert [tuple(r) for r in readers.geography_json(spark, str(tmp_path / "g.json")).orderBy("ord").collect()] == [("A", "x", 0), ("A", "y", 1), ("B", None, 10000)]
    rows = spark.createDataFrame([("1", "7", "2020-01-02", "9.5"), ("2", "", "bad", "x")], "oficio_id string, entidad_bancaria_id string, fecha_oficio string, monto string")
    sinks.write_table(rows, str(tmp_path / "f"), "fact_oficios")
    back = spark.read.parquet(str(tmp_path / "f")).orderBy("oficio_id").collect()
    assert back[0].entidad_bancaria_id == 7 and str(back[0].monto) == "9.50" and back[1].fecha_oficio is None and len(back[0]) == 25
    assert readers.header_column(["NOMBRE DESPACHO", "CODIGO DESPACHO"], "CODIGO", "DESPACHO") == "CODIGO DESPACHO"
    assert "monto decimal(20,2)" in model.ddl("fact_oficios")


def test_stream_lookup(spark, tmp_path):
    spark.createDataFrame([(1, "ALCALDIA"), (2, "NUEVA")], "id int, raw string").write.parquet(str(tmp_path / "in"))
    variants = spark.createDataFrame([("ALCALDIA", 5)], "variante_original string, entidad_id int")
    stream = spark.readStream.schema("id int, raw string").parquet(str(tmp_path / "in"))
    q = resolve_stream(stream, variants).writeStream.format("memory").queryName("looked_up").start()
    q.processAllAvailable()
    q.stop()
    assert {(r.id, r.entidad_id) for r in spark.sql("SELECT * FROM looked_up").collect()} == {(1, 5), (2, None)}


def test_residual_candidates_of_courts_against_all_pairs(spark):
    kinds = ["CIVIL MUNICIPAL", "PENAL MUNICIPAL", "CIVIL CIRCUITO", "LABORAL CIRCUITO"]
    rows, i = [], 0
    for kind in kinds:
        for ordinal in ("PRIMERO", "SEGUNDO", "003", "12", ""):
            for city in ("TUNJA", "PASTO", "CALI"):
                for tail in ("", " ORALIDAD", " PEQUENAS CAUSAS", " 45"):
                    i += 1
                    rows.append((i, f"JUZGADO {ordinal} {kind} DE {city}{tail}".replace("  ", " "), "JUZGADO", kind, city if i % 3 else "", "", 1000 - i * 7 % 400))
    schema = "entidad_id long, nombre string, tipo string, subtipo string, municipio string, departamento string, total_registros long"

    def against(rows):
        ents = spark.createDataFrame(rows, schema)
        told = {r.entidad_id: r for r in ents.select("*", match.norm_suggest(F.col("nombre")).alias("norm"), match.key_words(F.col("nombre")).alias("words"), match.court_ordinal(F.col("nombre")).alias("ordinal")).collect()}
        digits = {k: {*re.findall(r"\d+", r.norm)} for k, r in told.items()}
        want = set()
        for c, p in itertools.permutations(told.values(), 2):
            a, b = {*c.words}, {*p.words}
            if len(rows) > 200 and c.subtipo != p.subtipo or p.total_registros <= c.total_registros or len(a) < 2:
                continue
            if not a & b or len(a & b) / max(len(a), len(b)) < 0.5 or c.municipio and p.municipio and c.municipio != p.municipio:
                continue
            x, y = digits[c.entidad_id], digits[p.entidad_id]
            if x and y and x != y or None not in (c.ordinal, p.ordinal) and c.ordinal != p.ordinal:
                continue
            if min(len(c.norm), len(p.norm)) / max(len(c.norm), len(p.norm)) >= 0.88 * 0.85:
                want.add((c.entidad_id, p.entidad_id))
        got = [(r.c_entidad_id, r.p_entidad_id) for r in match.residual_candidates(ents).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want
        return want

    small = against(rows[::2])
    large = against(rows)
    subtype = {r[0]: r[3] for r in rows}
    assert any(subtype[c] != subtype[p] for c, p in small) and all(subtype[c] == subtype[p] for c, p in large)


def test_geography_of_a_file(spark, tmp_path):
    path = str(tmp_path / "g.json")
    (tmp_path / "g.json").write_text('[{"id": 0, "departamento": "Antioquia", "ciudades": ["Medellín", "Armenia", "Armenia"]}, {"id": 1, "departamento": "Quindío", "ciudades": ["Armenia", "Circasia"]}, {"id": 2, "departamento": "Vaupés", "ciudades": []}, {"id": 3, "ciudades": ["X"]}]')
    g = geo.geography_of(readers.geography_json(spark, path))
    assert [(r.departamento, r.ord) for r in g.departments.orderBy("ord").collect()] == [("Antioquia", 0), ("Quindío", 1), ("Vaupés", 2)]
    assert [(r.municipio, r.departamento) for r in g.homonyms.orderBy("ord").collect()] == [("Medellín", "Antioquia"), ("Armenia", "Antioquia"), ("Armenia", "Quindío"), ("Circasia", "Quindío")]
    texts = {"ALCALDIA DE ARMENIA": ("Armenia", "Quindío"), "ALCALDIA DE ARMENIA ANTIOQUIA": ("Armenia", "Antioquia"), "PERSONERIA DE CIRCASIA": ("Circasia", "Quindío"), "OFICINA DEL VAUPES": (None, "Vaupés")}
    rows = spark.createDataFrame([(t, "ALCALDIA") for t in texts], "clean string, tipo string")
    assert {r.clean: (r.municipio, r.departamento) for r in geo.locate(rows, g).collect()} == texts
    assert geo.geography_of(spark.createDataFrame([], "departamento string, municipio string, ord int")).homonyms.collect() == []
