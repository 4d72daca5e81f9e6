"""From two raw files to five loaded tables, and the third model in a database."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sendero.functions import geo
from sendero.operators import enrich, quality, schema
from sendero.plans import build
from sendero.sources import load, readers, sinks
from sendero.sources.stage import shared_folder


def order(i, sender, status="PROCESADO", city="", fields=44, **more):
    row = [""] * 44
    row[0], row[12], row[13], row[5], row[35] = str(i), sender, status, city, "01"
    for k, v in more.items():
        row[int(k[1:])] = v
    return ",".join('"' + x.replace('"', '""') + '"' if any(c in x for c in ',"\n') else x for x in row[:fields])


def child(i, name, fields=19, **more):
    row = [""] * 19
    row[15], row[12] = str(i), name
    for k, v in more.items():
        row[int(k[1:])] = v
    return ",".join('"' + x + '"' if "," in x else x for x in row[:fields])


def staged_tables(spark):
    return set(os.listdir(shared_folder(spark).removeprefix("file://")))


@pytest.fixture
def files(tmp_path):
    head = [f"c{i}" for i in range(44)]
    head[0], head[5] = "id", "ciudad"
    orders = [
        order(1, "ALCALDIA DE PASTO", c4="NoEncontrada", c9="No encontrado", c15="2020-01-02", c20="10.5", c25="2020-01-03 10:00:00"),
        order(2, "Alcaldía de Pasto", c4="a@b.co", c9="Calle 1, Pasto", c20="1e3x"),
        order(3, ' "ALCALDIA DE PASTO" ', status="SIN_CONFIRMAR"),
        order(4, "JUZGADO 3 CIVIL MUNICIPAL", city="Pereira"),
        order(5, "JUZGADO 3 CIVIL MUNICIPAL", city="Lugar Raro", status=""),
        order(6, "GOBERNACION DEL CESAR", fields=40, c35=""),
        order(7, "SIN CAMPOS", fields=35),
        order(8, "EMCALI", c35="x"),
        order(9, "", c27="una,\nreferencia"),
        "",
    ]
    children = [child(1, " ,PEREZ, ANA, ", c5="E1", c10="9.99", c7="77", c17="CC"), child(1, "SEGUNDO"), child(2, "CORTO", fields=17), child(4, "LOPEZ"), child("", "NADIE"), child(99, "OTRO")]
    (tmp_path / "embargos.csv").write_text("\n".join([",".join(head), *orders]), encoding="utf-8")
    (tmp_path / "demandado.csv").write_text("\n".join([",".join(f"d{i}" for i in range(19)), *children]), encoding="utf-8")
    return str(tmp_path / "embargos.csv"), str(tmp_path / "demandado.csv"), f"file://{tmp_path}/model"


def test_two_files_become_five_tables(spark, files):
    before = staged_tables(spark)
    built = build.build(spark, *files)
    assert staged_tables(spark) == before
    rows = {name: {r[0]: r for r in t.collect()} for name, t in load.tables(spark, files[2]).items()}
    assert set(rows) == {"dim_departamentos", "dim_municipios", "dim_entidades", "dim_variantes", "fact_oficios"}
    assert built.counts == {"filas": 9, "filas_cortas": 1, "estado_excluido": 1, "oficios": 7, "sin_entidad": 0, "con_demandado": 2, "sin_municipio": 3, "sin_departamento": 2, "filas_demandado": 6, "filas_cortas_demandado": 1}
    fact, entity = rows["fact_oficios"], rows["dim_entidades"]
    assert sorted(fact) == ["1", "2", "4", "5", "6", "8", "9"]
    dept = {r.nombre: r.departamento_id for r in rows["dim_departamentos"].values()}
    city = {(r.nombre, r.departamento_id): r.municipio_id for r in rows["dim_municipios"].values()}
    place = lambda f: (f.municipio_id, f.departamento_id, f.fuente_ubicacion)
    assert fact["1"].entidad_remitente_id == fact["2"].entidad_remitente_id and entity[fact["1"].entidad_remitente_id].total_registros == 2
    assert place(fact["1"]) == (city["Pasto", dept["Nariño"]], dept["Nariño"], "entidad")
    assert place(fact["4"]) == (city["Pereira", dept["Risaralda"]], dept["Risaralda"], "ciudad_original")
    assert place(fact["5"]) == (None, None, "ciudad_sin_resolver")
    assert place(fact["6"]) == (None, dept["Cesar"], "sin_dato")
    assert place(fact["8"]) == (city["Cali", dept["Valle del Cauca"]], dept["Valle del Cauca"], "entidad")
    assert place(fact["9"]) == (None, None, "sin_dato")
    f = fact["1"]
    assert (f.nombre_demandado, str(f.monto), str(f.monto_a_embargar), f.expediente, f.id_demandado, f.tipo_id_demandado) == ("PEREZ, ANA", "10.50", "9.99", "E1", "77", "CC")
    assert (f.correo_remitente, f.direccion_remitente, f.entidad_bancaria_id, str(f.fecha_oficio), str(f.processed_at)) == (None, None, 1, "2020-01-02", "2020-01-03 10:00:00")
    assert (fact["2"].correo_remitente, fact["2"].direccion_remitente, fact["2"].monto, fact["2"].nombre_demandado) == ("a@b.co", "Calle 1, Pasto", None, None)
    assert fact["8"].entidad_bancaria_id is None and fact["9"].referencia == "una,\nreferencia" and fact["4"].nombre_demandado == "LOPEZ"
    variants = sorted((r.variante_original, r.conteo, entity[r.entidad_id].tipo) for r in rows["dim_variantes"].values() if r.variante_original)
    assert variants == [("ALCALDIA DE PASTO", 1, "ALCALDIA"), ("Alcaldía de Pasto", 1, "ALCALDIA"), ("EMCALI", 1, "EMCALI"), ("GOBERNACION DEL CESAR", 1, "GOBERNACION"), ("JUZGADO 3 CIVIL MUNICIPAL", 2, "JUZGADO")]
    assert sorted(rows["dim_variantes"]) == list(range(1, 7)) and sorted(entity) == list(range(1, 6))
    again = build.build(spark, *files, clean_csv=files[2] + "-clean")
    clean = {r.embargo_id: r for r in readers.named_csv(spark, files[2] + "-clean", list(build.CLEAN)).collect()}
    assert len(build.CLEAN) == 26 and sorted(clean) == sorted(fact) and clean["9"].referencia == "una,\nreferencia" and clean["9"].nombre_remitente is None
    c = clean["2"]
    assert (c.nombre_remitente, c.entidad_remitente_id, c.correo_remitente, c.monto, c.nombre_demandante, c.estado_embargo) == ("ALCALDIA DE PASTO", str(fact["2"].entidad_remitente_id), "a@b.co", "1e3x", None, "PROCESADO")
    assert again.manifest.version == 2 and again.counts == built.counts
    assert {name: {r[0]: r for r in t.collect()} for name, t in load.tables(spark, files[2]).items()} == rows


def test_a_repeated_order_stops_the_load(spark, files, tmp_path):
    build.build(spark, *files)
    with open(files[0], "a", encoding="utf-8") as f:
        f.write("\n" + order(1, "OTRA"))
    with pytest.raises(load.LoadError, match="oficio_id repeats"):
        build.build(spark, *files)
    assert load.manifest(spark, files[2]).version == 1


def test_short_rows_are_told_by_their_fields(spark, tmp_path):
    (tmp_path / "p.csv").write_text('a,b,c\n1,,\n2,\n3\n4,"x,y"\n"5,6"\n7,8,9,10\n')
    got = readers.positional_csv(spark, str(tmp_path / "p.csv"), 3, {0: "x", 1: "y"}, 2)
    assert [tuple(r) for r in got.collect()] == [("1", None), ("2", None), ("4", "x,y"), ("7", "8")]


def test_third_model_in_a_database(spark):
    url = "jdbc:derby:memory:third;create=true"
    for replace in (False, True):
        db = load._connection(spark, url, {})
        run = db.createStatement()
        for statement in schema.database(replace):
            run.executeUpdate(statement)
        db.close()
    rows = {
        "dim_departamentos": [("1", "Nariño")],
        "dim_municipios": [("5", "Pasto", "1")],
        "dim_entidades": [("10", "ALCALDIA DE PASTO", "ALCALDIA", "5"), ("11", "JUZGADO 3", "JUZGADO", " "), ("12", "x" * 600, "OTRO", "?")],
        "dim_entidades_coactivas": [("10", "ALCALDIA DE PASTO", "900")],
        "dim_entidades_judiciales": [("11", "JUZGADO 3")],
        "dim_variantes": [("1", "10", "Alcaldía")],
        "fact_oficios": [("A1", "10", "12.345", "2020-02-30")],
    }
    columns = {"dim_entidades": "entidad_id nombre_normalizado tipo municipio_id", "dim_entidades_coactivas": "entidad_id nombre_extraido nit", "dim_variantes": "variante_id entidad_id variante_original", "fact_oficios": "oficio_id entidad_remitente_id monto fecha_oficio", "dim_municipios": "municipio_id nombre departamento_id", "dim_departamentos": "departamento_id nombre", "dim_entidades_judiciales": "entidad_id nombre_extraido"}
    given = {t: schema.fitted(spark.createDataFrame(rows[t], ", ".join(f"{c} string" for c in columns[t].split())), t) for t in schema.TABLES}
    assert {t: len(g.columns) for t, g in given.items()} == {"dim_departamentos": 2, "dim_municipios": 3, "dim_entidades": 21, "dim_entidades_coactivas": 19, "dim_entidades_judiciales": 16, "dim_variantes": 5, "fact_oficios": 25}
    assert given["dim_entidades"].columns == enrich.UNIFIED and given["dim_entidades_coactivas"].columns == enrich.COERCIVE and given["dim_entidades_judiciales"].columns == enrich.JUDICIAL
    upper = {t: g.toDF(*[c.upper() for c in g.columns]) for t, g in given.items()}
    assert load.load_jdbc(spark, url, upper)["fact_oficios"] == 1
    want = {"judiciales": [(11, "JUZGADO 3", None)], "coactivas": [(10, "ALCALDIA DE PASTO", "Pasto"), (12, "x" * 500, None)]}
    schema.create_views(given)
    for name, expected in want.items():
        for seen in (spark.read.jdbc(url, f"vista_entidades_{name}"), spark.table(f"vista_entidades_{name}")):
            assert sorted(tuple(r) for r in seen.select("entidad_id", "nombre_extraido", "ciudad").collect()) == expected
    fact = given["fact_oficios"].first()
    assert str(fact.monto) == "12.35" and fact.fecha_oficio is None and given["dim_entidades"].filter("entidad_id = 12").first().total_registros == 0
    broken = load.broken_rules({**given, "dim_entidades": given["dim_entidades"].filter("entidad_id <> 10")}, "dim_variantes", schema.rules("dim_variantes"))
    assert list(broken) == ["dim_variantes: entidad_id has no row in dim_entidades"]


def test_samples_of_exactly_n(spark):
    rows = spark.range(5000).select((F.col("id") * 3).alias("k"), F.col("id").alias("v"), F.array("id").alias("a"))
    want = sorted(r.k for r in quality.sample_of(rows, "k", 700).collect())
    assert len(want) == 700 == len(set(want))
    for n in (1, 9):
        assert sorted(r.k for r in quality.sample_of(rows.repartition(n, "v"), "k", 700, heap=10).collect()) == want
    assert want != sorted(r.k for r in quality.sample_of(rows, "k", 700, seed=1).collect())
    assert 120 < sum(k % 2 for k in want) * 0.5 < 230
    assert quality.sample_of(rows, "k", 6000).count() == 5000 == quality.sample_of(rows, "k", 6000, heap=10).count()
    same = spark.createDataFrame([(None, i % 50) for i in range(500)], "k int, v int")  # one key, repeated rows
    for heap in (1000, 1):
        assert sorted(r.v for r in quality.sample_of(same, "k", 25, heap=heap).collect()) == [0] * 10 + [1] * 10 + [2] * 5
    assert quality.sample_of(rows.limit(0), "k", 3).count() == 0 and quality.sample_of(rows, "k", 0).count() == 0


def test_nested_json(spark):
    kinds = spark.createDataFrame([("b", 2, ["x"]), ("á", 9, []), ("c", 5, None)], "tipo string, n int, v array<string>")
    none = kinds.select("tipo").limit(0)
    told = json.loads(sinks.nested_json({"por tipo": kinds, "nada": none, "todo": kinds.select(F.struct("tipo", "n").alias("de"))}, {"por tipo": [-F.col("n")]}).first().json)
    assert told == {"por tipo": [{"tipo": "á", "n": 9, "v": []}, {"tipo": "c", "n": 5, "v": None}, {"tipo": "b", "n": 2, "v": ["x"]}], "nada": [], "todo": [{"de": {"tipo": "b", "n": 2}}, {"de": {"tipo": "c", "n": 5}}, {"de": {"tipo": "á", "n": 9}}]}


def test_csv_sink_and_names_of_any_length(spark, tmp_path):
    rows = spark.createDataFrame([("1", 'a "b", c', None)], "x string, y string, z string")
    sinks.write_csv(rows, str(tmp_path / "out"), ["y", "x", "z"])
    assert [tuple(r) for r in readers.named_csv(spark, str(tmp_path / "out"), ["y", "x", "z"]).collect()] == [('a "b", c', "1", None)]
    long = "San José de los Nueve Ríos del Alto Valle Escondido"
    listed = spark.createDataFrame([("Uno", long, 0), ("Dos", "San José", 1)], "departamento string, municipio string, ord int")
    g = geo.geography_of(listed, preferred=[], city_aliases=[("EL LUGAR DE LAS SEIS PALABRAS", "San José", "Dos")], dept_aliases=[])
    texts = {f"ALCALDIA DE {long.upper().replace('É', 'E').replace('Í', 'I')} X": (long, "Uno"), "ALCALDIA DE SAN JOSE DE LOS NUEVE": ("San José", "Dos"), "ALCALDIA EL LUGAR DE LAS SEIS PALABRAS": ("San José", "Dos"), "": (None, None)}
    frame = spark.createDataFrame([(t, "ALCALDIA") for t in texts], "clean string, tipo string")
    assert {r.clean: (r.municipio, r.departamento) for r in geo.locate(frame, g).collect()} == texts


def test_departments_by_alias_and_in_listed_order(spark):
    _, towns, keys, cities = build.place_tables(geo.geography(spark))
    departments = {r.nombre: r.departamento_id for r in build.place_tables(geo.geography(spark))[0].collect()}
    town = {(r.nombre, r.departamento_id): r.municipio_id for r in towns.collect()}
    asked = {
        ("CALI", "VALLE"): ("Cali", "Valle del Cauca"), ("MEDELLIN", "ANTIOQUIA"): ("Medellín", "Antioquia"), ("ARMENIA", "QUINDIO"): ("Armenia", "Quindío"), ("ARMENIA", ""): (None, None),
        ("", "BOGOTA DC"): (None, "Bogotá, D.C."), ("", "DEPARTAMENTO DEL META"): (None, "Meta"), ("", "SANTANDER"): (None, "Santander"), ("NEIVA", "NINGUNO"): ("Neiva", None), ("", "CORDO"): (None, "Córdoba"),
        ("", "A"): (None, "Amazonas"),
    }
    rows = spark.createDataFrame(list(asked), "key string, dept_key string")
    got = {(r.key, r.dept_key): (r.municipio_id, r.departamento_id) for r in geo.resolve_ids(rows, cities, keys).collect()}
    of = {"Cali": "Valle del Cauca", "Medellín": "Antioquia", "Armenia": "Quindío", "Neiva": "Huila"}
    assert got == {k: (town[m, departments[of[m]]] if m else None, departments[d] if d else None) for k, (m, d) in asked.items()}
