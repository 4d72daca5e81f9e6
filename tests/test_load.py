"""Loads that take effect together, into folders and into the database that comes with Spark."""

import pytest
from pyspark.sql import functions as F

from sendero.sources import load, readers
from sendero.sources.load import LoadError, Rules

RULES = {"dept": Rules(key=("id",)), "city": Rules(key=("id",), refers=(("dept_id", "dept", "id"),)), "fact": Rules(key=("id",), refers=(("city_id", "city", "id"),))}


def given(spark, n, bad=False):
    dept = spark.range(n).select("id", F.concat(F.lit(f"d{n}-"), "id").alias("nombre"))
    city = spark.range(2 * n).select("id", (F.col("id") % n).alias("dept_id"))
    fact = spark.range(5 * n).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % (2 * n)).alias("city_id"), F.lit(n).alias("round"))
    if bad:
        fact = fact.withColumn("round", F.when(F.col("id") == 3, F.raise_error(F.lit("a row cannot be read"))).otherwise(F.col("round")).cast("int"))
    return {"dept": dept, "city": city, "fact": fact}


def state(spark, folder):
    return {name: sorted(tuple(r) for r in rows.collect()) for name, rows in load.tables(spark, folder).items()}


def test_a_table_that_fails_leaves_all_old_ones(spark, tmp_path):
    folder = f"file://{tmp_path}/model"
    assert load.manifest(spark, folder).version == 0 and load.tables(spark, folder) == {}
    first = load.load(spark, folder, given(spark, 4), RULES)
    assert first.version == 1 and {n: t["rows"] for n, t in first.tables.items()} == {"dept": 4, "city": 8, "fact": 20}
    old = state(spark, folder)
    with pytest.raises(Exception, match="cannot be read"):
        load.load(spark, folder, given(spark, 6, bad=True), RULES)
    assert state(spark, folder) == old and load.manifest(spark, folder).version == 1
    assert not [p for p in (tmp_path / "model").glob("load-*") if p.name not in first.tables["dept"]["path"]]
    assert load.load(spark, folder, given(spark, 6), RULES).version == 2
    new = state(spark, folder)
    assert len(new["fact"]) == 30 and {r[2] for r in new["fact"]} == {6} and len(new["dept"]) == 6
    assert {n: sorted(tuple(r) for r in rows.collect()) for n, rows in load.tables(spark, folder, 1).items()} == old


@pytest.mark.parametrize("name,rows,said", [
    ("dept", [(None, "x")], "null in id"),
    ("dept", [(0, "a"), (0, "b"), (1, "c"), (2, "d"), (3, "e")], "id repeats"),
    ("city", [(0, 99)], "dept_id has no row in dept"),
    ("dept", [(0, "a")], "dept_id has no row in dept"),
])
def test_broken_rules_stop_a_load(spark, tmp_path, name, rows, said):
    """Also those of a table that the load leaves alone."""
    folder = f"file://{tmp_path}/model"
    tables = given(spark, 4)
    load.load(spark, folder, tables, RULES)
    old = state(spark, folder)
    with pytest.raises(LoadError, match=said):
        load.load(spark, folder, {name: spark.createDataFrame(rows, f"id bigint, {tables[name].columns[1]} {tables[name].dtypes[1][1]}")}, RULES)
    assert state(spark, folder) == old


def test_one_of_two_loads_at_a_time_and_vacuum(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/model"
    load.load(spark, folder, given(spark, 2))
    put = load._put

    def late(spark, folder, new):
        monkeypatch.setattr(load, "_put", put)
        load.load(spark, folder, given(spark, 3))  # another load is faster
        put(spark, folder, new)

    monkeypatch.setattr(load, "_put", late)
    with pytest.raises(LoadError, match="there already"):
        load.load(spark, folder, given(spark, 5))
    assert len(state(spark, folder)["dept"]) == 3
    load.load(spark, folder, {"dept": given(spark, 9)["dept"]})
    (tmp_path / "model/load-broken/x").mkdir(parents=True)
    kept = state(spark, folder)
    gone = load.vacuum(spark, folder, keep=1)
    assert "load-broken" in gone and "manifest-0000000001.json" in gone and any(g.endswith("/dept") for g in gone)
    assert state(spark, folder) == kept and len(kept["dept"]) == 9 and len(kept["fact"]) == 15
    assert load.vacuum(spark, folder, keep=1) == []


def database(spark, name):
    url = f"jdbc:derby:memory:{name};create=true"
    db = load._connection(spark, url, {})
    run = db.createStatement()
    run.executeUpdate('CREATE TABLE dept ("id" BIGINT NOT NULL PRIMARY KEY, "nombre" VARCHAR(20))')
    run.executeUpdate('CREATE TABLE city ("id" BIGINT NOT NULL PRIMARY KEY, "dept_id" BIGINT REFERENCES dept)')
    run.executeUpdate('CREATE TABLE fact ("id" BIGINT NOT NULL PRIMARY KEY, "city_id" BIGINT REFERENCES city, "round" INT)')
    db.close()
    return url


def held(spark, url):
    return {t: sorted(tuple(r) for r in spark.read.jdbc(url, t).collect()) for t in ("dept", "city", "fact")}


@pytest.mark.parametrize("together", [True, False])
def test_database_tables_are_replaced_in_a_transaction(spark, together):
    url = database(spark, f"load{together}")
    assert load.load_jdbc(spark, url, given(spark, 4), batch=7) == {"dept": 4, "city": 8, "fact": 20}
    old = held(spark, url)
    # the third table's rows refer to cities that are not there
    wrong = given(spark, 4) | {"fact": given(spark, 9)["fact"]}
    wrong["dept"] = wrong["dept"].withColumn("nombre", F.lit("other"))
    if together:
        with pytest.raises(LoadError, match="rolled back"):
            load.load_jdbc(spark, url, wrong)
        assert held(spark, url) == old
        with pytest.raises(LoadError, match="rolled back"):
            load.load_jdbc(spark, url, given(spark, 5, bad=True))
        assert held(spark, url) == old
        assert load.load_jdbc(spark, url, given(spark, 5))["fact"] == 25
        assert {r[2] for r in held(spark, url)["fact"]} == {5}
    else:
        with pytest.raises(LoadError, match="rolled back"):  # the old facts still refer to the rows of the first table
            load.load_jdbc(spark, url, wrong, together=False)
        assert held(spark, url) == old
        only = {"fact": given(spark, 4)["fact"].limit(3)}
        assert load.load_jdbc(spark, url, only, together=False) == {"fact": 3} and held(spark, url)["city"] == old["city"]
    db = load._connection(spark, url, {})
    left = db.getMetaData().getTables(None, "APP", None, None)
    names = set()
    while left.next():
        names.add(left.getString("TABLE_NAME"))
    db.close()
    assert names == {"DEPT", "CITY", "FACT"}


def test_a_new_table_and_plain_names(spark):
    url = "jdbc:derby:memory:fresh;create=true"
    assert load.load_jdbc(spark, url, {"kinds": spark.range(3)}) == {"kinds": 3}
    assert load.load_jdbc(spark, url, {"kinds": spark.range(2)}) == {"kinds": 2} and spark.read.jdbc(url, "kinds").count() == 2
    with pytest.raises(LoadError, match="plain name"):
        load.load_jdbc(spark, url, {"kinds; DROP": spark.range(3)})


def test_database_ranges_of_like_size(spark):
    """A crowd of close keys, a hot key, far ones, negative ones and rows without a key."""
    rows = [(k, f"r{k}") for k in [*range(0, 900), *[10**9] * 250, -(10**12), 10**12, *range(5 * 10**6, 5 * 10**6 + 10**7, 10**6)]] + [(None, "none")] * 5
    url = "jdbc:derby:memory:ranges;create=true"
    spark.createDataFrame(rows, "k bigint, v string").write.jdbc(url, "t")
    read = readers.jdbc_ranges(spark, url, "t", '"k"', rows=100, ways=8)
    assert sorted(map(str, (tuple(r) for r in read.collect()))) == sorted(map(str, rows))
    sizes = [r[1] for r in read.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) == 250 and sorted(sizes)[-2] <= 100 and read.rdd.getNumPartitions() < 60
    spark.createDataFrame([], "k bigint, v string").write.jdbc(url, "nothing")
    assert readers.jdbc_ranges(spark, url, "nothing", '"k"').collect() == []
    spark.createDataFrame([(None, "a"), (None, "b")], "k bigint, v string").write.jdbc(url, "keyless")
    assert readers.jdbc_ranges(spark, url, "keyless", '"k"').count() == 2
