"""Set-similarity joins by rare words, and residual duplicates, against plain Python over all pairs."""

import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from sendero.operators import match

SCHEMA = "entidad_id long, nombre string, tipo string, subtipo string, municipio string, departamento string, total_registros long"


def words_of(rng, hot):
    rare = [f"W{int(rng.paretovariate(0.6))}" for _ in range(rng.randint(0, 6))]
    return " ".join([hot] * (rng.random() < 0.9) + rare + [str(rng.randint(1, 5))] * (rng.random() < 0.3))


def scored(kind, x, y):
    a, b = {*x.split()}, {*y.split()}
    if not a or not b:
        return 0.0
    if kind == "overlap":
        return len(a & b) / max(len(a), len(b))
    m, n = {*re.findall(r"\d+", x)}, {*re.findall(r"\d+", y)}
    return len(a & b) / len(a | b) * (0.5 if m and n and not m & n else 1)


@pytest.mark.parametrize("kind,least", [("jaccard", 0.6), ("overlap", 0.7), ("overlap", 0.5)])
def test_best_matches_against_all_pairs(spark, kind, least):
    rng = random.Random(11)
    names = [(i, words_of(rng, "JUZGADO")) for i in range(300)]
    registry = [(i, words_of(rng, "JUZGADO")) for i in range(250)] + [(900, names[0][1]), (901, "DE"), (902, "")]
    bonus = F.when(F.col("id") % 4 == F.col("rid") % 4, 0.2).otherwise(0.0) if kind == "overlap" else None
    score = match.jaccard if kind == "jaccard" else lambda a, b, x, y: match.overlap(a, b)
    got = {r.id: (r.rid, round(r.score, 9)) for r in match.best_matches(spark.createDataFrame(names, "id long, norm string"), spark.createDataFrame(registry, "rid long, rnorm string"), score, least, bonus).collect()}
    want = {}
    for i, x in names:
        same = [r for r, y in registry if x == y]
        ranked = [(1.0, -min(same))] if same else [(s + (0.2 if kind == "overlap" and i % 4 == r % 4 else 0), -r) for r, y in registry if (s := scored(kind, x, y)) >= least and {*x.split()} & {*y.split()}]
        if ranked:
            s, r = max(ranked)
            want[i] = (-r, round(s, 9))
    assert got == want and len(want) > 50


def test_a_word_in_every_name_adds_no_pairs(spark):
    def found(n, hot):
        side = spark.range(n).select("id", F.array(*[F.lit(h) for h in hot], F.concat(F.lit("A"), F.col("id") % (n // 2)), F.concat(F.lit("B"), "id"), F.concat(F.lit("C"), "id")).alias("a"))
        other = side.withColumnsRenamed({"id": "rid", "a": "b"})
        return match.candidates(side, other, 0.7).count()

    assert found(400, ["DE"]) <= found(400, []) == 400
    assert found(800, ["DE"]) <= 800


def test_words_that_all_lists_consist_of(spark):
    """Nothing but frequent words: every pair shares them and is found."""
    side = spark.range(30).select("id", F.array(F.lit("DE"), F.lit("LA")).alias("a"))
    assert match.candidates(side, side.withColumnsRenamed({"id": "rid", "a": "b"}), 0.7).count() == 900
    none = side.limit(0)
    assert match.candidates(none, side.withColumnsRenamed({"id": "rid", "a": "b"}), 0.7).count() == 0


def entities():
    rng = random.Random(4)
    cities = ["TUNJA", "PASTO", "CALI", "NEIVA"]
    rows, i = [], 0
    for kind, base in (("ALCALDIA", "ALCALDIA MUNICIPAL DE {}"), ("GOBERNACION", "GOBERNACION DEL DEPARTAMENTO DE {}"), ("SECRETARIA", "SECRETARIA DE HACIENDA DE {}"), ("JUZGADO", "JUZGADO {o} {s} DE {}"), ("OTRO", "COSA DE {}"), ("CAR", "CORPORACION AUTONOMA DE {}")):
        for city in cities:
            for _ in range(14 if kind == "JUZGADO" else 6):
                i += 1
                name = base.replace("{}", city).replace("{o}", rng.choice(["PRIMERO", "SEGUNDO", "003", ""])).replace("{s}", rng.choice(["CIVIL MUNICIPAL", "PENAL MUNICIPAL", "CIVIL CIRCUITO"]))
                at = rng.randrange(len(name))
                name = rng.choice([name, name[:at] + "X" + name[at:], name[:at] + name[at + 1 :], f"{name} SECCIONAL", f"{name} {rng.randint(1, 3)}"])
                rows.append((i, name, kind, rng.choice(["CIVIL", "PENAL"]) if kind == "JUZGADO" else "", rng.choice([city, city, ""]), rng.choice(["A", ""]), rng.randint(1, 60)))
    return rows


def test_residual_duplicates_of_all_types_against_plain_python(spark):
    """Row by row, with courts and with all types; only pairs within reach go to the Python function."""
    rows = entities()
    ents = spark.createDataFrame(rows, SCHEMA)
    told = {r.entidad_id: r for r in ents.select("*", match.norm_suggest(F.col("nombre")).alias("norm"), match.key_words(F.col("nombre")).alias("words"), match.court_ordinal(F.col("nombre")).alias("ordinal"), match.court_subtype_key(F.col("nombre")).alias("clave")).collect()}
    ratio = lambda a, b: SequenceMatcher(None, a, b).ratio()
    want, asked = {}, 0
    for c in told.values():
        best = []
        for p in told.values():
            if c.tipo == "OTRO" or c.tipo != p.tipo or p.total_registros <= c.total_registros or len({*c.words}) < 2:
                continue
            a, b = {*c.words}, {*p.words}
            if not a & b or len(a & b) / max(len(a), len(b)) < 0.5 or any(x and y and x != y for x, y in ((c.municipio, p.municipio), (c.departamento, p.departamento))):
                continue
            court = c.tipo == "JUZGADO"
            x, y = ({*re.findall(r"\d+", r.norm)} for r in (c, p))
            if court and (x and y and x != y or None not in (c.ordinal, p.ordinal) and c.ordinal != p.ordinal):
                continue
            need = 0.88 if court else 0.80 if c.tipo in ("ALCALDIA", "MUNICIPIO", "GOBERNACION") else 0.82
            if min(len(c.norm), len(p.norm)) / max(len(c.norm), len(p.norm)) < need * 0.85:
                continue
            asked += 1
            if court and c.clave and p.clave and ratio(c.clave, p.clave) < 0.7:
                continue
            if (s := ratio(c.norm, p.norm)) >= need:
                best.append((s, p.total_registros, -p.entidad_id))
        if best:
            s, _, p = max(best)
            want[c.entidad_id] = (-p, c.tipo, round(s, 3), "alta" if s >= 0.92 else "media" if s >= 0.85 else "baja")
    found = match.residual_duplicates(ents).collect()
    got = {r.child_id: (r.parent_id, r.child_tipo, r.similitud, r.confianza) for r in found}
    assert got == want and len(found) == len(want) and {v[1] for v in want.values()} >= {"JUZGADO", "ALCALDIA", "SECRETARIA"}
    pairs = match.residual_candidates(ents)
    assert pairs.count() == asked and match.within_reach(pairs).count() < asked


def test_the_bound_holds(spark):
    rng = random.Random(8)
    rows = [("".join(rng.choice("AB CÑ9é.") for _ in range(rng.randint(0, 12))), "".join(rng.choice("AB CÑ9é.") for _ in range(rng.randint(0, 12)))) for _ in range(300)]
    frame = spark.createDataFrame(rows, "a string, b string")
    bound = match.most_ratio(F.col("a"), F.col("b"), match.letter_counts(F.col("a")), match.letter_counts(F.col("b")))
    for r in frame.withColumn("bound", bound).collect():
        assert r.bound >= SequenceMatcher(None, r.a, r.b).ratio() - 1e-9
