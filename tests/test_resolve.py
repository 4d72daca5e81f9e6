"""Clusters and nearest names against plain Python that compares all pairs; the number tables by hand."""

import random

import pytest
from pyspark.sql import functions as F

from sendero.functions import text
from sendero.operators import resolve


def ratio(a, b):
    """1 - distance / longer length; 0 if one is empty or lengths differ by more than 40 %."""
    if not a or not b:
        return float(a == b)
    longer = max(len(a), len(b))
    if abs(len(a) - len(b)) / longer > 0.4:
        return 0.0
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return 1 - row[-1] / longer


def changed(r, word):
    letters = list(word)
    for _ in range(r.randint(0, 3)):
        at, kind = r.randint(0, len(letters)), r.random()
        if kind < 0.6 or not letters:
            letters.insert(at, r.choice("ABC"))
        else:
            letters.pop(min(at, len(letters) - 1))
    return "".join(letters)


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_against_all_pairs(spark, seed):
    r = random.Random(seed)
    rows = []
    for block, kind in (("a", "JUZGADO"), ("b", "CAR"), ("c", "GOBERNACION")):
        bases = ["".join(r.choice("ABC") for _ in range(r.randint(0, 14))) for _ in range(8)]
        for k in range(60):
            core = changed(r, r.choice(bases))
            rows.append((f"{block}{k}", core, r.choice([core + "X", "", "AAB"]), 100 - k, kind, block))
    want = {}
    for block in "abc":
        anchors = []
        for raw, core, clean, _, kind, b in rows:
            if b != block:
                continue
            near = [i for i, (x, y) in enumerate(anchors) if (ratio(x, core) if x and core else ratio(y, clean)) >= resolve.THRESHOLDS[kind]]
            want[raw] = near[0] if near else len(anchors)
            if not near:
                anchors.append((core, clean))
    named = spark.createDataFrame(rows, "raw string, core string, clean string, n long, tipo string, b string")
    out = resolve.anchor_clusters(named, ["b"], [F.desc("n")])
    assert out.columns == [*named.columns, "cluster"]
    assert {x.raw: x.cluster for x in out.collect()} == want


def greedy(rows):
    """Clusters in order, each name compared with every anchor of its block."""
    want, anchors = {}, {}
    for raw, core, clean, _, kind, b in rows:
        of = anchors.setdefault(b, [])
        near = [i for i, (x, y) in enumerate(of) if (ratio(x, core) if x and core else ratio(y, clean)) >= resolve.THRESHOLDS[kind]]
        want[raw] = near[0] if near else len(of)
        if not near:
            of.append((core, clean))
    return want


@pytest.mark.parametrize("width,crowd", [(3, 100), (4, 1), (7, 0)])
def test_batches_against_all_pairs(spark, monkeypatch, width, crowd):
    """Many batches, also such as are cut down; a crowd of alike names, strangers, and names without a core."""
    monkeypatch.setattr(resolve, "WIDTH", width)
    monkeypatch.setattr(resolve, "CROWD", crowd)
    r = random.Random(width)
    rows = []
    for block, kind in (("a", "JUZGADO"), ("b", "CAR")):
        bases = ["".join(r.choice("ABC") for _ in range(r.randint(0, 14))) for _ in range(6)]
        for k in range(70):
            core = changed(r, bases[0] if k > 20 and r.random() < 0.6 else r.choice(bases)) if r.random() < 0.85 else ""
            rows.append((f"{block}{k}", core, r.choice([core + "X", "", "AAB", "AABB"]), 100 - k, kind, block))
    named = spark.createDataFrame(rows, "raw string, core string, clean string, n long, tipo string, b string")
    assert {x.raw: x.cluster for x in resolve.anchor_clusters(named, ["b"], [F.desc("n")]).collect()} == greedy(rows)


def test_a_crowd_of_alike_names_is_compared_in_proportion(spark, monkeypatch):
    """Ten times the names of one dense block: at most about ten times the pairs that are verified."""
    compared = []
    similar = resolve._similar

    def counting(pairs):
        compared.append(pairs.count())
        return similar(pairs)

    monkeypatch.setattr(resolve, "_similar", counting)

    def run(n):
        r = random.Random(n)
        rows = []
        for k in range(n):
            word = list(r.choice(["CIVIL MUNICIPAL PEQUENAS CAUSAS TERCERO", "PENAL DEL CIRCUITO ESPECIALIZADO QUINTO", "LABORAL DE DESCONGESTION SEGUNDO TURNO"]))
            for _ in range(2):
                word[r.randrange(len(word))] = r.choice("ABCDEFGH")
            rows.append((f"n{k}", "".join(word), "", n - k, "JUZGADO", "b"))
        compared.clear()
        named = spark.createDataFrame(rows, "raw string, core string, clean string, n long, tipo string, b string")
        got = {x.raw: x.cluster for x in resolve.anchor_clusters(named, ["b"], [F.desc("n")]).collect()}
        return got, greedy(rows) if n <= 400 else None, sum(compared)

    got, want, few = run(400)
    assert got == want
    got, _, many = run(4000)
    assert len(got) == 4000 and many <= 14 * few and many < 40 * 4000 * 3


def test_a_chain_of_neighbours_and_an_empty_table(spark):
    words = ["A" * k + "B" * (20 - k) for k in range(21)]
    rows = [(w, w, w, 100 - k, "GOBERNACION", "x") for k, w in enumerate(words)]
    named = spark.createDataFrame(rows, "raw string, core string, clean string, n long, tipo string, b string")
    assert {x.raw: x.cluster for x in resolve.anchor_clusters(named, ["b"], [F.desc("n")]).collect()} == {w: k // 3 for k, w in enumerate(words)}
    assert resolve.anchor_clusters(named.limit(0), ["b"], [F.desc("n")]).collect() == []


def test_nearest_against_all_pairs(spark):
    r = random.Random(3)
    names = list(dict.fromkeys("".join(r.choice("ABCD") for _ in range(r.randint(1, 12))) for _ in range(200)))
    parts = list(dict.fromkeys("".join(r.choice("ABCD") for _ in range(r.randint(0, 12))) for _ in range(200)))
    want = {}
    for p in parts:
        score, _, name = max((ratio(p, n), -i, n) for i, n in enumerate(names))
        if len(p) >= 3 and score >= 0.7:
            want[p] = (name, round(score, 9))
    out = resolve.nearest(spark.createDataFrame([(p,) for p in parts], "part string"), spark.createDataFrame([(n, i) for i, n in enumerate(names)], "norm string, ord int"))
    assert {x.part: (x.norm, round(x.ratio, 9)) for x in out.collect()} == want


def test_number_tables_by_hand(spark):
    told = {
        "JUZGADO OCHENTA Y CINCO": ("JUZGADO 85", 80), "JUZGADO OCHENTA Y TRES CIVIL": ("JUZGADO 83 CIVIL", 83), "JUZGADO SETENTA Y UN": ("JUZGADO 71", 70), "JUZGADO SESENTA Y UN": ("JUZGADO 61", 61),
        "JUZGADO DECIMO TERCERO": ("JUZGADO 13", 10), "JUZGADO VIGESIMO NOVENO": ("JUZGADO 29", 29), "JUZGADO NOVENTA": ("JUZGADO 90", 90), "JUZGADO SETIMO": ("JUZGADO SETIMO", 7), "JUZGADO 2DA": ("JUZGADO 2", None),
    }
    rows = spark.createDataFrame([(t,) for t in told], "x string").select("x", text.replace_ordinals(F.col("x")).alias("o"), text.court_ordinal(F.col("x")).alias("c"))
    assert {x.x: (x.o, x.c) for x in rows.collect()} == told
