import random
import re

from pyspark.sql import functions as F

from sendero.llm.decontaminate import contamination, covered


def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items):
    out = []
    for i, t in docs:
        w, hit, found = words_of(t), set(), set()
        for j, item in items:
            v = words_of(item)
            k = min(len(v), 10)
            grams = {tuple(v[p : p + k]) for p in range(len(v) - k + 1)} if k else set()
            for p in range(len(w) - k + 1 if k else 0):
                if tuple(w[p : p + k]) in grams:
                    hit |= set(range(p, p + k))
                    found.add(j)
        out.append((i, len(w), len(hit), sorted(x for x in found if x is not None)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["ab", "Cd", "éf", "9", "gh", "ij", "kl"]) + rng.choice(["", "x", "y"])
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(word() for _ in range(n))
    items = [(j, text(n)) for j, n in enumerate([30, 12, 10, 9, 3, 2, 14, 40])] + [(None, text(15)), (3, text(11)), (50, ""), (51, None), (52, "ab " * 20)]
    docs = [(i, text(rng.randrange(80))) for i in range(150)]
    for i in range(0, 150, 3):
        v = items[i % 8][1]
        docs[i] = (i, docs[i][1] + " " + v[rng.randrange(5) :].upper() + "; " + docs[i][1])
    docs += [(1, None), (None, items[0][1]), (2, ""), (3, "ab " * 3000)]
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, h string").repartition(3)
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, h string")
    got = sorted(((r.id, r.n_words, r.hit, sorted(r["items"])) for r in contamination(d, b).withColumn("hit", covered()).collect()), key=str)
    assert got == brute(docs, items)
    none = contamination(d, b.limit(0)).agg(F.sum(F.size("spans"))).first()[0]
    assert none == 0 and contamination(d.limit(0), b).count() == 0
