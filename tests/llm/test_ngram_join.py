import random
import re

import numpy as np
import pytest

from sendero.llm import ngram_join


def sets_of(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, num, den):
    sets = [(i, sets_of(t, k)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (i, p) in enumerate(sets):
        for y, (j, q) in enumerate(sets[:x]):
            if p and q and i is not None and j is not None and den * len(p & q) >= num * len(p | q):
                parent[root(x)] = root(y)
    least = {}
    for x, (i, p) in enumerate(sets):
        if i is not None:
            least[root(x)] = min(least.get(root(x), i), i)
    return sorted(((i, len(p), least[root(x)] if p and i is not None else i) for x, (i, p) in enumerate(sets)), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 3000}"
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(60):
        base = [word() for _ in range(rng.choice([2, 3, 5, 20, 80, 200]))]
        if rng.random() < 0.5:
            base[3:3] = passage
        for _ in range(rng.choice([1, 1, 2, 9])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy) if rng.random() < 0.8 else "\t".join(copy).upper())
    hub = [word() for _ in range(150)]
    for _ in range(120):
        copy = list(hub)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(len(copy))] = word()
        rows.append(" ".join(copy))
    rows += ["", " \n", None, "one", "One", "one two", "a b c", "a b c"]
    rng.shuffle(rows)
    return list(enumerate(rows)) + [(None, rows[0]), (5, rows[5])]


@pytest.mark.parametrize(("k", "num", "den"), [(3, 90, 100), (5, 4, 5)])
def test_against_all_pairs(spark, k, num, den):
    rows = corpus(k)
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id bigint, text string, key int").repartition(5)
    for known in (2_000_000, 50):
        out = ngram_join.near_duplicates(docs, k=k, num=num, den=den, known=known).collect()
        assert sorted(((r.id, r.n_shingles, r.component_id) for r in out), key=str) == brute(rows, k, num, den)


def spread(seed, copies, most):
    """Copies of one text that differ from each other about as much as a link allows, some with edits in common."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    edits = [(rng.randrange(120), f"e{i}") for i in range(60)]
    rows = []
    for _ in range(copies):
        copy = list(base)
        for _ in range(rng.randrange(1, most)):
            at, word = rng.choice(edits) if rng.random() < 0.7 else (rng.randrange(120), f"r{rng.random()}")
            copy[at] = word
        rows.append(" ".join(copy[: rng.choice([120, 120, 118, 109])]))
    return list(enumerate(rows))


@pytest.mark.parametrize(("k", "num", "den", "most", "small"), [(3, 90, 100, 9, 64), (5, 4, 5, 12, 4), (1, 1, 2, 90, 2)])
def test_large_group_without_a_centre(spark, monkeypatch, k, num, den, most, small):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    rows = spread(k, 300, most)
    rows += [(1000 + i, t) for i, t in spread(k + 7, 40, 4)]
    out = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), k=k, num=num, den=den).collect()
    found = sorted(((r.id, r.n_shingles, r.component_id) for r in out), key=str)
    assert found == brute(rows, k, num, den)
    assert len({c for _, _, c in found}) > 20


def test_deviation_prefixes_lose_no_link():
    rng = random.Random(4)
    for _ in range(20_000):
        num, den = rng.choice([(9, 10), (4, 5), (1, 2)])
        universe = range(rng.choice([20, 60]))
        c = set(rng.sample(universe, rng.randrange(5, len(universe))))
        x, y = (c ^ set(rng.sample(universe, min(len(universe), int(rng.paretovariate(0.6))))) for _ in range(2))
        linked = lambda p, q: den * len(p & q) >= num * len(p | q)
        if not x or not y or not linked(x, y) or (linked(x, c) and linked(y, c)):
            continue
        cut = []
        for p in (x, y):
            order = sorted(p ^ c)
            short, long = ngram_join.deviation_prefixes(len(order), len(p), len(c), num, den)
            cut.append((set(order[:short]), set(order[: short if linked(p, c) else max(short, long)])))
        (sx, lx), (sy, ly) = cut
        assert sx & ly if linked(x, c) else lx & sy if linked(y, c) else sx & sy


def test_long_words_that_agree_in_every_power_sum(spark):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(0, one[:1024]), (1, other[:1024]), (2, one), (3, other), (4, f"{one} x"), (5, f"{one} x"), (6, "a" * 8 + "b"), (7, "a" * 9)]
    out = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.id: r.component_id for r in out} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert ngram_join.near_duplicates(docs).count() == 0
    assert {(r.id, r.component_id) for r in ngram_join.near_duplicates(spark.createDataFrame([(4, "a"), (5, "")], "doc_id bigint, text string")).collect()} == {(4, 4), (5, 5)}


def slotted(n, seed=9, slots=40):
    """Documents of slots, each with one of two passages of ten words; nothing links."""
    rng = random.Random(seed)
    passages = [[" ".join(f"w{s}v{v}x{i}" for i in range(10)) for v in range(2)] for s in range(slots)]
    return [(i, " ".join(rng.choice(passages[s]) for s in range(slots))) for i in range(n)]


def test_templates_of_frequent_passages_give_few_pairs(spark, monkeypatch):
    """Twice the documents at most double the pairs that are verified, and the result is that of all pairs."""
    counted = []
    own = ngram_join.written

    def written(df, name, *more):
        made = own(df, name, *more)
        if name == "pairs":
            counted.append(made.count())
        return made

    monkeypatch.setattr(ngram_join, "written", written)

    def run(rows):
        counted.clear()
        out = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), k=3, num=90, den=100)
        return {r.id: r.component_id for r in out.collect()}, sum(counted)

    few, rows = run(slotted(300))[1], slotted(600)
    got, many = run(rows)
    assert many <= max(2 * few, 600) and got == {i: i for i, _ in rows}
    # one slot of forty changed: links, among all the others that do not
    words = rows[0][1].split(" ")
    near = [(1000 + j, " ".join([*words[: 10 * j], *(f"z{j}y{i}" for i in range(10)), *words[10 * j + 10 :]])) for j in range(5)]
    got, _ = run([*rows[:200], *near])
    sets = {i: {tuple(t.split(" ")[k : k + 3]) for k in range(398)} for i, t in [*rows[:200], *near]}
    linked = {i for i in sets if 100 * len(sets[i] & sets[0]) >= 90 * len(sets[i] | sets[0])}
    assert {i for i, c in got.items() if c == 0} >= linked and len(linked) == 6


def test_sketches_never_differ_in_more_than_the_sets(spark):
    rng = np.random.default_rng(3)
    universe = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    for size in (0, 1, 50, 2000):
        a, b = (rng.choice(universe, size, replace=False) for _ in range(2))
        bits = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(ngram_join.sketch(a), ngram_join.sketch(b), strict=True))
        assert bits <= len(set(a.tolist()) ^ set(b.tolist()))
        assert ngram_join.sketch(a) == ngram_join.sketch(a[::-1])


def rows_joined(spark, on):
    """Rows that the inner joins on columns `on` have made in this session so far, by Spark's own count."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store = spark._jsparkSession.sharedState().statusStore()
    all_of = lambda seq: [seq.apply(i) for i in range(seq.size())]
    total = 0
    for ran in all_of(store.executionsList()):
        metrics = store.executionMetrics(ran.executionId())
        for node in all_of(store.planGraph(ran.executionId()).allNodes().toSeq()):
            if re.match(r"\w+Join \[" + ", ".join(rf"{c}#\d+L?" for c in on) + r"\].* Inner", node.desc()):
                counted = [metrics.get(m.accumulatorId()) for m in all_of(node.metrics().toSeq()) if m.name() == "number of output rows"]
                total += sum(int(c.get().replace(",", "")) for c in counted if c.isDefined())
    return total


def test_large_lists_are_joined_once(spark, monkeypatch):
    """Large lists joined with their groups give a row for each shingle of a 1-prefix and band at most, however large the group."""
    monkeypatch.setattr(ngram_join, "SMALL", 2)
    made, room = [], []
    for copies in (100, 200):
        rows, before = spread(3, copies, 9), rows_joined(spark, ["tok", "g"])
        out = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), k=3, num=90, den=100).collect()
        assert sorted(((r.id, r.n_shingles, r.component_id) for r in out), key=str) == brute(rows, 3, 90, 100)
        made.append(rows_joined(spark, ["tok", "g"]) - before)
        room.append(sum(2 * (n - -(-90 * n // 100) + 1) for n in (len(s) for s in {frozenset(sets_of(t, 3)) for _, t in rows})))
    assert 0 < made[0] and made[1] <= 1.2 * room[1] and made[1] <= 2.5 * made[0]
