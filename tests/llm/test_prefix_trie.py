import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sendero.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
EMPTY = hashlib.sha256().hexdigest()


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            told = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, told, (role, text)))
    own = {c: [x[3] for x in sorted(t)] for c, t in convs.items()}
    made = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        made[c] = tuple(own.get(base, [])[:h] + t[h:])
    members = defaultdict(list)
    for c, t in made.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not kids[node]
        saved[node] += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    ends = {n: ",".join(map(str, sorted(c for c in m if len(made[c]) == len(n)))) for n, m in members.items()}
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n], hashlib.sha256(ends[n].encode()).hexdigest()) for n, m in members.items())


def nodes(frame, **more):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(frame, **more).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=lambda r: r[:2])


def conversations(seed, n=260, words=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 600), n):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 8, 12])):
            rows.append((c, turn, rng.choice(["user", "assistant", None]) if turn % 5 == 4 else "user", rng.choice(["hi", "é𝒳", "", None, "longer text"][:words])))
    rows += [(c, t, "user", "same") for c in range(1000, 1100) for t in range(7)]  # a large group of copies
    rows += [(1200, t, "user", f"turn {t % 3}") for t in range(1500)] + [(1201, t, "user", f"turn {t % 3}") for t in range(1400)]
    rows += [(7, None, "user", "null turn"), (7, None, "user", "null turn"), (7, 1, "b", "tie"), (7, 1, "a", "tie"), (None, 0, "user", "nobody"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,fan", [(1, 256), (2, 2)])
def test_nodes_against_plain_python(spark, seed, fan):
    rows = conversations(seed, words=seed + 2)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("depth", F.lit(1)).withColumn("conv", F.lit("x")).withColumn("k1", F.lit(0))
    assert nodes(frame, fan=fan) == brute(rows)


def test_dealt_over_many_small_tasks(spark, monkeypatch):
    """One conversation of a third of all turns crosses partitions; all joins are shuffled and salted."""
    rows = conversations(9)
    monkeypatch.setattr(prefix_trie, "broadcast_if_small", lambda df, *_: df)
    spread = prefix_trie.spread_join
    monkeypatch.setattr(prefix_trie, "spread_join", lambda a, b, on, by, n: spread(a, b, on, by, 1 << 40, salts=3))
    monkeypatch.setattr(prefix_trie, "STRIDE", 100)
    monkeypatch.setattr(prefix_trie, "PIECE", 60)
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert nodes(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_few_and_no_conversations(spark):
    assert nodes(spark.createDataFrame([], SCHEMA)) == []
    assert nodes(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)) == []
    for rows in ([(5, 0, "u", "x")], [(0, 0, "u", "x" * 300_000)], [(300, 0, "u", "a"), (300, 1, "u", "b"), (301, 0, "u", "a")]):
        assert nodes(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_a_key_shared_by_two_sequences_is_an_error(spark, monkeypatch):
    keys = prefix_trie._keys

    def flat(batch):
        halves, kept = keys(batch)
        none = [np.zeros_like(x) for x in halves]
        return none, [*none, *kept[2:]]

    monkeypatch.setattr(prefix_trie, "_keys", flat)
    rows = [(100, 0, "u", "a"), (200, 0, "u", "b")]
    with pytest.raises(Exception, match="share a key"):
        nodes(spark.createDataFrame(rows, SCHEMA))
