import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sendero.llm import exact_dedup as index
from sendero.llm.exact_dedup import FANIN, Levels, exact_dedup, flushed

ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "c" * 100_000), (7, "c" * 100_000), (None, "b"), (8, "d"), (8, "d"), (None, None), (9, "e"), (None, "z")]


def brute(keep):
    groups = {}
    for i, t in ROWS:
        groups.setdefault(t or "", []).append(i)
    best = {t: (max if keep == "largest" else min)((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, best[t or ""], len(groups[t or ""]), i == best[t or ""]) for i, t in ROWS), key=str)


def test_groups(spark):
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in ROWS], "doc_id bigint, text string, digest string, n int").repartition(4)
    weak = F.unhex(F.rpad(F.hex((F.crc32(F.coalesce("text", F.lit(""))) % 2).cast("string")), 64, "0"))
    for keep in ("largest", "smallest"):
        for key in (None, weak):
            out = exact_dedup(docs, keep=keep, key=key).collect()
            assert sorted(((r.id, r.keep_id, r.group_size, r.kept) for r in out), key=str) == brute(keep)
    assert exact_dedup(docs.limit(0)).count() == 0


def entries(n, kinds, seed=1):
    rng = np.random.default_rng(seed)
    keys = np.zeros((n, 4), np.uint64)
    keys[:, 0] = rng.integers(0, 3, n) << 60 if kinds < 5 else rng.integers(0, 1 << 63, kinds).astype(np.uint64)[rng.integers(0, kinds, n)]
    keys[:, 3] = rng.integers(0, kinds, n) if kinds < 5 else 0
    return keys, rng.integers(-50, 1 << 40, n)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("kinds", [1, 4, 3000])
def test_levels_against_a_dictionary(keep, kinds):
    keys, ids = entries(20_000, kinds)
    levels, shipped = Levels(keep), []
    for i in range(0, len(ids), 90):
        levels.add(flushed(keys[i : i + 90], ids[i : i + 90], keep))
        assert all(len(level) < FANIN for level in levels.levels)
        shipped += levels.grown(2500)
    last = Levels(keep)
    for run in [*shipped, *levels.merged()]:
        last.add(run)
    (found,) = last.merged()
    want = {}
    for k, i in zip(map(tuple, keys.tolist()), ids.tolist(), strict=True):
        best, n = want.get(k, (i, 0))
        want[k] = ((max if keep == "largest" else min)(best, i), n + 1)
    assert [(tuple(k), (i, n)) for k, i, n in zip(*(x.tolist() for x in found[:3]), strict=True)] == sorted(want.items())
    assert last.merged() == []


def test_work_follows_the_entries():
    keys, ids = entries(160_000, 150_000)
    took = {}
    for runs in (100, 800):
        size = len(ids) // runs
        parts = [flushed(keys[i : i + size], ids[i : i + size], "largest") for i in range(0, len(ids), size)]
        began = time.process_time()
        levels = Levels("largest")
        for part in parts:
            levels.add(part)
        levels.merged()
        took[runs] = time.process_time() - began
    assert took[800] < 4 * took[100], took  # the square would be 64 times


def test_large_group_in_parts(spark, monkeypatch):
    monkeypatch.setattr(index, "PART", 8)
    monkeypatch.setattr(index, "SHIPPED", 10)
    rows = [(i, "same") for i in range(500)] + [(i, f"t{i % 700}") for i in range(500, 2000)] + [(None, "same")] * 40
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    out = exact_dedup(docs, keep="largest").collect()
    best = {}
    for i, t in rows:
        best.setdefault(t, []).append(i)
    want = sorted(((i, max(x for x in best[t] if x is not None), len(best[t])) for i, t in rows), key=str)
    assert sorted(((r.id, r.keep_id, r.group_size) for r in out), key=str) == want
