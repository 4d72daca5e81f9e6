import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sendero.llm import url_filter

SCHEMA = "page_id bigint, url string, html string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    low = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in host)
    return low, re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]


def ruling(host, path, rules):
    found = []
    for rule, verdict in rules:
        to = rule.split("/")[0].lower()
        if to and (host == to or host.endswith("." + to)) and path.startswith(rule[len(to) :]):
            found.append((len(rule), len(to), verdict == "block", rule, verdict))
    return max(found)[3:] if found else None


def ranked(seeds, edges, rounds):
    rank = defaultdict(int, {h: 15 * s // 100 for h, s in seeds.items()})
    for _ in range(rounds):
        came = defaultdict(int)
        for src, dsts in edges.items():
            for d in dsts:
                came[d] += rank[src] // len(dsts)
        rank = defaultdict(int, {h: (15 * seeds.get(h, 0) + 85 * came[h]) // 100 for h in {*seeds, *came}})
    return rank


def brute(rows, rules, links, rounds=url_filter.ROUNDS):
    out, good, bad = [], defaultdict(int), defaultdict(int)
    for i, url, _ in rows:
        host, path = split(url)
        found = ruling(host, path, rules)
        out.append([i, host, path, *(found or (None, None))])
        if found:
            good[host] += found[1] == "allow"
            bad[host] += found[1] == "block"
    seeds = {h: (10**9 * good[h] // (good[h] + bad[h]), 10**9 * bad[h] // (good[h] + bad[h])) for h in good}
    forth, back = defaultdict(set), defaultdict(set)
    for (_, url, _), targets in zip(rows, links, strict=True):
        for t in targets:
            if split(url)[0] and split(url)[0] != t:
                forth[split(url)[0]].add(t)
                back[t].add(split(url)[0])
    trust, distrust = ranked({h: s[0] for h, s in seeds.items()}, forth, rounds), ranked({h: s[1] for h, s in seeds.items()}, back, rounds)
    for r in out:
        t, d = trust[r[1]], distrust[r[1]]
        r[4] = r[4] or ("block" if t + d and 100 * t < 50 * (t + d) else "allow")
        r += [t, d]
    return sorted(out, key=str)


def linked(rng, hosts):
    """html and the hosts that it links."""
    targets = rng.sample(hosts, rng.randint(0, 3))
    shapes = ["<a href='http://{}/x'>", '<A class=z HREF="//{}">', "<area\nhref=https://{}?q>", '<a rel="b" href = "HTTPS://{}#f">']
    html = "".join(rng.choice(shapes).format(t.upper() if rng.random() < 0.3 else t) for t in targets)
    return f"<!-- <a href='http://{rng.choice(hosts)}'> --><script>'<a href=http://{rng.choice(hosts)}>'</script><p>http://{rng.choice(hosts)}</p><a href='/own'>{html}", targets


def test_rules_and_graph_against_plain_python(spark):
    rng = random.Random(5)
    hosts = [f"{p}h{i}.{t}" for i in range(12) for p in ("", "www.") for t in ("net", "com", "org")]
    made = [linked(rng, hosts) for _ in range(400)]
    # a host with a third of the pages
    urls = [f"http://{hosts[0] if rng.random() < 0.3 else rng.choice(hosts)}/{rng.choice(['fr/1', 'de/2', 'en/3', ''])}{rng.choice(['', '?a', '#b/c'])}" for _ in made]
    rows = [(i, u, h) for i, (u, (h, _)) in enumerate(zip(urls, made, strict=True))]
    rows += [(None, None, "x"), (3, "no scheme", None), (3, "http://H3.COM", None), (4, "ftp://h1.net//a://b/?x", ""), (5, "http://h2.com/fr/" + "x" * 50000, "<a href='http://h3.net'>" + "y" * 100000)]
    links = [t for _, t in made] + [[], [], [], [], ["h3.net"]]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("host", F.lit(1)).withColumn("rule", F.lit(2)).withColumn("id", F.lit(3))
    rules = [("org/", "allow"), ("com/fr/", "allow"), ("com/de/", "block"), ("h3.com", "block"), ("h5.net/", "allow"), ("www.h5.net/", "block")]
    want = brute(rows, rules, links)
    assert sum(r[3] is None and r[4] == "block" for r in want) > 10 and sum(r[3] is None and r[5] > 0 for r in want) > 30
    assert sorted((list(r) for r in url_filter.judge(pages, rules).collect()), key=str) == want
    few = brute(rows, rules, links, 2)
    assert sorted((list(r) for r in url_filter.judge(pages, rules, rounds=2, most=1).collect()), key=str) == few


def test_large_tables_are_joined_by_salt(spark, monkeypatch):
    rng = random.Random(6)
    hosts = [f"h{i}.net" for i in range(9)]
    made = [linked(rng, hosts) for _ in range(120)]
    rows = [(i, f"http://{rng.choice(hosts[:3])}/{rng.choice('ab')}/{i}", h) for i, (h, _) in enumerate(made)]
    rules = [(f"h{i}.net/{c}/{k}", "block" if k % 2 else "allow") for i in range(2) for c in "ab" for k in range(1, 10)]
    want = brute(rows, rules, [t for _, t in made])
    monkeypatch.setattr(url_filter.F, "broadcast", lambda df: pytest.fail("broadcast"))
    monkeypatch.setattr(url_filter, "broadcast_if_small", lambda df, *_: df)
    monkeypatch.setattr(url_filter, "BROADCAST", 0)
    assert sorted((list(r) for r in url_filter.judge(spark.createDataFrame(rows, SCHEMA), rules, most=5).collect()), key=str) == want


@pytest.mark.parametrize("n", [0, 2])
def test_empty_table_and_no_rules(spark, n):
    rows = [(1, "http://a.net/", "<a href='//b.net'>"), (2, None, None)][:n]
    got = url_filter.judge(spark.createDataFrame(rows, SCHEMA), [], unknown="block")
    assert sorted((r.id, r.rule, r.verdict) for r in got.collect()) == [(i, None, "block") for i, *_ in rows]


def test_unfinished_markup_takes_linear_time(spark):
    html = "<a " * 200_000 + "<!-- " * 200_000
    assert url_filter.host_edges(spark.createDataFrame([("h", html)], "host string, html string")).count() == 0
