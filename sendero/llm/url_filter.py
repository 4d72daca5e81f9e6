"""Verdicts on URLs: rules first, and for what no rule names the link graph of the hosts.

A rule is a host, from its first slash on a path, and a verdict. It fits pages of that host and of its subdomains whose path
starts with the rule's; the longest rule wins (then that of the longer host, then a block). Hosts whose pages rules
allow or block are the seeds of two propagations over the edges between hosts, each an integer personalised PageRank:
trust follows the links from allowed seeds, distrust runs against them from blocked ones. A host is blocked where less
than `threshold` per cent of what reached it is trust.

An edge is a pair of hosts with at least one `<a>` or `<area>` link (http, https or without a scheme) from a page of the
first to the second, outside comments, scripts and styles. A host gives each of its edges the same share. Scores are
integers of 1 / UNIT, shares are rounded down, so no result hangs on the order of sums; a fixed point ends the rounds
early and equals the last round.

No host's pages or edges meet in one task: hosts that many rows share are dealt by (host, salt), and the host tables repeat
a row once for each salt that occurs. Everything runs as DataFrame operations.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule, links to nothing and gets
`unknown`, as does a host that neither trust nor distrust reaches; null html has no links; null and repeated page_ids
are judged row by row; other columns are ignored; an empty table gives no rows; without rules all pages get `unknown`.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sendero.llm._common import broadcast_if_small, written

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
UNIT = 10**9
ROUNDS = 20
DAMPING = 85  # per cent
THRESHOLD = 50  # per cent of trust below which a host is blocked
SALTS = 64
BROADCAST = 64 << 20  # bytes of a host table up to which it is broadcast
MOST = 200  # rules of a host beyond which its paths are looked up by their beginnings
HOST, PATH = r"://([^/?#]*)", r"://[^/?#]*([^?#]*)"
UNSEEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
LINK = r"""(?i)<(?:a|area)\s[^<>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'<>\s]+)"""


def _low(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next / ? or #, A-Z in lower case; else empty."""
    return _low(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #."""
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def _salt(of: Column) -> Column:
    return F.pmod(F.xxhash64(of), F.lit(SALTS)).cast("int")


def rule_table(spark: SparkSession, rules: list[tuple[str, str]] | DataFrame) -> DataFrame:
    """rule, verdict -> rule_host, rule_path, won: a struct whose maximum is the rule that wins."""
    if isinstance(rules, list):
        rules = spark.createDataFrame(rules, "rule string, verdict string")
    cut = F.instr("rule", "/")
    host = _low(F.when(cut > 0, F.substring("rule", F.lit(1), cut - 1)).otherwise(F.col("rule")))
    path = F.when(cut > 0, F.substring("rule", cut, F.length("rule"))).otherwise("")
    won = F.struct(F.length("rule").alias("size"), F.length("rule_host").alias("host_size"), (F.col("verdict") == "block").alias("blocks"), "rule", "verdict")
    table = rules.filter(F.col("verdict").isin("allow", "block")).select("rule", "verdict", host.alias("rule_host"), path.alias("rule_path"))
    return table.filter("rule_host <> ''").select("rule_host", "rule_path", won.alias("won")).distinct()


def ruled_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """host, rule_host, rule_path, won: every rule whose host is the given one or above it."""
    n, labels = rules.agg(F.count("*"), F.coalesce(F.max(F.size(F.split("rule_host", r"\."))), F.lit(0))).first()
    own = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.least(F.size(own), F.lit(max(labels, 1)))), lambda k: F.array_join(F.slice(own, F.size(own) - k + 1, k), "."))
    return hosts.select("host", F.explode(above).alias("rule_host")).join(broadcast_if_small(rules, n, 512), "rule_host")


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst: distinct pairs of hosts that pages(host, html) link."""
    found = F.regexp_extract_all(F.regexp_replace("html", UNSEEN, " "), F.lit(LINK), F.lit(1))
    linked = pages.filter("host <> ''").select(F.col("host").alias("src"), F.explode(F.array_distinct(F.transform(found, _low))).alias("dst"))
    return linked.filter("src <> dst").distinct()


def propagated(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS, damping: int = DAMPING) -> DataFrame:
    """host, rank of the personalised PageRank from seeds(host, seed) along edges(src, dst), in integers."""
    edges = written(edges.select("src", "dst", _salt(F.col("dst")).alias("salt")), "edges")
    spread = edges.groupBy("src", "salt").agg(F.count("*").alias("n")).groupBy("src").agg(F.sum("n").alias("degree"), F.collect_list("salt").alias("salts"))
    hosts = seeds.select("host", "seed").unionByName(edges.select(F.col("dst").alias("host"), F.lit(0).cast("bigint").alias("seed")))
    state = hosts.groupBy("host").agg(F.sum("seed").alias("seed")).join(spread.withColumnRenamed("src", "host"), "host", "left")
    state = written(state.withColumn("rank", F.expr(f"({100 - damping} * seed) div 100")), "rank")
    for _ in range(0 if edges.isEmpty() else rounds):
        shares = state.filter("rank > 0 AND degree > 0").select(F.col("host").alias("src"), F.explode("salts").alias("salt"), F.expr("rank div degree").alias("share"))
        came = edges.join(shares, ["src", "salt"]).groupBy(F.col("dst").alias("host")).agg(F.sum("share").alias("came"))
        new = F.expr(f"({100 - damping} * seed + {damping} * coalesce(came, 0)) div 100")
        state = written(state.join(came, "host", "left").select("host", "seed", "degree", "salts", new.alias("rank"), (new != F.col("rank")).alias("moved")), "rank")
        if state.filter("moved").isEmpty():
            break
        state = state.drop("moved")
    return state.select("host", "rank")


def judge(pages: DataFrame, rules: list[tuple[str, str]] | DataFrame, threshold: int = THRESHOLD, unknown: str = "allow", rounds: int = ROUNDS, damping: int = DAMPING, most: int = MOST, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, host, path, rule, verdict, trust, distrust of every page.

    most: rules that a host's row may carry along; paths of other hosts are looked up in the rule table itself.
    """
    spark = pages.sparkSession
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), _salt(F.coalesce(url, F.lit(""))).alias("salt"), F.col(html_col).alias("html"))
    table = written(rule_table(spark, rules), "rules")
    hosts = written(rows.groupBy("host", "salt").agg(F.count("*").alias("n")).groupBy("host").agg(F.sum("n").alias("n"), F.collect_list("salt").alias("salts")), "hosts")
    fits = written(ruled_hosts(hosts, table), "fits")
    held = fits.groupBy("host").agg(F.count("*").alias("rules")).filter(F.col("rules") <= most)
    carried = fits.join(held, "host", "left_semi").groupBy("host").agg(F.collect_list(F.struct("rule_path", "won")).alias("fits"))
    hosts = written(hosts.join(carried, "host", "left"), "ruled")
    n, carries = hosts.agg(F.count("*"), F.coalesce(F.sum(F.when(F.col("fits").isNotNull(), F.size("fits"))), F.lit(0))).first()

    def with_host(left: DataFrame, right: DataFrame, row_bytes: int, on: str = "left") -> DataFrame:
        """left joined with its hosts' rows in right, which is broadcast, or repeated for each salt that occurs."""
        if n * row_bytes <= BROADCAST:
            return left.join(F.broadcast(right.drop("salts")), "host", on)
        return left.join(right.withColumn("salt", F.explode("salts")).drop("salts"), ["host", "salt"], on)

    best = F.array_max(F.transform(F.filter("fits", lambda r: F.startswith(F.col("path"), r.rule_path)), lambda r: r.won))
    ruled = with_host(rows, hosts.select("host", "salts", "fits"), 512 + 256 * carries // max(n, 1)).withColumn("won", best)
    beyond = fits.join(held, "host", "left_anti")
    if not beyond.isEmpty():
        ruled = _by_beginning(ruled, beyond, table)
    evidence = ruled.filter("won IS NOT NULL").groupBy("host").agg(F.count("*").alias("n"), F.count_if(~F.col("won.blocks")).alias("good"))
    evidence = written(evidence.select("host", F.expr(f"{UNIT} * good div n").alias("trust"), F.expr(f"{UNIT} * (n - good) div n").alias("distrust")), "evidence")
    edges = written(host_edges(rows.select("host", "html")), "links")
    trust = propagated(evidence.select("host", F.col("trust").alias("seed")), edges, rounds, damping)
    distrust = propagated(evidence.select("host", F.col("distrust").alias("seed")), edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")), rounds, damping)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    scored = hosts.select("host", "salts").join(trust.withColumnRenamed("rank", "trust"), "host", "left").join(distrust.withColumnRenamed("rank", "distrust"), "host", "left")
    scored = written(scored.select("host", "salts", zero(F.col("trust")).alias("trust"), zero(F.col("distrust")).alias("distrust")), "scored")
    whole = F.col("trust").cast("decimal(20,0)") + F.col("distrust")
    by_graph = F.when(whole == 0, unknown).when(F.col("trust").cast("decimal(20,0)") * 100 < whole * threshold, "block").otherwise("allow")
    out = with_host(ruled.drop("html", "fits"), scored, 512, "inner")
    return out.select("id", "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", by_graph).alias("verdict"), "trust", "distrust")


def _by_beginning(rows: DataFrame, beyond: DataFrame, table: DataFrame) -> DataFrame:
    """rows with `won` filled for hosts of many rules: joined by the rule's host and as much of the path as rules have."""
    lengths = beyond.select("host", "rule_host", F.length("rule_path").alias("size")).distinct()
    paths = rows.select("host", "path").join(beyond.select("host").distinct(), "host", "left_semi").distinct()
    begins = paths.join(lengths, "host").filter(F.length("path") >= F.col("size"))
    found = begins.select("host", "path", "rule_host", F.substring("path", F.lit(1), F.col("size")).alias("rule_path")).join(table, ["rule_host", "rule_path"])
    found = written(found.groupBy("host", "path").agg(F.max("won").alias("found")), "found")
    return rows.join(found, ["host", "path"], "left").withColumn("won", F.coalesce("won", "found")).drop("found")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page of pages with its verdict, its rule or none, and what trust and distrust reached its host."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES).withColumnRenamed("id", "page_id")


def _rank_sql(name: str, src: str, dst: str) -> str:
    """The rounds of one propagation as tables name_0 .. name_ROUNDS."""
    start = f"{name}_0 AS MATERIALIZED (SELECT host, {name} AS seed, {100 - DAMPING} * {name} // 100 AS rank FROM places)"
    step = """{name}_{k} AS MATERIALIZED (SELECT p.host, p.seed, CAST(({rest} * p.seed + {damping} * coalesce(c.came, 0)) // 100 AS BIGINT) AS rank
  FROM {name}_{j} p LEFT JOIN (SELECT e.{dst} AS host, CAST(sum(s.rank // d.n) AS BIGINT) AS came FROM edges e JOIN {name}_{j} s ON s.host = e.{src}
    JOIN (SELECT {src} AS host, count(*) AS n FROM edges GROUP BY 1) d ON d.host = e.{src} GROUP BY 1) c ON c.host = p.host)"""
    return ",\n".join([start, *(step.format(name=name, j=k - 1, k=k, src=src, dst=dst, rest=100 - DAMPING, damping=DAMPING) for k in range(1, ROUNDS + 1))])


_LINK = LINK.replace("'", "''")
_RULE_ROWS = ", ".join(f"('{r}', '{r.split('/')[0]}', '{r[r.index('/') :]}', '{v}')" for r, v in RULES)
SQL = f"""
WITH rules(rule, rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
rows_ AS (SELECT page_id, html, translate(coalesce(regexp_extract(url, '{HOST}', 1), ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
  coalesce(regexp_extract(url, '{PATH}', 1), '') AS path FROM pages),
known AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM rows_) JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY 1, 2),
ruled AS (SELECT r.*, k.rule, k.verdict FROM rows_ r LEFT JOIN known k ON k.host = r.host AND k.path = r.path),
seeds AS (SELECT host, {UNIT} * count(*) FILTER (verdict = 'allow') // count(*) AS trust, {UNIT} * count(*) FILTER (verdict = 'block') // count(*) AS distrust
  FROM ruled WHERE rule IS NOT NULL GROUP BY 1),
edges AS MATERIALIZED (SELECT DISTINCT src, dst FROM (SELECT host AS src, translate(unnest(regexp_extract_all(regexp_replace(html, '{UNSEEN}', ' ', 'g'), '{_LINK}', 1)), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS dst
  FROM rows_ WHERE host <> '') WHERE src <> dst),
places AS MATERIALIZED (SELECT host, coalesce(max(trust), 0) AS trust, coalesce(max(distrust), 0) AS distrust
  FROM (SELECT host, trust, distrust FROM seeds UNION ALL SELECT dst, 0, 0 FROM edges UNION ALL SELECT src, 0, 0 FROM edges UNION ALL SELECT host, 0, 0 FROM rows_) GROUP BY 1),
{_rank_sql("trust", "src", "dst")},
{_rank_sql("distrust", "dst", "src")}
SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.verdict, CASE WHEN t.rank + d.rank = 0 THEN 'allow' WHEN 100 * t.rank < {THRESHOLD} * (t.rank + d.rank) THEN 'block' ELSE 'allow' END) AS verdict,
  CAST(t.rank AS BIGINT) AS trust, CAST(d.rank AS BIGINT) AS distrust
FROM ruled r JOIN trust_{ROUNDS} t ON t.host = r.host JOIN distrust_{ROUNDS} d ON d.host = r.host
"""
