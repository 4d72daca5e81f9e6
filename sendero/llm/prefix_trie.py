"""Prefix trie of rebuilt conversations.

Turns are reduced at the scan to a SHA-256 of role and text and a length. Sorted by ranges of (conversation, place), each
partition runs along its rows and gives every prefix a 128-bit key, the XOR of mixed (place, digest) values; what the
partition before left unfinished is added from one row a partition, so a conversation of any length is dealt over many
tasks. A node is a key. Partitions combine their rows to node tables, which are merged by key over `FAN` branches at a
time until one is left; depth and the rest of the last digest must agree in each merge, which by induction over the depth
means that the sequences are equal.

The roll-up runs over paths, not levels: the nodes of the same smallest member are the lower end of that conversation's
path, so the trie is a tree of such paths, each hanging from a node of another. Totals of whole paths are summed up that
tree by pointers that double their reach (rounds: the logarithm of its height), and sums along a path run by ranges as
above.

Conversations that end in a node are sorted by ranges of (node, conv_id) and made into pieces of text where they lie;
only the hash, which is sequential, runs over a node's pieces in one task, as a stream.

Defined cases: rows without a conv_id belong to no conversation and are left out; null role or text is empty; turns of
equal number are ordered by the digest of role and text, repeated rows are turns of their own; other columns are ignored;
an empty table has no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from sendero.llm._common import U64, broadcast_if_small, lean, mixed, scratch, spread_join, strings, written

BLOCK = 100  # conversations whose ids differ below it share a base
HEADS = 6  # a conversation takes the first 0 to HEADS - 1 turns of its base
FAN = 256
STRIDE = 1 << 20  # turns of a conversation that one task joins with its plan
PIECE = 1 << 16  # bytes of ids in a piece
KEY = ["k1", "k2"]


def running(df: DataFrame, key: str, order: list[Column], values: Callable[[pa.RecordBatch], tuple[list, list]], sums: list[str], own: list[str], xor: bool = False) -> tuple[DataFrame, int]:
    """df with running sums (or XORs) of values within each key, in order, and the number of partitions it was dealt to.

    values gives, for a batch, the arrays to be summed and others to be kept, under the names in sums and own.
    """
    fold = np.bitwise_xor if xor else np.add
    undo = np.bitwise_xor if xor else np.subtract

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, last, carry = TaskContext.get().partitionId(), 0, None, None
        for batch in batches:
            if not (n := batch.num_rows):
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            summed, kept = values(batch)
            total = fold.accumulate(np.stack([np.asarray(v).astype(U64) for v in summed]), axis=1)
            starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
            before = np.zeros((len(summed), len(starts)), U64)
            before[:, 1:] = total[:, starts[1:] - 1]
            total = undo(total, np.repeat(before, np.diff(starts, append=n), axis=1))
            if last == keys[0] and carry is not None:
                first = int(starts[1]) if len(starts) > 1 else n
                total[:, :first] = fold(total[:, :first], carry[:, None])
            last, carry = keys[-1], total[:, -1].copy()
            made = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (*total, *(np.asarray(v, U64) for v in kept))]
            places = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *places, *made], names=[*batch.schema.names, "part", "at", *sums, *own])
            at += n

    schema = StructType([*df.schema.fields, StructField("part", IntegerType()), *(StructField(c, LongType()) for c in ("at", *sums, *own))])
    dealt = df.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    table = written(dealt.mapInArrow(lean(run), schema), "running", 10_000)
    ends = table.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last"), *(F.max_by(c, "at").alias(c) for c in sums)).orderBy("part").collect()  # one row a partition
    rows, held, value = [], None, [0] * len(sums)
    for r in ends:
        mine = [r[c] for c in sums]
        if held == r["first"]:
            rows.append([r["part"], r["first"], *value])
            if r["last"] == held:
                mine = [a ^ b if xor else a + b for a, b in zip(value, mine, strict=True)]
        held, value = r["last"], mine
    if rows:
        names = ["part", key, *(f"_{c}" for c in sums)]
        columns = [pa.array(c, pa.int32() if i == 0 else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))]
        offsets = df.sparkSession.createDataFrame(pa.table(columns, names=names))
        joined = table.join(broadcast_if_small(offsets, len(rows)), ["part", key], "left")
        shift = {c: F.coalesce(f"_{c}", F.lit(0)) for c in sums}
        table = joined.select(*df.columns, "part", *((F.col(c).bitwiseXOR(shift[c]) if xor else F.col(c) + shift[c]).alias(c) for c in sums), *own)
    return table.drop("at"), max((r["part"] for r in ends), default=0) + 1


def turns_of(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, digest, chars."""
    rows = rows.select(F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    told = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.filter("conv IS NOT NULL").select("conv", "turn", F.unhex(F.sha2(told, 256)).alias("digest"), F.length("text").cast("bigint").alias("chars"))


def taken(conv: Column) -> Column:
    """How many turns of its base a conversation begins with."""
    return F.crc32(conv.cast("string")) % HEADS


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, digest, chars, last) of every rebuilt turn, and the conversations (conv, n: turns, p: of the base)."""
    ones = lambda batch: ([np.ones(batch.num_rows, U64)], [])
    numbered, _ = running(turns, "conv", [F.col("turn"), F.col("digest")], ones, ["place"], [])
    head = F.when(F.col("place") < HEADS, F.struct("place", "digest", "chars"))
    convs = written(numbered.groupBy("conv").agg(F.max("place").alias("n"), F.array_sort(F.collect_list(head)).alias("head")), "convs")
    bases = convs.select(F.col("conv").alias("base"), F.col("head").alias("of_base"))
    plan = convs.select("conv", "n", taken(F.col("conv")).alias("h"), (F.col("conv") - F.col("conv") % BLOCK).alias("base")).join(bases, "base", "left")
    begin = F.when(F.col("of_base").isNotNull(), F.slice("of_base", F.lit(1), F.col("h").cast("int")))
    plan = written(plan.select("conv", "n", "h", begin.alias("begin"), F.when(begin.isNotNull(), F.size(begin)).otherwise(0).cast("bigint").alias("p")), "plan")
    length = F.col("p") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    from_base = plan.select("conv", length.alias("n"), F.posexplode("begin").alias("at", "turn"))
    from_base = from_base.select("conv", (F.col("at") + 1).cast("bigint").alias("depth"), "turn.digest", "turn.chars", (F.col("at") + 1 == F.col("n")).alias("last"))
    own = numbered.filter(F.col("place") > taken(F.col("conv"))).select("conv", "place", "digest", "chars")
    small, count = plan.select("conv", "n", "h", "p"), plan.count()
    if count * 64 <= 64 << 20:
        own = own.join(F.broadcast(small), "conv")
    else:  # a long conversation meets its plan in many tasks
        salts = F.sequence(F.lit(0).cast("bigint"), F.expr(f"n div {STRIDE}"))
        own = own.withColumn("salt", F.expr(f"place div {STRIDE}")).join(small.withColumn("salt", F.explode(salts)), ["conv", "salt"])
    own = own.select("conv", (F.col("p") + F.col("place") - F.col("h")).alias("depth"), "digest", "chars", (F.col("place") == F.col("n")).alias("last"))
    return from_base.unionByName(own), plan.select("conv", length.alias("length"))


def _keys(batch: pa.RecordBatch) -> tuple[list, list]:
    """The two halves of a turn's key; they and the digest's other half are kept."""
    data, offsets = strings(batch.column("digest"))
    word = np.ascontiguousarray(data[offsets[0] : offsets[-1]]).view("<u8").reshape(-1, 4)
    depth = batch.column("depth").to_numpy().astype(U64)
    halves = [mixed(word[:, 0] ^ mixed(depth * U64(0x9E3779B97F4A7C15))), mixed(word[:, 1] + mixed(depth * U64(0xC2B2AE3D27D4EB4F)))]
    return halves, [*halves, word[:, 2], word[:, 3]]


def node_table(paths: DataFrame, parts: int, fan: int = FAN) -> DataFrame:
    """k1, k2, p1, p2 (the parent's key), conv_id, depth, n_convs, chars, ends_here (conv_id's own end) of each node but the root.

    Each partition's rows are combined to a partial trie, and partial tries are merged `fan` at a time.
    """
    same = ["depth", "w2", "w3", "m1", "m2", "chars"]
    count, first = parts, True
    table = paths.select(*KEY, F.col("part").alias("branch"), F.col("conv").alias("conv_id"), F.col("last").alias("ends_here"), F.lit(1).cast("bigint").alias("n_convs"), *(F.col(c).alias(f"{s}_{c}") for c in same for s in ("low", "high")))
    while first or count > 1:
        table = table.withColumn("branch", F.expr(f"branch div {fan}"))
        least = [F.min(f"low_{c}").alias(f"low_{c}") for c in same]
        most = [F.max(f"high_{c}").alias(f"high_{c}") for c in same]
        table = table.groupBy(*KEY, "branch").agg(F.min_by("ends_here", "conv_id").alias("ends_here"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), *least, *most)
        count, first = -(-count // fan), False
    agree = F.lit(True)
    for c in same:
        agree = agree & (F.col(f"low_{c}") == F.col(f"high_{c}"))
    sound = F.when(agree, F.col("n_convs")).otherwise(F.raise_error(F.lit("two sequences of turns share a key")).cast("bigint"))
    parent = [F.col(k).bitwiseXOR(F.col(f"low_{m}")).alias(p) for k, m, p in (("k1", "m1", "p1"), ("k2", "m2", "p2"))]
    return table.select(*KEY, *parent, "conv_id", F.col("low_depth").alias("depth"), sound.alias("n_convs"), F.col("low_chars").alias("chars"), "ends_here")


def end_hashes(ends: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256 of ends(k1, k2, conv)."""

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
        one, two = (batch.column(c).to_numpy() for c in KEY)
        cuts = [0, *(np.flatnonzero((one[1:] != one[:-1]) | (two[1:] != two[:-1])) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                yield int(one[a]), int(two[a]), a, b

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column("conv").to_pylist(), []
            for one, two, a, b in runs(batch):
                for i in range(a, b, PIECE // 20):
                    found.append((one, two, ids[i], ",".join(map(str, ids[i : min(b, i + PIECE // 20)]))))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=[*KEY, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            done, ids = [], batch.column("ids")
            for one, two, a, b in runs(batch):
                if (one, two) != held:
                    if held:
                        done.append((*held, state.hexdigest()))
                    held, state, comma = (one, two), hashlib.sha256(), b""
                for i in range(a, b):
                    state.update(comma + ids[i].as_py().encode())
                    comma = b","
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=[*KEY, "ends_sha256"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*held, state.hexdigest())], names=[*KEY, "ends_sha256"])

    pieces = ends.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv").mapInArrow(lean(told), "k1 bigint, k2 bigint, first bigint, ids string")
    pieces = written(pieces, "pieces", 10_000)
    return written(pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(lean(hashed), "k1 bigint, k2 bigint, ends_sha256 string"), "ends", 64)


def summed_up(paths: DataFrame) -> DataFrame:
    """conv, saved, leaves of each path with all that hangs from it, from paths(conv, up: the path it hangs from, saved, leaves)."""
    table = written(paths, "sums")
    while (left := table.filter("up IS NOT NULL").count()) > 0:
        added = table.filter("up IS NOT NULL").groupBy(F.col("up").alias("conv")).agg(F.sum("saved").alias("more"), F.sum("leaves").alias("more_leaves"))
        reach = written(table.filter("up IS NOT NULL").select("up").distinct().join(table.select(F.col("conv").alias("up"), F.col("up").alias("next")), "up"), "reach")
        moved = spread_join(table.filter("up IS NOT NULL").select("conv", "up"), reach, ["up"], "conv", reach.count()).select("conv", "next")
        both = table.join(added, "conv", "left").join(broadcast_if_small(moved, left), "conv", "left")
        zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
        table = written(both.select("conv", F.col("next").alias("up"), (F.col("saved") + zero(F.col("more"))).alias("saved"), (F.col("leaves") + zero(F.col("more_leaves"))).alias("leaves")), "sums")
    return table.drop("up")


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", fan: int = FAN) -> DataFrame:
    """The trie's nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    with scratch(conversations.sparkSession, {"trie"}):
        return written(_nodes(turns_of(conversations, conv_col, turn_col, role_col, text_col), fan), "trie")


def _nodes(turns: DataFrame, fan: int) -> DataFrame:
    spark, zero = turns.sparkSession, F.lit(0).cast("bigint")
    rows, convs = rebuilt(turns)
    paths, parts = running(rows, "conv", [F.col("depth")], _keys, KEY, ["m1", "m2", "w2", "w3"], xor=True)
    whole, first = convs.agg(F.count("*"), F.min("conv")).first()
    own_nodes = node_table(paths, parts, fan)
    root = spark.range(min(whole, 1)).select(*(zero.alias(c) for c in KEY), *(F.lit(None).cast("bigint").alias(c) for c in ("p1", "p2")), F.lit(first).cast("bigint").alias("conv_id"), zero.alias("depth"), F.lit(whole).cast("bigint").alias("n_convs"), zero.alias("chars"))
    root = root.join(F.broadcast(convs.filter(F.col("conv") == F.lit(first)).select((F.col("length") == 0).alias("ends_here"))))
    nodes = written(own_nodes.unionByName(root), "nodes")
    saved = (F.col("n_convs") - 1) * F.col("chars")
    # One path for each smallest member; its highest node hangs from a node of another path.
    lines = nodes.groupBy("conv_id").agg(F.sum(saved).alias("saved"), F.min("depth").alias("depth"), F.min_by("p1", "depth").alias("p1"), F.min_by("p2", "depth").alias("p2"))
    lines = written(lines, "lines")
    hooks = lines.filter("depth > 0").select("p1", "p2").distinct()
    hooks = written(hooks.join(nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("up")), ["p1", "p2"]), "hooks")
    hung = written(spread_join(lines.filter("depth > 0"), hooks, ["p1", "p2"], "conv_id", hooks.count()).select("conv_id", "depth", "up"), "hung")
    at_node = hung.groupBy(F.col("up").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("hangs"))
    leaf = nodes.filter("ends_here").join(at_node, ["conv_id", "depth"], "left_anti").select("conv_id", F.lit(1).cast("bigint").alias("leaves"))
    line = lines.select("conv_id", "saved").join(hung.select("conv_id", "up"), "conv_id", "left").join(leaf, "conv_id", "left")
    totals = summed_up(line.select(F.col("conv_id").alias("conv"), "up", "saved", F.coalesce("leaves", zero).alias("leaves")))
    below = hung.join(totals.withColumnRenamed("conv", "conv_id"), "conv_id").groupBy(F.col("up").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    below = below.agg(F.count("*").alias("hangs"), F.sum("saved").alias("saved_below"), F.sum("leaves").alias("leaves_below"))
    full = nodes.join(below, ["conv_id", "depth"], "left").join(hung, ["conv_id", "depth"], "left")
    hangs = F.coalesce("hangs", zero)
    full = full.select(
        *KEY, "conv_id", "depth", "n_convs",
        F.when(F.col("depth") > 0, F.coalesce("up", "conv_id")).alias("parent_conv_id"),
        (hangs + F.when(F.col("ends_here"), 0).otherwise(1)).alias("n_children"),
        (F.coalesce("leaves_below", zero) + F.when(F.col("ends_here") & (hangs == 0), 1).otherwise(0)).alias("leaves"),
        (saved + F.coalesce("saved_below", zero)).alias("saved"),
    )
    # Along each path from its end upwards.
    rolled, _ = running(full, "conv_id", [F.col("depth").desc()], lambda b: ([b.column(c).to_numpy() for c in ("leaves", "saved")], []), ["n_leaves", "saved_tokens"], [])
    last = paths.filter("last").select(*KEY, "conv").unionByName(convs.filter("length = 0").select(*(zero.alias(c) for c in KEY), "conv"))
    out = rolled.join(end_hashes(last), KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie over all rebuilt conversations."""
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


SQL = f"""
WITH t AS MATERIALIZED (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, d) - 1 AS i, d, n FROM (
  SELECT conv_id AS c, turn, sha256(concat(CAST(octet_length(encode(coalesce(role, ''))) AS VARCHAR), ':', role, text)) AS d, length(coalesce(text, '')) AS n FROM conversations WHERE conv_id IS NOT NULL)),
v AS MATERIALIZED (SELECT c, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: [CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % {HEADS} AS h FROM (SELECT DISTINCT c FROM t)),
heads AS MATERIALIZED (SELECT v.c, t.i, t.d, t.n FROM v JOIN t ON t.c = v.c - v.c % {BLOCK} AND t.i < v.h),
path AS (SELECT c, i + 1 AS depth, d, n FROM heads
  UNION ALL SELECT t.c, coalesce(p.p, 0) + t.i - v.h + 1, t.d, t.n FROM t JOIN v ON v.c = t.c AND t.i >= v.h LEFT JOIN (SELECT c, count(*) AS p FROM heads GROUP BY c) p ON p.c = t.c
  UNION ALL SELECT c, 0, '', 0 FROM v),
keyed AS MATERIALIZED (SELECT c, depth, n, k, lag(k) OVER (PARTITION BY c ORDER BY depth) AS up, depth = max(depth) OVER (PARTITION BY c) AS last
  FROM (SELECT *, sha256(array_to_string(list(d) OVER (PARTITION BY c ORDER BY depth), ',')) AS k FROM path)),
nodes AS MATERIALIZED (SELECT k, any_value(up) AS up, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(n) AS chars,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends_sha256 FROM keyed GROUP BY k, depth),
kids AS (SELECT up AS k, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY 1),
under AS (SELECT p.k, count(*) FILTER (u.k NOT IN (SELECT k FROM kids)) AS n_leaves, sum((u.n_convs - 1) * u.chars) AS saved_tokens
  FROM nodes u JOIN keyed p ON p.c = u.conv_id AND p.depth <= u.depth GROUP BY 1)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children, CAST(under.n_leaves AS BIGINT) AS n_leaves, CAST(under.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes up ON up.k = n.up LEFT JOIN kids ON kids.k = n.k JOIN under ON under.k = n.k
"""
