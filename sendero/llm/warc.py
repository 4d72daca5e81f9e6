"""Content-addressed WARC archive.

An archive is two tables in the shared folder: `headers` keeps the exact header bytes of every record (WARC and HTTP
lines, up to the blank line) and the SHA-256 of its payload; `payloads` keeps each payload's bytes once, under that
digest. Payloads seen once are written where they are read; only groups of equal digests are brought together, and
each copy is compared byte by byte with the one that is stored. Records are rebuilt by a join on the digest, and the
stored bytes are digested again on the way. Copies of one payload are dealt over tasks by a salt, and the payload to each.

Of records with equal payloads of at least `least` bytes the one with the largest id is a response, the others are
revisits that refer to it; shorter payloads are responses all.

Defined cases: a null payload counts as empty; a null id never is the response of a group that has another id; rows
that tie on the largest id are responses each; control characters and spaces in a URL are percent-encoded, a null URL
leaves its line out; other columns are ignored; an empty table gives an empty archive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sendero.llm._common import BATCH, broadcast_if_small, written

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def _url(col: str) -> F.Column:
    """The URL with spaces and control characters, which would end or split a header line, percent-encoded."""
    out = F.col(col)
    for c in (*range(33), 127):
        out = F.replace(out, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    return out


def _urn(col: str) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(col).cast("string"), F.lit("null")), F.lit(">"))


def write_archive(pages: DataFrame, least: int = 1000, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """Archive every row of pages; returns the written tables headers(key, header) and payloads(key, payload)."""
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), _url(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    groups = written(rows.groupBy("key").agg(F.max("id").alias("stays"), F.count("*").alias("n")).filter("n > 1"), "groups")
    n = groups.count()
    known = rows.join(broadcast_if_small(groups, n), "key", "left")
    single = known.filter(F.col("n").isNull()).select("key", "payload")
    copies = known.filter(F.col("n").isNotNull())
    once = copies.filter(F.col("id").eqNullSafe(F.col("stays"))).groupBy("key").agg(F.max("payload").alias("payload"))
    payloads = written(single.unionByName(once), "payloads")
    size = groups.count()
    stored = payloads.join(broadcast_if_small(groups.select("key"), size), "key", "left_semi").withColumnRenamed("payload", "stored")
    if not _with_payload(copies, stored, "id").filter(F.col("payload") != F.col("stored")).isEmpty():
        raise ValueError("two payloads share a SHA-256 digest")
    revisit = (F.octet_length("payload") >= least) & F.col("n").isNotNull() & ~F.col("id").eqNullSafe(F.col("stays"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit(END))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.octet_length("payload"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _urn("id")),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", F.col("url")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", _urn("stays")), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block.cast("string")),
        F.lit("\r\n"),
        http,
    )
    return written(known.select("key", header.cast("binary").alias("header")), "headers"), payloads


HOT, SALTS = 1000, 64  # copies of a payload beyond which they are dealt over tasks, and over how many


def _with_payload(rows: DataFrame, payloads: DataFrame, by: str) -> DataFrame:
    """rows joined with payloads(key, ...), one row for each key; rows of a key that many share are dealt by a salt of `by`."""
    hot = written(rows.groupBy("key").agg(F.count("*").alias("copies")).filter(F.col("copies") > HOT).select("key", F.lit(True).alias("hot")), "hot")
    hot = broadcast_if_small(hot, hot.count())
    salted = rows.join(hot, "key", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).otherwise(0)).drop("hot")
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(payloads.join(hot, "key", "left").withColumn("salt", F.explode(salts)).drop("hot"), ["key", "salt"], "left").drop("salt")


def records(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """Every record again: header, payload (the full one, for revisits too), record (its exact bytes)."""
    both = _with_payload(headers, payloads, "header")
    sound = F.unhex(F.sha2("payload", 256)).eqNullSafe(F.col("key"))
    payload = F.when(sound, F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload does not match its digest")).cast("binary"))
    both = both.select("header", payload.alias("payload"))
    return both.withColumn("record", F.concat("header", F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload")), F.lit(END.encode())))


def field(name: str) -> F.Column:
    """A header line's value, null if the record has no such line."""
    return F.nullif(F.regexp_extract(F.decode("header", "UTF-8"), rf"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))


def page_of(name: str) -> F.Column:
    """The page id in a header's <urn:page:...>."""
    return F.regexp_extract(field(name), r"<urn:page:(-?\d+)>", 1).try_cast("bigint")


def export(rebuilt: DataFrame, path: str, records_per_file: int = 100_000) -> None:
    """Write records as WARC files of text payloads; each record ends with two line ends, as the format has it."""
    body = F.decode(F.expr(f"substring(record, 1, length(record) - {len(END)})"), "UTF-8")
    rebuilt.select(body.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


def parsed(raw: bytes) -> Iterator[tuple[str, bytes]]:
    """(header with the HTTP lines, payload) of each record of a WARC file."""
    at = 0
    while at < len(raw):
        head = raw.index(b"\r\n\r\n", at) + 4
        size = int(re.search(rb"\r\nContent-Length: (\d+)\r\n", raw[at:head])[1])
        block = raw[head : head + size]
        cut = block.index(b"\r\n\r\n") + 4
        yield (raw[at:head] + block[:cut]).decode(), block[cut:]
        at = head + size + 4


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """header, payload of the records in WARC files that export() wrote."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content").to_pylist():
                found = list(parsed(raw))
                yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in found], pa.string()), pa.array([p for _, p in found], pa.binary())], names=["header", "payload"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, "header string, payload binary")


def reread(rebuilt: DataFrame) -> DataFrame:
    """header, payload as parsed from each record's bytes; a revisit, whose record has none, keeps the payload it names."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            headers, payloads = [], []
            for raw, full in zip(batch.column("record").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                found = list(parsed(raw))
                if len(found) != 1 or not raw.endswith(END.encode()) or len(found[0][0].encode()) + len(found[0][1]) + len(END) != len(raw):
                    raise ValueError("a record does not hold what its Content-Length says")
                if full is not None and found[0][1]:
                    raise ValueError("a revisit holds a payload")
                headers.append(found[0][0].encode())
                payloads.append(found[0][1] if full is None else full)
            yield pa.RecordBatch.from_arrays([pa.array(headers, pa.binary()), pa.array(payloads, pa.binary())], names=["header", "payload"])

    full = F.when(field("WARC-Type") == "revisit", F.col("payload"))
    return rebuilt.select("record", full.alias("payload")).mapInArrow(parse, "header binary, payload binary")


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """Archive pages, rebuild and parse every record of the archive: one row for each."""
    spark.conf.set(BATCH, 1000)
    found = reread(records(*write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"))))
    return found.select(page_of("WARC-Record-ID").alias("page_id"), F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), field("WARC-Type").alias("record_type"), page_of("WARC-Refers-To").alias("refers_to"))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
r AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS m FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> m THEN m END AS refers_to
FROM r
"""
