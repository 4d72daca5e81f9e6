import pytest
from pyspark.sql import functions as F

from sendero.llm import warc

BIG = "<p>" + "ñ" * 600


def test_archive_round_trip(spark, tmp_path):
    rows = [(1, "http://a/ b\r\nX: y", BIG), (2, None, BIG), (5, "u", BIG), (5, "u", BIG), (3, "u", "s"), (4, "u", "s"), (None, "u", BIG), (6, "u", None), (7, "u", "a\r\n\r\nb")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("key", F.lit(1)).withColumn("header", F.lit("x"))
    headers, payloads = warc.write_archive(pages)
    assert payloads.count() == 4
    back = warc.records(headers, payloads)
    got = sorted(((r[0], r[1], r[2]) for r in back.select(warc.page_of("WARC-Record-ID"), warc.field("WARC-Type"), warc.page_of("WARC-Refers-To")).collect()), key=str)
    assert got == sorted([(1, "revisit", 5), (2, "revisit", 5), (5, "response", None), (5, "response", None), (3, "response", None), (4, "response", None), (None, "revisit", 5), (6, "response", None), (7, "response", None)], key=str)
    for r in back.collect():
        header, payload = next(warc.parsed(bytes(r.record)))
        assert header.encode() == bytes(r.header)
        assert payload == (b"" if "revisit" in header else bytes(r.payload))
    warc.export(back, f"file://{tmp_path}/w")
    read = sorted((r.header, bytes(r.payload)) for r in warc.read_files(spark, f"file://{tmp_path}/w").collect())
    assert read == sorted((bytes(r.header).decode(), b"" if b"revisit" in bytes(r.header) else bytes(r.payload)) for r in back.collect())
    assert warc.records(*warc.write_archive(pages.limit(0))).count() == 0


def test_query_parses_the_records(spark, tmp_path, monkeypatch):
    rows = [(1, "u", BIG), (2, "u", BIG), (3, "u", "s"), (4, None, "a\r\n\r\nb"), (5, "u", None)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.op9_warc(spark, str(tmp_path)).collect()}
    assert got == {1: (1203, "revisit", 2), 2: (1203, "response", None), 3: (1, "response", None), 4: (6, "response", None), 5: (0, "response", None)}
    whole = warc.records
    monkeypatch.setattr(warc, "records", lambda *tables: whole(*tables).withColumn("record", F.concat("record", F.lit(b"x"))))
    with pytest.raises(Exception, match="Content-Length|substring|subsection"):
        warc.op9_warc(spark, str(tmp_path)).collect()


def test_long_payloads_many_copies_and_control_characters(spark, monkeypatch):
    """A payload of four million bytes, a third of the pages equal, characters that would split a header line."""
    monkeypatch.setattr(warc, "HOT", 100)
    long = "é<p>" * 800_000
    rows = [(i, f"u{i}", BIG) for i in range(150)] + [(1000 + i, f"v{i}", f"page {i}") for i in range(300)] + [(2000, "w", long), (2001, "w", long)]
    rows += [(3000 + c, f"a{chr(c)}b", "x") for c in (*range(1, 33), 127)]
    headers, payloads = warc.write_archive(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4))
    back = warc.reread(warc.records(headers, payloads)).select(warc.page_of("WARC-Record-ID").alias("id"), warc.field("WARC-Type").alias("kind"), warc.field("WARC-Target-URI").alias("url"), F.octet_length("payload").alias("n"), warc.page_of("WARC-Refers-To").alias("to")).collect()
    got = {r.id: (r.kind, r.n, r.to) for r in back}
    assert len(back) == len(got) == len(rows)
    assert all(got[i] == (("revisit", 1203, 149) if i < 149 else ("response", 1203, None)) for i in range(150))
    assert got[2000] == ("revisit", 5 * 800_000, 2001) and got[2001] == ("response", 5 * 800_000, None)
    assert {r.id: r.url for r in back if r.id >= 3000} == {3000 + c: f"a%{c:02X}b" for c in (*range(1, 33), 127)}
