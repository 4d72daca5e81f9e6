import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sendero.llm import fill_middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc, text, cut=50, spm=80):
    """n, form, prefix, middle, output of a text."""
    text = text or ""
    found = UNIT.findall(text)
    assert "".join(found) == text
    told = hashlib.sha256(f"42:{'null' if doc is None else doc}".encode()).hexdigest()
    h = [int(told[k : k + 8], 16) for k in range(0, 32, 8)]
    n = len(found)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= cut:
        return n, "plain", None, None, text
    p, m, s = "".join(found[:a]), "".join(found[a:b]), "".join(found[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(3)
    pieces = ["a", "word", " ", "  ", "\n", "\t\x0b\x0c\r", "é", "𝒳y", "<", "<P", "S>", " ", " x", "\x1c", "日本"]
    made = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    return [*made, None, "", " ", "\n\n", "<P>", "a <M> b", " a", "a ", "x" * 200_000, "w " * 100_000, " " * 100_000, "🙂" * 50_000]


@pytest.mark.parametrize("small", [True, False])
def test_every_cut_against_plain_python(spark, tmp_path, monkeypatch, small):
    if not small:
        monkeypatch.setattr(fill_middle, "broadcast_if_small", lambda df, *_: df)
    given = texts()
    rows = [(i, t, 7) for i, t in enumerate(given)] + [(3, given[3], 1), (3, given[3], 1), (3, "another text of it", 2), (None, "one two three four", 1), (None, None, 1), (-5, "minus five is here", 1)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, _row int").withColumn("n", F.lit("n")).withColumn("_file", F.lit("f")).withColumn("form", F.lit(None).cast("string"))
    frame.repartition(3).write.parquet(str(tmp_path / "d"))
    got = fill_middle.transform(spark.read.parquet(str(tmp_path / "d")), cut_share=80)
    back = got.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    want = sorted(((i, *brute(i, t, 80)) for i, t, _ in rows), key=str)
    assert sorted(((r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in back), key=str) == want
    assert all(r.back == r.text for r in back) and {r.form for r in back} == {"plain", "spm", "psm"}


def test_rows_of_no_file_and_an_empty_table(spark):
    frame = spark.createDataFrame([(1, "a b c d"), (2, "e f")], "doc_id bigint, text string")
    got = {r.id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in fill_middle.transform(frame).collect()}
    assert got == {1: brute(1, "a b c d"), 2: brute(2, "e f")}
    assert fill_middle.transform(frame.limit(0)).count() == 0
