"""Fill-in-the-middle transformation, cut between units of text, as relations.

A unit is white space with the run after it that is none (a last run of white space stands alone), matched from left to
right. Rows are numbered by file and place. Three passes, each linear in the input:

1. `cuts`: a row's number of units, its form and the two ordinals after which it is cut (no shuffle).
2. `spans`: units are listed by posexplode, a window sums their lengths along each row, the cut requests are joined by row
   and ordinal, and the offsets are gathered a row. The texts to be cut are dealt by row before they are listed, so the
   units, which outnumber them a hundred times, are never shuffled; rows in plain form stay out.
3. the spans are joined to the rows again, and substring gives prefix, middle and suffix.

Everything is a DataFrame operation. One text's units are summed in one task; a text is one value of one row anyway.

Defined cases: a null text is empty; an empty text and one that holds a sentinel stay plain; a null id is hashed as the
word null; repeated rows are cut alike, row by row; other columns are ignored, whatever their names; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sendero.llm._common import broadcast_if_small, keyed, settings, written

UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "42:"
CUT_SHARE, SPM_SHARE = 50, 80  # per cent of texts that are cut, and of these in the form suffix, prefix, middle
ROW = "_row"


def units(text: Column) -> Column:
    """The units of a text, which together are the text."""
    return F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))


def _draws(doc: Column, seed: str) -> list[Column]:
    """Four unsigned 32-bit numbers of a document's id."""
    told = F.sha2(F.concat(F.lit(seed), F.coalesce(doc.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(told, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def cut_requests(rows: DataFrame, seed: str = SEED, cut_share: int = CUT_SHARE, spm_share: int = SPM_SHARE) -> DataFrame:
    """ROW, n, form, first, second of rows(ROW, id, text): units before the first and before the second cut."""
    h = _draws(F.col("id"), seed)
    sentinel = F.contains(F.col("text"), F.lit(PREFIX)) | F.contains(F.col("text"), F.lit(SUFFIX)) | F.contains(F.col("text"), F.lit(MIDDLE))
    form = F.when((F.col("text") == "") | sentinel | (h[2] % 100 >= cut_share), "plain").when(h[3] % 100 < spm_share, "spm").otherwise("psm")
    counted = rows.select(ROW, form.alias("form"), F.size(units(F.col("text"))).cast("bigint").alias("n"), h[0].alias("h1"), h[1].alias("h2"))
    one, two = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    return counted.select(ROW, "n", "form", F.least(one, two).alias("first"), F.greatest(one, two).alias("second"))


def cut_offsets(rows: DataFrame, cuts: DataFrame, count: int) -> DataFrame:
    """ROW, start, end: code points of each row of cuts before its first and before its second cut."""
    asked = cuts.filter("form <> 'plain'")
    dealt = rows.select(ROW, "text").join(broadcast_if_small(asked.select(ROW), count, 16), ROW, "left_semi").repartition(ROW)
    listed = dealt.select(ROW, F.posexplode(units(F.col("text"))).alias("at", "unit")).select(ROW, (F.col("at") + 1).cast("bigint").alias("ordinal"), F.length("unit").cast("bigint").alias("size"))
    summed = listed.select(ROW, "ordinal", F.expr(f"sum(size) OVER (PARTITION BY {ROW} ORDER BY ordinal ROWS UNBOUNDED PRECEDING)").alias("upto"))
    requests = asked.select(ROW, F.posexplode(F.array("first", "second")).alias("which", "ordinal"))
    met = requests.join(summed.hint("merge"), [ROW, "ordinal"], "left")
    upto = lambda k: F.coalesce(F.max(F.when(F.col("which") == k, F.col("upto"))), F.lit(0).cast("bigint"))
    return met.groupBy(ROW).agg(upto(0).alias("start"), upto(1).alias("end"))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED, cut_share: int = CUT_SHARE, spm_share: int = SPM_SHARE) -> DataFrame:
    """id, n, form, prefix_chars, middle_chars, text, output of every row of docs."""
    spark = docs.sparkSession
    rows = keyed(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), ROW)
    cuts = written(cut_requests(rows, seed, cut_share, spm_share), "cuts")
    count = cuts.count()
    # A join on (row, ordinal) may then use that both sides are dealt by row.
    with settings(spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
        spans = written(cut_offsets(rows, cuts, count), "spans")
    spans = written(cuts.join(broadcast_if_small(spans, count), ROW, "left").drop("first", "second"), "cut")
    found = rows.join(broadcast_if_small(spans, count, 96), ROW)
    prefix, middle = F.substring("text", F.lit(1), F.col("start").cast("int")), F.substring("text", (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int"))
    suffix = F.substring("text", (F.col("end") + 1).cast("int"), F.length("text"))
    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
    output = output.otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    return found.select("id", "n", "form", F.col("start").alias("prefix_chars"), (F.col("end") - F.col("start")).alias("middle_chars"), "text", output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that transform() made an output of."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    part = lambda k: F.element_at(parts, k)
    return F.when(form == "plain", output).when(form == "psm", F.concat(part(2), part(4), part(3))).otherwise(F.concat(part(3), part(4), part(2)))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's units, form and cut, with digests of its output and of the text rebuilt from that."""
    made = transform(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return made.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{UNIT}') AS u, sha256('{SEED}' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
e AS (SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
  CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= {CUT_SHARE} THEN 'plain'
       WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < {SPM_SHARE} THEN 'spm' ELSE 'psm' END AS form FROM d),
f AS (SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s FROM e)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM f
"""
