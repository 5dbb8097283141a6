"""Queries that find repeated documents, lines and passages."""

from pyspark.sql import functions as F

from starkeep.llm.linededup import drop_repeated_lines
from starkeep.llm.periodic import collapse_runs, strongest, with_periodic_tail
from starkeep.llm.queries.registry import query, table
from starkeep.llm.simhash import near_duplicates
from starkeep.llm.substrings import drop_repeated_passages

LINES = r"""
WITH lines AS (
  SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
repeated AS (
  SELECT key, max(doc_id) AS keep FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT doc_id, i, line, keep IS NOT NULL AND doc_id <> keep AS gone
  FROM lines LEFT JOIN repeated USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query(LINES)
def op2_line_dedup(spark, folder):
    kept = drop_repeated_lines(table(spark, folder, "documents"))
    text = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


@query()
def op7_simhash(spark, folder):
    return near_duplicates(table(spark, folder, "documents"))


@query()
def op9_substrings(spark, folder):
    kept = drop_repeated_passages(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op13_periodic_runs(spark, folder):
    docs = with_periodic_tail(table(spark, folder, "documents"))
    found = collapse_runs(docs).withColumn("top", strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )
