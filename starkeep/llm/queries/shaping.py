"""Queries that compose and format training data."""

from pyspark.sql import functions as F

from starkeep.llm.chats import format_chats, messages_of
from starkeep.llm.mixing import mix
from starkeep.llm.queries.registry import query, table
from starkeep.llm.sharding import place


@query()
def op3_mixing(spark, folder):
    columns = ["doc_id", "size", "source_size", "target", "taken", "shards"]
    return mix(table(spark, folder, "documents").select("doc_id", "source", "text")).select(*columns)


#: The one tool of plain chats.
TOOLS = """
SELECT 'reply' AS tool, array(
  named_struct('name', 'prompt', 'type', 'string', 'required', true),
  named_struct('name', 'turn', 'type', 'integer', 'required', true)) AS fields
"""

CHATS = """
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
q AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) - 1 AS depth
  FROM (SELECT *, turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island
        FROM t WHERE role = 'user')),
a AS (SELECT * FROM t WHERE role = 'assistant')
SELECT q.conv_id, 2 * depth AS level, q.turn, 'call' AS kind, q.turn::VARCHAR AS id,
  a.turn IS NOT NULL AS linked, '' AS faults,
  '{"arguments":{"prompt":' || to_json(q.text) || ',"turn":' || q.turn || '},"id":"' || q.turn
    || '","name":"reply","turn":' || q.turn || '}' AS line
FROM q LEFT JOIN a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
UNION ALL
SELECT a.conv_id, 2 * depth + 1, a.turn, 'result', (a.turn - 1)::VARCHAR, q.turn IS NOT NULL, NULL,
  '{"content":' || to_json(a.text) || ',"tool_call_id":"' || (a.turn - 1) || '","turn":' || a.turn || '}'
FROM a LEFT JOIN q ON q.conv_id = a.conv_id AND q.turn = a.turn - 1
UNION ALL
SELECT conv_id, -1, turn, 'message', NULL, NULL, NULL,
  '{"content":' || to_json(text) || ',"role":' || to_json(role) || ',"turn":' || turn || '}'
FROM t WHERE role NOT IN ('user', 'assistant')
"""


@query(CHATS)
def op4_chats(spark, folder):
    messages = messages_of(table(spark, folder, "conversations"))
    lines = format_chats(messages, spark.sql(TOOLS), whole=True)
    return lines.withColumn("faults", F.array_join("faults", ","))


@query()
def op12_sharding(spark, folder):
    placed = place(table(spark, folder, "documents").select("doc_id", "text"))
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)
