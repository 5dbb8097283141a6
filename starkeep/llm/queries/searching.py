"""Queries that search vectors."""

from pyspark.sql import functions as F

from starkeep.llm.negatives import mine
from starkeep.llm.neighbours import nearest
from starkeep.llm.queries.registry import query, table


@query()
def op10_neighbours(spark, folder):
    return nearest(table(spark, folder, "embeddings").select("vec_id", "embedding"))


NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS u, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.u AS a, a.vec_id AS anchor_id, o.u, o.vec_id, a.label = o.label AS same,
    list_dot_product(a.parts, o.parts)::BIGINT AS score
  FROM v AS a JOIN v AS o ON a.u <> o.u AND len(a.parts) = len(o.parts)
  WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, u) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
  (row_number() OVER (PARTITION BY p.a, p.u ORDER BY n.score DESC, n.vec_id, n.u))::INTEGER AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s AS n ON n.a = p.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""


@query(NEGATIVES)
def op11_hard_negatives(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", moved))
