"""Queries that judge documents."""

from pyspark.sql import functions as F

from starkeep.llm import langid
from starkeep.llm.decontamination import find_items
from starkeep.llm.licenses import scan, scan_sql
from starkeep.llm.queries.registry import query, table
from starkeep.llm.toxicity import fit, score


def crc_part(column, parts):
    """The remainder by which the contracts hold documents out."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(parts))


@query()
def op1_decontamination(spark, folder):
    return find_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query(scan_sql())
def op5_licenses(spark, folder):
    columns = "doc_id n_words n_base first_word last_word base_labels labels score".split()
    return scan(table(spark, folder, "documents").select("doc_id", "text")).select(*columns)


@query()
def op6_langid(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_part("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    model = langid.fit(docs.filter(crc_part("doc_id", 3) != 1))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out, "lang_pred", "score")


@query()
def op8_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    model = fit(docs, labels.filter(crc_part("doc_id", 4) != 2))
    held_out = F.coalesce(crc_part("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return score(docs, model).select("doc_id", held_out, "score", "predicted", "spans")
