"""Intermediate tables that leave no shuffle files behind."""

from pyspark.sql import DataFrame

from starkeep.sources.files import materialize

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, label: str) -> DataFrame:
    """``materialize``, after which the shuffle files of the plan are deleted.

    Once the table stands in the shared folder nothing reads them; else they would wait until the
    driver happens to collect its garbage, and count as disk beside the next steps' files.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        return materialize(df, label)
    finally:
        conf.set(CLEANUP, before)
