"""Change hash and table fingerprint."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# They decide the bytes of the hash.
NULL_MARK = "<<NULL>>"
SEPARATOR = "||"


def change_hash(columns: list[str] | tuple[str, ...]) -> Column:
    """SHA-256 (32 raw bytes) over the columns as text.

    The NULL mark keeps NULL and ``""`` apart, the separator keeps ``("ab", "c")`` and
    ``("a", "bc")`` apart. Without columns the hash is the same for every row.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    text = F.concat_ws(SEPARATOR, *parts) if parts else F.lit("")
    return F.unhex(F.sha2(text, 256))


def change_hash_json(columns: list[str] | tuple[str, ...]) -> Column:
    """As :func:`change_hash`, over JSON text: no value can imitate mark or separator."""
    row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return F.unhex(F.sha2(row, 256))


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that is the same for the same rows in any order.

    Count, XOR and sum of row hashes: XOR alone would lose rows that occur twice.
    """
    row = F.xxhash64(*sorted(df.columns))
    return df.select(row.alias("h")).agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("hash_xor"),
        F.coalesce(F.sum(F.col("h").cast("decimal(20,0)")), F.lit(0))
        .cast("decimal(38,0)")
        .alias("hash_sum"),
    )
