"""Column selection and schema conformance."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; absent ones are ignored."""
    return df.withColumnsRenamed(dict(names))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns in its order.

    Unknown columns are dropped, missing ones become NULL, values of another type are
    cast and become NULL where that fails.
    """
    have = dict(df.dtypes)

    def column(field: T.StructField):
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        col = F.col(f"`{field.name}`")
        if have[field.name] != field.dataType.simpleString():
            col = col.try_cast(field.dataType).alias(field.name)
        return col

    return df.select(*[column(f) for f in schema.fields])


def tag_columns(df: DataFrame, tags: Mapping[str, Mapping]) -> DataFrame:
    """Attach metadata to columns, e.g. the geographic role of a coordinate."""
    for name, tag in tags.items():
        df = df.withMetadata(name, dict(tag))
    return df
