"""Header names to snake_case."""

import re

from pyspark.sql import DataFrame


def to_snake_case(name: str) -> str:
    """``"FBI Code"`` -> ``"fbi_code"``, ``"xCoordinate"`` -> ``"x_coordinate"``."""
    words = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", name)
    return "_".join(re.findall(r"[0-9a-zA-Z]+", words)).lower()


def snake_columns(df: DataFrame) -> DataFrame:
    """Rename every column at once; two headers that fall together are an error."""
    names = [to_snake_case(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"headers are the same in snake_case: {clashes}")
    return df.toDF(*names)
