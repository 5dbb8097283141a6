"""Rows that break a table's rules, set aside with the rules they break.

The gates of ``quality`` count violations and stop a load; here each row learns which rules it breaks, so that the
others can be loaded.
"""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkeep.operators.joins import left_lookup
from starkeep.operators.quality import Contract, duplicates, orphans

BROKEN = "broken_rules"


def tag_rules(
    df: DataFrame,
    contract: Contract,
    members: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """Every row with ``broken_rules``, the sorted names of the rules it breaks; empty for a sound row.

    Not-null rules are looked at in place. Repeated keys and foreign keys without a member are found by counting, and
    only the bad values, few as a rule, are looked up; all rows that share a unique key break its rule. Rules over columns that ``df``
    lacks do not apply. Use it on a published or materialized frame: it is read once for each counted rule.
    """
    have = set(df.columns)
    required = [f.name for f in contract.schema.fields if not f.nullable and f.name in have]
    rules = [F.when(F.col(c).isNull(), F.lit(f"not null: {c}")) for c in required]
    tagged = df
    for i, keys in enumerate(k for k in contract.unique if have.issuperset(k)):
        bad = duplicates(df, keys).select(*keys, F.lit(True).alias("_bad"))
        tagged = left_lookup(tagged, bad, {k: k for k in keys}, {"_bad": f"_unique{i}"}, probe=df)
        rules.append(F.when(F.col(f"_unique{i}"), F.lit(f"unique: {', '.join(keys)}")))
    for i, (key, (dimension, member)) in enumerate((members or {}).items()):
        bad = orphans(df, key, dimension, member).select("key", F.lit(True).alias("_bad"))
        tagged = left_lookup(tagged, bad, {key: "key"}, {"_bad": f"_member{i}"}, null_safe=True, probe=df)
        rules.append(F.when(F.col(f"_member{i}"), F.lit(f"member: {key}")))
    broken = F.array_sort(F.array_compact(F.array(*rules))) if rules else F.array().cast("array<string>")
    return tagged.select(*df.columns, broken.alias(BROKEN))


def split_rejects(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sound rows without their tag, and the others with it."""
    sound = F.size(BROKEN) == 0
    return tagged.filter(sound).drop(BROKEN), tagged.filter(~sound)


def rule_counts(rejects: DataFrame) -> DataFrame:
    """``(rule, n_violations)`` over rejected rows."""
    rules = rejects.select(F.explode(BROKEN).alias("rule"))
    return rules.groupBy("rule").agg(F.count("*").alias("n_violations"))
