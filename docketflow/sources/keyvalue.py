"""Key-value settings: decoded reads and last-write-wins upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.functions.text import col, strip
from docketflow.operators.keyed import last_per_key


def decoded(value: Column | str) -> Column:
    """The JSON value as text (strings unquoted, null as NULL); raw text when it is not JSON."""
    value = col(value)
    parsed = F.try_parse_json(value)
    text = F.try_variant_get(parsed, "$", "string")
    return F.when(strip(value) == "null", F.lit(None).cast("string")).when(
        parsed.isNotNull(), text
    ).otherwise(value)


def get_setting(meta: DataFrame, key: str, default: str | None = None) -> DataFrame:
    """One row with the decoded value of ``key``, or ``default`` when the key is absent."""
    hit = meta.where(F.col("key") == key)
    return hit.agg(
        F.when(F.count("*") == 0, F.lit(default)).otherwise(F.max(decoded("value"))).alias("value")
    )


def upsert_settings(meta: DataFrame, writes: DataFrame) -> DataFrame:
    """Apply ``writes`` (key, value, seq) over ``meta``; the highest ``seq`` of a key stays.

    Partial aggregation keeps one row per key and task, so a much-written key stays cheap.
    """
    base = meta.select("key", "value", F.lit(None).cast("long").alias("seq"))
    both = base.unionByName(writes.select("key", "value", F.col("seq").cast("long")))
    ranked = both.withColumn("rank", F.coalesce("seq", F.lit(-(2**62))))
    return last_per_key(ranked.drop("seq"), ["key"], "rank").select("key", "last.value")
