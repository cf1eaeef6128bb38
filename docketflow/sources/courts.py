"""The court dimension: 25 rows, always safe to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.functions.courts import COURT_NAMES, COURT_STATES


def court_dimension(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{c}', '{n}', '{COURT_STATES[c]}')" for c, n in COURT_NAMES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(court_code, court_name, state_name)")


def court_names_from_json(spark: SparkSession, path: str) -> DataFrame:
    """Code and name from a JSON object; the file form of a code uses a tilde."""
    doc = spark.read.text(path, wholetext=True)
    pairs = doc.select(F.explode(F.from_json("value", "map<string,string>")).alias("k", "v"))
    return pairs.select(
        F.translate("k", "~", "_").alias("court_code"), F.col("v").alias("court_name")
    )
