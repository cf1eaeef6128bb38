"""Metadata reduced to one normalised row per document key.

Text is normalised before the shuffle: what crosses the network is clipped columns and the
computed labels.  The long description travels only for rows without a title, whose case type
needs the object's own name and is finished after the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.functions.case_types import with_case_type
from docketflow.functions.dates import decision_date, decision_year
from docketflow.functions.judges import bench_type
from docketflow.functions.text import basename, clip, first_nonblank, joined, nonblank
from docketflow.operators.keyed import last_rows


def _typed(rows: DataFrame) -> DataFrame:
    """Add the case type of titled rows, keeping the description of untitled ones."""
    titled = F.col("title").isNotNull()
    typed = with_case_type(rows, "title_type", "title", F.when(titled, F.col("description")))
    return typed.withColumn(
        "loose_description", F.when(~titled, nonblank("description"))
    ).drop("description")


def _judged(rows: DataFrame) -> DataFrame:
    return rows.withColumn("bench_type", bench_type("judges"))


def hc_index(metadata: DataFrame) -> DataFrame:
    """(year, court_code, bench, filename) -> struct ``last``; the last row of a key wins."""
    named = metadata.where(nonblank("pdf_link").isNotNull()).select(
        "year", "court_code", "bench", basename("pdf_link").alias("filename"), "ord",
        clip("title", 500).alias("title"), "description",
        clip("cnr", 64).alias("cnr"), clip("judge", 1000).alias("judges"),
        decision_year("decision_date").alias("decision_year"),
        decision_date("decision_date").alias("decision_date"),
        clip("court", 255).alias("court_text"), clip("disposal_nature", 5000).alias("outcome"),
    )
    return last_rows(
        _judged(_typed(named)), ["year", "court_code", "bench", "filename"], "ord")


def sc_index(metadata: DataFrame) -> DataFrame:
    """(year, path) -> struct ``last``; the last row of a key wins."""
    named = metadata.where(nonblank("path").isNotNull()).select(
        "year", "path", "ord", clip("title", 500).alias("title"), "description",
        first_nonblank(clip("citation", 200), clip("nc_display", 200), clip("case_id", 200))
        .alias("reported_citation"),
        joined(" | ", clip("judge", 500), clip("author_judge", 400)).alias("judges"),
        joined(" vs ", clip("petitioner", 900), clip("respondent", 900)).alias("parties"),
        decision_year("decision_date").alias("decision_year"),
        decision_date("decision_date").alias("decision_date"),
        clip("court", 255).alias("court_text"), clip("disposal_nature", 5000).alias("outcome"),
        clip("cnr", 64).alias("cnr"),
    )
    return last_rows(_judged(_typed(named)), ["year", "path"], "ord")
