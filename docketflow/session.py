"""Session construction and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Sensible engine settings; a cluster's own values win when already set.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: str = "8", app: str = "docketflow", **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for local sessions."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="docketflow-ckpt-")
    sc.setCheckpointDir(named)
    return named


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and continue from the written rows.

    Cuts the lineage like a reliable checkpoint and survives the loss of executors; unlike
    one, the table is columnar, so later steps read only the columns they use and Spark knows
    its size when it picks joins.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
