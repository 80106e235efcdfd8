"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle after the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # partition values such as '007' stay text
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def get_session(
    app_name: str = "shelfwise", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings above; ``settings`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting: there one machine runs every
    task, so a temporary folder of its own is shared by all of them.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        shared = tempfile.mkdtemp(prefix="shelfwise-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df, label: str):
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage in a way that outlives lost executors; used before iterative
    fits and where several outputs share one expensive input.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
