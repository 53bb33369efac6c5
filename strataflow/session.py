"""Session defaults, layer paths and the one place that cuts lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("landing", "raw", "curated", "consumption", "governance")


def build_session(app: str = "strataflow", master: str | None = None, **conf: str) -> SparkSession:
    """UTC session with adaptive execution; `master` is only given for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def layer_path(root: str, layer: str, table: str) -> str:
    """Path of a table inside one of the layers."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
    return f"{root.rstrip('/')}/{layer}/{table}"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder: there the driver's disk is
    the executors' disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="strataflow-checkpoint-")
    sc.setCheckpointDir(path)
    return path


def stage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared folder so every later branch sees the same rows.

    Reliable checkpoint: the files outlive any executor, and the plan above no longer
    depends on a sampled range partitioning being reproduced.
    """
    spark = df.sparkSession
    path = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return df.checkpoint(eager=True)
