"""Spark sessions and the folder that all executors share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that the operators expect: UTC, errors instead of silent nulls, and plans that adapt at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    """A session with these settings; the cluster's own come first where none is given here."""
    builder = SparkSession.builder.appName("tarn")
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share. Where that is unset, one in /tmp, for a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file:///tmp/checkpoints/{os.getuid()}"
    return f"{base.rstrip('/')}/tarn-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df, written as Parquet to the shared folder and read back: cuts lineage and survives lost executors. What its shuffles left on disk goes as soon as it is written."""
    spark = df.sparkSession
    path = shared_dir(spark)
    if spark.conf.get(_CLEAN, None) != "true":
        spark.conf.set(_CLEAN, "true")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that `written` made, after their last read."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
