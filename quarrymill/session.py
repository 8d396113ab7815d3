"""Session settings the library expects; every value can be overridden by the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build_session(name: str = "quarrymill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS, then conf (dots written as double underscores)."""
    builder = SparkSession.builder.appName(name).config(map=DEFAULTS)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give Python workers the package, where it isn't installed on them and isn't on their path."""
    import os
    import shutil
    import tempfile

    at = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="quarrymill-"), "quarrymill"), "zip", at, "quarrymill"))


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the given tables; Spark's reader opens it, so any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df, times: int = 4):
    """Rows dealt out to a few tasks for each core: a small file of many rows is one task of the scan, however much work a row is."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism * times)
