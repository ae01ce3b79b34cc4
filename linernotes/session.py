"""Spark session from a settings dictionary, and the shared folder for written intermediates."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(conf: dict[str, str], app_name: str = "linernotes") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/shared"
    return folder.rstrip("/")
