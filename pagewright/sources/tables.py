"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Table of a folder.  A table in fewer splits than the cluster has cores (one small file) is spread over
    them, as its rows are worth more work than their move; a larger one is read as it lies.  Projections and
    filters pass through to the scan either way."""
    df = spark.read.parquet(f"{d}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
