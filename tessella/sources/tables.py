"""Parquet tables by name, read with the columns that are used and spread over the cores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, least: int | None = None) -> DataFrame:
    """For CPU-bound operators: a table that comes as fewer splits than there are cores is redistributed; one with
    enough splits, as any large table has, is left alone and isn't shuffled. Only for scans: asking a plan with a shuffle
    for its partitions would run it."""
    cores = least or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
