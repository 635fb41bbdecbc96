"""Parquet tables as scan inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table as a DataFrame, listed anew at every call."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def deal_single_split(df: DataFrame) -> DataFrame:
    """``df``, dealt to all cores if its scan is a single task.  A file of one
    split (128 MB at most by default) would else be parsed by one core.  A table of
    more splits is left as it is: nothing is shuffled that a scan already spreads.
    Planning only; no job runs."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if cores > 1 and df.rdd.getNumPartitions() == 1 else df
