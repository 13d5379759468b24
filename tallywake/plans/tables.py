"""The `events` and `pages` tables in the roles the operators need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywake.session import configure


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def item_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the number in `props` as item."""
    return events(spark, folder).withColumn("item_id", F.get_json_object("props", "$.k").cast("bigint"))
