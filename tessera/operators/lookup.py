"""Keyed lookups and a static dimension join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ordering import earliest_per_key

# The forecast dimension (city, temperature, description).
FORECASTS = (
    ("Kigali", 25.0, "Sunny"),
    ("Nairobi", 22.0, "Cloudy"),
    ("Addis Ababa", 20.0, "Rainy"),
    ("Dar es Salaam", 28.0, "Sunny"),
)


def forecast_dimension(spark: SparkSession) -> DataFrame:
    """The four-row forecast table."""
    return spark.createDataFrame(list(FORECASTS), "city string, temperature double, description string")


def keyed_lookup(requests: DataFrame, table: DataFrame, key: str, seq: str,
                 cols: list[str]) -> DataFrame:
    """For each request, the first table row (in ``seq`` order) with the
    same key; misses give nulls and ``found = false``."""
    first = earliest_per_key(table, key, seq, cols).drop(seq).withColumnRenamed(key, "__k") \
        .withColumn("found", F.lit(True))
    out = requests.join(first, requests[key] == F.col("__k"), "left").drop("__k")
    return out.withColumn("found", F.coalesce(F.col("found"), F.lit(False)))


def forecast_lookup(requests: DataFrame, dimension: DataFrame) -> DataFrame:
    """Case-sensitive exact city match; a miss gets ``city_not_found``.
    The dimension has a fixed, tiny size, so it is broadcast."""
    dim = dimension.withColumnRenamed("city", "__city")
    out = requests.join(F.broadcast(dim), requests["city"] == F.col("__city"), "left")
    status = F.when(F.col("__city").isNull(), F.lit("city_not_found")).otherwise(F.lit("ok"))
    return out.withColumn("status", status).drop("__city")
