"""Sweeps over settings: grids and random draws as tables, runs as a join."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def grid(spark: SparkSession, parameters: dict[str, list[Any]]) -> DataFrame:
    """Every combination of the parameters' values, numbered; an explode for each parameter."""
    out = spark.range(1).select(F.lit(0).alias("_"))
    for name, values in parameters.items():
        out = out.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    key = F.xxhash64(*parameters) if parameters else F.lit(0)
    return out.drop("_").withColumn("config_id", key)


def random_draws(spark: SparkSession, parameters: dict[str, list[Any]], n: int, seed: int = 0) -> DataFrame:
    """``n`` different combinations, reproducible."""
    return grid(spark, parameters).orderBy(F.xxhash64(*parameters, F.lit(seed)), *parameters).limit(n)


def filter_sweep(cells: DataFrame, settings: DataFrame) -> DataFrame:
    """(config_id, cells, passed) of bounds area_min and area_max: one pass over the cells for all settings.

    Settings are a written list of runs, so that they are broadcast.
    """
    passed = (F.col("area_px") >= F.col("area_min")) & (F.col("area_px") <= F.col("area_max"))
    return cells.select("area_px").join(F.broadcast(settings), how="cross").groupBy("config_id").agg(F.count("*").alias("n_cells"), F.count_if(passed).alias("n_passed"))
