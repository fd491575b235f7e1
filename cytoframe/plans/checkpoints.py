"""Cutting a plan's lineage with files that every executor sees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The shared folder that the session names; a local session that names none, as in tests, has it below its warehouse."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("a cluster's session has to name its shared folder in spark.checkpoint.dir")
    return named or spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints"


def checkpointed(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder(spark))
    return df.checkpoint(eager=True)
