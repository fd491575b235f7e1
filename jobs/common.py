"""What both jobs share: their config files, logs and the tables that they read."""

from __future__ import annotations

import json
import logging
import sys
from pathlib import Path
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

HERE = Path(__file__).resolve().parent


def load_config(path: str | None, default: str, required: tuple[str, ...]) -> dict[str, Any]:
    """A job's settings, of the file beside it unless another is named; unknown and missing keys are errors."""
    file = Path(path) if path else HERE / default
    found = json.loads(file.read_text(encoding="utf-8"))
    allowed = json.loads((HERE / default).read_text(encoding="utf-8"))
    if not isinstance(found, dict) or (wrong := set(found) - set(allowed)) or (wrong := set(required) - set(found)):
        raise ValueError(f"{file.name} is no object, or these keys are unknown or missing: {sorted(wrong) if isinstance(found, dict) else 'all'}")
    return allowed | found


def selected(table: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """A table under the library's names, each an SQL expression of the config."""
    return table.select(*[F.expr(e).alias(name) for name, e in expressions.items()])


def logger(name: str) -> logging.Logger:
    return logging.getLogger(f"jobs.{name}")


def log_to_stderr() -> None:
    logging.basicConfig(stream=sys.stderr, level=logging.INFO, format="%(asctime)s %(name)s %(message)s")


def read_back(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """A job's whole output as it stands; no rows where nothing was ever written."""
    try:
        # With the schema, names of folders stay texts: "007" is no number.
        return spark.read.schema(schema).parquet(folder).select(*schema.names)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
