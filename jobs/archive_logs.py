"""Archives the logs of runs as they come: what ended each, how often watched lines occur in it, and its text without secrets.

    python -m jobs.archive_logs --logs FOLDER_OR_PATTERN --output FOLDER --checkpoint FOLDER [--config FILE]

A file stream that takes the files which are new since the last run, all of them, and
ends.  The checkpoint holds which files were taken; the sink writes each batch once,
also when a run died in it.  Output: Parquet, one folder for each job.
"""

from __future__ import annotations

import argparse
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.functions import identity
from jobs import common

REQUIRED = ("logs",)


def _matching(lines: Column, pattern: str) -> Column:
    return F.size(F.filter(lines, lambda line: line.rlike(pattern)))


def triaged(logs: DataFrame, watch: dict[str, str], outcomes: list[list[str]]) -> DataFrame:
    """One row for each log (log_id, job, text), in any kind of DataFrame.

    ``outcome`` is what `identity.diagnose_log` says, else the first of ``outcomes``
    (name, pattern) that is found, else ``ok``, and ``empty`` for null and empty texts; ``lines_<name>`` counts the lines that a watched
    pattern matches.  Texts of any length are read whole; repeated logs stay; logs
    of no job are of the job ``none``.
    """
    text = F.coalesce("text", F.lit(""))
    clean = identity.redacted_text(text)
    lines = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n"))
    told = [F.when(text.rlike(pattern), name) for name, pattern in outcomes]
    outcome = F.when(text == "", "empty").otherwise(F.coalesce(identity.diagnose_log(text), *told, F.lit("ok")))
    counts = [_matching(lines, pattern).alias(f"lines_{name}") for name, pattern in sorted(watch.items())]
    return logs.select(
        "log_id", outcome.alias("outcome"), identity.transient_submit_error(text).alias("transient"), F.size(lines).alias("n_lines"), *counts,
        identity.count_secrets(text).alias("n_secrets"), F.sha2(clean, 256).alias("clean_sha256"), clean.alias("clean_text"), F.coalesce(F.nullif(F.trim(F.col("job").cast("string")), F.lit("")), F.lit("none")).alias("job"),
    )


def _mapped(logs: DataFrame, config: dict[str, Any]) -> DataFrame:
    return triaged(common.selected(logs, config["logs"]), config["watch"], config["outcomes"])


def run(spark: SparkSession, logs_path: str, output: str, checkpoint: str, config: dict[str, Any]) -> dict[str, int]:
    """Take the files that came since the checkpoint, write their logs, log and return how many batches and rows there were."""
    log = common.logger("archive_logs")
    log.info("reads new files of %s", logs_path)
    schema = spark.read.parquet(logs_path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", int(config["files_per_batch"])).parquet(logs_path)
    query = _mapped(stream, config).writeStream.format("parquet").partitionBy("job").option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    done = [p for p in query.recentProgress if p["numInputRows"]]
    counts = {"batches": len(done), "rows": sum(p["numInputRows"] for p in done)}
    log.info("wrote %s to %s", counts, output)
    return counts


def read_output(spark: SparkSession, logs_path: str, output: str, config: dict[str, Any]) -> DataFrame:
    schema = _mapped(spark.read.parquet(logs_path).limit(0), config).schema
    return common.read_back(spark, output, schema)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="archive_logs", description=__doc__.splitlines()[0])
    for flag in ("--logs", "--output", "--checkpoint"):
        parser.add_argument(flag, required=True)
    parser.add_argument("--config")
    args = parser.parse_args(argv)
    common.log_to_stderr()
    config = common.load_config(args.config, "archive_logs.json", REQUIRED)
    from cytoframe.session import session

    spark = session("archive_logs")
    try:
        run(spark, args.logs, args.output, args.checkpoint, config)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
