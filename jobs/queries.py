"""The jobs as registered queries: each runs twice into one new folder and returns its whole output after the second run."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cytoframe.plans.checkpoints import folder
from jobs import archive_logs, common, publish_cells


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def job1_publish_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = common.load_config(None, "publish_cells.json", publish_cells.REQUIRED)
    out = _new_folder(spark, "job1")
    for _ in range(2):
        publish_cells.run(spark, f"{sf_dir}/lineitem.parquet", f"{sf_dir}/orders.parquet", f"{sf_dir}/part.parquet", f"{out}/cells", config)
    return publish_cells.read_output(spark, f"{out}/cells")


def job2_archive_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = common.load_config(None, "archive_logs.json", archive_logs.REQUIRED)
    out = _new_folder(spark, "job2")
    # As a pattern: a file stream takes a folder or what a pattern finds, and the table may be one file.
    logs = f"{sf_dir}/documents.parque[t]"
    for _ in range(2):
        archive_logs.run(spark, logs, f"{out}/logs", f"{out}/checkpoint", config)
    return archive_logs.read_output(spark, logs, f"{out}/logs", config)


_JOB1_SQL = """
WITH c AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS image_id, l_linenumber AS label, l_partkey AS r0, l_suppkey AS c0, l_partkey + CAST(trunc(l_quantity) AS BIGINT) AS r1, l_suppkey + CAST(trunc(l_quantity) AS BIGINT) AS c1,
    l_quantity AS area_px, l_discount AS aspect_ratio, 1 - l_tax AS solidity, l_extendedprice AS intensity, CAST(l_partkey AS VARCHAR) AS padmap_id,
    array_to_string(list_filter([CASE WHEN NOT coalesce(l_returnflag <> 'R', false) THEN 'segmenter_excluded' END,
      CASE WHEN l_quantity IS NULL THEN 'area_px:not_finite' WHEN l_quantity < 8 * (0.15 / 0.10) * (0.15 / 0.10) THEN 'area_px:below_min' WHEN l_quantity > 20 * (0.15 / 0.10) * (0.15 / 0.10) THEN 'area_px:above_max' END,
      CASE WHEN l_discount IS NULL THEN 'aspect_ratio:not_finite' WHEN l_discount < 0.02 THEN 'aspect_ratio:below_min' END,
      CASE WHEN l_tax IS NULL THEN 'solidity:not_finite' WHEN 1 - l_tax < CAST(0.93 AS DOUBLE) THEN 'solidity:below_min' END], lambda x: x IS NOT NULL), ';') AS filter_reasons
  FROM lineitem),
i AS (SELECT CAST(o_orderkey AS VARCHAR) AS image_id, o_orderkey || '_Phase.tif' AS name, strftime(o_orderdate, '%Y-%m') AS month FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate NULLS FIRST) = 1),
p AS (SELECT CAST(p_partkey AS VARCHAR) AS padmap_id, min(CASE WHEN p_size <= 25 THEN p_brand END) AS drug FROM part GROUP BY 1)
SELECT 'sc_' || substr(sha256(coalesce(i.name, c.image_id) || '|' || label || '|' || r0 || ',' || c0 || ',' || r1 || ',' || c1), 1, 16) AS cell_id, image_id, label, area_px, aspect_ratio, solidity, intensity,
  filter_reasons = '' AS filter_passed, filter_reasons, coalesce(p.drug, 'UNK') AS drug, coalesce(i.month, 'unknown') AS month
FROM c LEFT JOIN i USING (image_id) LEFT JOIN p USING (padmap_id)
"""

_SECRET = r"([A-Za-z0-9_]*(?i:secret|password|token|api_key)[A-Za-z0-9_]*[ \t]*[=:][ \t]*)(\"[^\"\n]*\"|''[^''\n]*''|[^ \t\n\r\"'']+)"
_JOB2_SQL = f"""
WITH d AS (SELECT doc_id AS log_id, coalesce(nullif(trim(source), ''), 'none') AS job, coalesce(text, '') AS t FROM documents),
e AS (SELECT *, CASE WHEN t = '' THEN [] ELSE string_split(t, chr(10)) END AS lines, regexp_replace(t, '{_SECRET}', '\\1<redacted>', 'g') AS clean_text, len(regexp_extract_all(t, '{_SECRET}')) AS n_secrets FROM d)
SELECT log_id, CASE WHEN t = '' THEN 'empty' WHEN regexp_matches(lower(t), 'oom[- ]?kill|out of memory|memoryerror') THEN 'out of memory' WHEN regexp_matches(lower(t), 'due to time limit|timelimit') THEN 'time limit'
    ELSE coalesce(regexp_extract_all(t, '(?m)^([A-Za-z_.]+(?:Error|Exception)\\b.*)$', 1)[-1], CASE WHEN regexp_matches(t, '[Ll]icensed? under') THEN 'licence notice' WHEN regexp_matches(t, '(token|password|secret) *=') THEN 'leaked secret' WHEN regexp_matches(t, 'https?://') THEN 'page' END, 'ok') END AS outcome,
  regexp_matches(lower(t), 'timed out|temporarily unavailable|connection refused|unable to contact|socket|try again') AS transient, CAST(len(lines) AS INTEGER) AS n_lines,
  CAST(len(list_filter(lines, lambda x: regexp_matches(x, '[Ll]icensed? under'))) AS INTEGER) AS lines_licence, CAST(len(list_filter(lines, lambda x: regexp_matches(x, '[0-9]{{8,}}'))) AS INTEGER) AS lines_long_number,
  CAST(len(list_filter(lines, lambda x: regexp_matches(x, '[A-Za-z0-9._]+@[A-Za-z0-9.]+'))) AS INTEGER) AS lines_mail, CAST(n_secrets AS INTEGER) AS n_secrets, sha256(clean_text) AS clean_sha256, clean_text, job
FROM e
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (job1_publish_cells, job2_archive_logs)}


def oracle_sql() -> dict[str, str]:
    return {"job1_publish_cells": _JOB1_SQL, "job2_archive_logs": _JOB2_SQL}
