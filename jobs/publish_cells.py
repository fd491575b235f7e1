"""Publishes the cells of a run: each with its identity, the reasons why it fails the rules, its treatment label and the month of its image.

    python -m jobs.publish_cells --cells CELLS --images IMAGES --registry REGISTRY --output FOLDER [--config FILE]

Output: Parquet, one folder for each month.  A run replaces the months that its input
has and no other, so that a run again gives the same files' rows, and a backfill of
some months leaves the others as they are.
"""

from __future__ import annotations

import argparse
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cytoframe import schemas
from cytoframe.functions import identity
from cytoframe.operators import filtering, labels
from jobs import common

REQUIRED = ("cells", "images", "registry", "rules")
NO_MONTH = "unknown"
COLUMNS = ["cell_id", "image_id", "label", "area_px", "aspect_ratio", "solidity", "intensity", "filter_passed", "filter_reasons", "drug", "month"]


def published(cells: DataFrame, images: DataFrame, registry: DataFrame, config: dict[str, Any], names: dict[str, str] | None = None) -> DataFrame:
    """One row for each cell, whether it passes or not; a month's rows lie together.

    Cells of an image that the table of images lacks, or whose time is null, go to
    the month ``unknown`` and are named after the image's id; cells without a label
    are ``UNK``; of several images or labels of a key the least counts; repeated
    cells stay.

    ``names`` are the library's columns, each an SQL expression over ``cells``: they
    and the texts made of them come after the last shuffle, before which rows hold
    no more than what the expressions read, and of an identity its eight bytes.
    """
    names = names or {c: f"`{c}`" for c in cells.columns}
    one_label = registry.groupBy(F.col("padmap_id").alias("_padmap_id")).agg(F.min("padmap_drug").alias("_drug"))
    one_image = images.groupBy(F.col("image_id").alias("_image_id")).agg(F.min(F.struct("acquired", "source_path")).alias("_image"))
    month = F.coalesce(F.date_format("_image.acquired", "yyyy-MM"), F.lit(NO_MONTH)).alias("_month")
    # Images last: rows of an image then lie side by side, so that the shuffle by month packs what they share.
    placed = cells.join(one_label, F.expr(names["padmap_id"]) == F.col("_padmap_id"), "left").join(one_image, F.expr(names["image_id"]) == F.col("_image_id"), "left")
    made = {name: F.expr(e) for name, e in names.items()}
    digest = identity.cell_hash(F.coalesce("_image.source_path", made["image_id"]), made["label"], [made[b] for b in schemas.BBOX])
    placed = placed.select(*[F.col(f"`{c}`") for c in cells.columns], "_drug", F.unhex(digest).alias("_digest"), month)
    # Months differ in size: a large one is split into several files, small ones go together to one task.
    named = placed.hint("rebalance", "_month").select(*[e.alias(name) for name, e in made.items()], "_drug", "_digest", "_month")
    scale = float(config["reference_pixel_microns"]) / float(config["pixel_microns"])
    judged = filtering.filter_cells(named, config["rules"], bool(config["require_included"]), scale)
    own = F.nullif("drug", F.lit("")) if "drug" in names else F.lit(None).cast("string")
    name = F.concat(F.lit("sc_"), F.lower(F.hex("_digest")))
    drug = F.coalesce(F.nullif("_drug", F.lit("")), own, F.lit(labels.UNKNOWN))
    return judged.select(name.alias("cell_id"), *COLUMNS[1:-2], drug.alias("drug"), F.col("_month").alias("month"))


def run(spark: SparkSession, cells_path: str, images_path: str, registry_path: str, output: str, config: dict[str, Any]) -> dict[str, int]:
    """Read the three tables, write the months that they have, log and return what was read and written."""
    log = common.logger("publish_cells")
    cells = spark.read.parquet(cells_path)
    images, registry = (common.selected(spark.read.parquet(path), config[name]) for name, path in (("images", images_path), ("registry", registry_path)))
    log.info("reads cells %s, images %s, registry %s", cells_path, images_path, registry_path)
    if cells.isEmpty():  # Spark plans a table without rows away, and what observes it too
        log.info("no cells, nothing is written to %s", output)
        return dict.fromkeys(("cells", "passed", "unlabelled", "without_month"), 0)
    seen = Observation()
    out = published(cells, images, registry, config, config["cells"]).observe(
        seen, F.count(F.lit(1)).alias("cells"), F.count_if("filter_passed").alias("passed"), F.count_if(F.col("drug") == labels.UNKNOWN).alias("unlabelled"), F.count_if(F.col("month") == NO_MONTH).alias("without_month")
    )
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(output)
    counts = dict(seen.get)
    log.info("wrote %s to %s", counts, output)
    return counts


def read_output(spark: SparkSession, output: str) -> DataFrame:
    schema = "cell_id string, image_id string, label int, area_px double, aspect_ratio double, solidity double, intensity double, filter_passed boolean, filter_reasons string, drug string, month string"
    return common.read_back(spark, output, spark.createDataFrame([], schema).schema)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="publish_cells", description=__doc__.splitlines()[0])
    for flag in ("--cells", "--images", "--registry", "--output"):
        parser.add_argument(flag, required=True)
    parser.add_argument("--config")
    args = parser.parse_args(argv)
    common.log_to_stderr()
    config = common.load_config(args.config, "publish_cells.json", REQUIRED)
    from cytoframe.session import session

    spark = session("publish_cells")
    try:
        run(spark, args.cells, args.images, args.registry, args.output, config)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
