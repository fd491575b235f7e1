"""A whole run: images to labelled, filtered, numbered cells, as one plan with few written tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe import schemas
from cytoframe.functions.identity import cell_id, ensure_provenance, filename_metadata
from cytoframe.operators import export, filtering, joins, labels, pixels, segmentation
from cytoframe.plans.checkpoints import checkpointed
from cytoframe.plans.config import Run


def image_table(planes: DataFrame, masks: DataFrame) -> DataFrame:
    """(image_id, height, width, labels, planes): one row for each image that has a mask."""
    by_image = planes.groupBy("image_id").agg(F.map_from_entries(F.collect_list(F.struct("channel", "pixels"))).alias("planes"))
    return masks.select("image_id", "height", "width", "labels").join(by_image, "image_id")


def segment(planes: DataFrame, run: Run) -> DataFrame:
    """Masks of the phase planes."""
    s = run.scaled()["segmentation"]
    phase = planes.where((F.col("channel") == run.segmentation.phase_channel) & F.col("pixels").isNotNull())
    return segmentation.label_planes(phase.select("image_id", "height", "width", "pixels"), s["method"], s["min_particle_size"], s["min_hole_size"])


def cells_of(masks: DataFrame, sources: DataFrame, run: Run) -> DataFrame:
    """Every region with shape, identity and what its image's name tells: sources (image_id, source_path)."""
    mask = pixels.unfold_masks(masks)
    shape = pixels.region_properties(mask, pixel_microns=run.segmentation.pixel_microns)
    sized = shape.join(masks.select("image_id", "height", "width"), "image_id").join(sources, "image_id")
    edge = F.least("bbox_min_row", "bbox_min_col", F.col("height") - F.col("bbox_max_row"), F.col("width") - F.col("bbox_max_col")) <= 0
    box = [F.col(b) for b in schemas.BBOX]
    told = filename_metadata(F.element_at(F.split("source_path", "/"), -1))
    return sized.withColumn("area_px", F.col("area")).withColumns(
        {"Cell_ID": cell_id(F.col("source_path"), F.col("label"), box), "touching_edge": edge, "included": ~edge, "source_filename": F.element_at(F.split("source_path", "/"), -1), **{k: told[k] for k in ("plate", "scene", "position")}}
    )


def finish(cells: DataFrame, run: Run, registry: DataFrame | None = None, classes: DataFrame | None = None) -> DataFrame:
    """Filter, classify, label and number cells."""
    if run.filter.enabled:
        cells = filtering.keep_passing(cells, run.filter.rules, run.filter.require_included, run.scale)
    if classes is not None:
        cells = filtering.filter_classified(joins.join_classes(cells, classes), run.classifier.threshold, run.classifier.keep_class)
    if registry is not None:
        cells = labels.numbered_ids(labels.apply_registry(labels.with_key(cells, run.labels.source, run.labels.pattern or None), registry, run.labels.how))
    return ensure_provenance(cells, run.run_hash(), run.segmentation.phase_channel)


def run_all(spark: SparkSession, planes: DataFrame, sources: DataFrame, run: Run, registry: DataFrame | None = None, scorer: Callable[[np.ndarray], np.ndarray] | None = None, write: bool = True) -> DataFrame:
    """All stages in memory order: masks are the one table that several stages read, so that they are written once."""
    masks = checkpointed(segment(planes, run))
    cells = cells_of(masks, sources, run)
    classes = None
    if run.classifier.enabled and scorer is not None:
        s = run.scaled()["crops"]
        cut = segmentation.crops(image_table(planes, masks), cells, s["crop_size"], s["min_bbox_pad"], run.crops.edge_pad_mode)
        classes = segmentation.classify_crops(cut, scorer, run.classifier.threshold)
    done = checkpointed(finish(cells, run, registry, classes))
    if write:
        numeric = [c for c, t in done.dtypes if t in ("double", "int", "bigint") and c not in ("label", "height", "width")]
        export.write_all(done, numeric, run.output_dir, run.run_hash())
    return done


def run_stage(spark: SparkSession, stage: str, tables: dict[str, DataFrame], run: Run, **more) -> DataFrame:
    """One stage over the tables that the ones before it gave."""
    name = stage.split(":")[0]
    if name == "segment":
        return segment(tables["planes"], run)
    if name == "compile":
        return cells_of(tables["masks"], tables["sources"], run)
    if name == "filter":
        return filtering.filter_cells(tables["cells"], run.filter.rules, run.filter.require_included, run.scale)
    if name == "crop":
        s = run.scaled()["crops"]
        return segmentation.crops(image_table(tables["planes"], tables["masks"]), tables["cells"], s["crop_size"], s["min_bbox_pad"], run.crops.edge_pad_mode)
    if name == "classify":
        from cytoframe.operators.batching import stride_shard

        shard = stride_shard(tables["crops"], stage.split(":")[1], "Cell_ID") if ":" in stage else tables["crops"]
        return segmentation.classify_crops(shard, more["scorer"], run.classifier.threshold)
    if name == "final":
        return finish(tables["cells"], run, tables.get("registry"), tables.get("classes"))
    raise ValueError(f"no stage is called {stage}")


def with_status(images: DataFrame, results: DataFrame, done: DataFrame | None = None, dry_run: bool = False) -> DataFrame:
    """(image_id, status, error): success, failed, skipped for output that exists, dry_run, missing."""
    out = images.select("image_id").join(results.select("image_id", "error", F.lit(True).alias("_ran")), "image_id", "left")
    if done is not None:
        out = out.join(done.select("image_id", F.lit(True).alias("_done")), "image_id", "left")
    else:
        out = out.withColumn("_done", F.lit(None).cast("boolean"))
    status = F.when(F.lit(dry_run), "dry_run").when(F.col("_done"), "skipped").when(F.col("error").isNotNull(), "failed").when(F.col("_ran"), "success").otherwise("missing")
    return out.select("image_id", status.alias("status"), "error").orderBy("image_id")


def status_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count("*").alias("n"), F.min("error").alias("first_error"))
