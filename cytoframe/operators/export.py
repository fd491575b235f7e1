"""What a run hands over: data, metadata, mapping, diagnostics, lookup and sidecars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe import schemas
from cytoframe.functions.identity import basename, filename_metadata, strip_hash
from cytoframe.operators.aggregates import tidy, wide_matrix
from cytoframe.operators.labels import UNKNOWN

MAPPING = ("Cell_ID", "cell_hash", "segmentation_run_hash", "source_image", "source_path", "source_filename", "image_id", "label", *schemas.BBOX, "plate", "scene", "position", "drug", "predicted_class", "p_cell")


def _or(df: DataFrame, name: str, value: Column) -> Column:
    return F.coalesce(F.nullif(F.col(name).cast("string"), F.lit("")), value) if name in df.columns else value


def metadata(cells: DataFrame) -> DataFrame:
    """(Cell_ID, drug, GroupLabels_Strict), UNK where there is none."""
    return cells.select("Cell_ID", _or(cells, "drug", F.lit(UNKNOWN)).alias("drug"), _or(cells, "GroupLabels_Strict", F.lit(UNKNOWN)).alias("GroupLabels_Strict"))


def mapping(cells: DataFrame, run_hash: str = "", extras: bool = False) -> DataFrame:
    """Eighteen columns of provenance: what a file name tells is read in the same pass."""
    name = basename(F.col("source_path"))
    told = filename_metadata(name)
    known = {
        "source_filename": name, "segmentation_run_hash": _or(cells, "segmentation_run_hash", F.lit(run_hash)), "cell_hash": strip_hash(_or(cells, "cell_hash", F.regexp_replace("Cell_ID", "^sc_", ""))),
        "source_image": _or(cells, "source_image", F.regexp_replace(name, r"\.[^.]*$", "")), "drug": _or(cells, "drug", F.lit(UNKNOWN)), **{k: _or(cells, k, told[k]) for k in ("plate", "scene", "position")},
    }
    columns = [known.get(c, F.col(c) if c in cells.columns else F.lit(None).cast("string")).alias(c) for c in MAPPING]
    return cells.select(*columns, *([c for c in cells.columns if c not in MAPPING] if extras else []))


def diagnostics(cells: DataFrame) -> DataFrame:
    """Twelve columns, null where a table has none."""
    return cells.select(*[F.col(c) if c in cells.columns else F.lit(None).cast("string").alias(c) for c in schemas.DIAGNOSTICS])


def features_long(cells: DataFrame, features: list[str], key: str = "Cell_ID") -> DataFrame:
    return tidy(cells, key, [f for f in features if f in cells.columns]).withColumnRenamed(key, "cell_id")


def write_all(cells: DataFrame, features: list[str], folder: str, run_hash: str = "", wide: bool = False, profiles: DataFrame | None = None, puncta: DataFrame | None = None) -> None:
    """Every table of a run: tidy features, metadata, mapping, diagnostics and sidecars; the wide matrix only on request."""
    long = features_long(cells, features)
    long.write.mode("overwrite").parquet(f"{folder}/features")
    metadata(cells).write.mode("overwrite").option("header", True).csv(f"{folder}/metadata")
    mapping(cells, run_hash).write.mode("overwrite").option("header", True).csv(f"{folder}/mapping")
    diagnostics(cells).write.mode("overwrite").option("header", True).csv(f"{folder}/diagnostics")
    spark = cells.sparkSession
    (profiles if profiles is not None else spark.createDataFrame([], schemas.PROFILES)).write.mode("overwrite").parquet(f"{folder}/profiles")
    (puncta if puncta is not None else spark.createDataFrame([], schemas.PUNCTA)).write.mode("overwrite").parquet(f"{folder}/puncta")
    if wide:
        wide_matrix(long).write.mode("overwrite").option("header", True).csv(f"{folder}/matrix")


def kept_columns(long: DataFrame, ids: DataFrame) -> DataFrame:
    """A tidy matrix without the cells that went."""
    return long.join(ids.select(F.col("Cell_ID").alias("cell_id")).distinct(), "cell_id", "left_semi")


def id_differences(meta: DataFrame, mapped: DataFrame) -> DataFrame:
    """(Cell_ID, only_in) of ids that one of two tables lacks."""
    a, b = meta.select("Cell_ID").distinct(), mapped.select("Cell_ID").distinct()
    return a.exceptAll(b).withColumn("only_in", F.lit("metadata")).union(b.exceptAll(a).withColumn("only_in", F.lit("mapping")))
