"""Treatment labels: keys derived from names, joined from a registry, reported and numbered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytoframe.functions.identity import pad_number, regex_first

UNKNOWN = "UNK"
#: Numbers count whole, as `pad_number` leaves them: the last four digits of 10001 are another plate's.
DEFAULT_KEY = r"((?:\d{4,}|t\d+_rep\d+)_s\d{2,})"


def load_registry(spark: SparkSession, path: str, key: str = "id", drug: str = "drug") -> DataFrame:
    """(padmap_id, padmap_drug) of a CSV file; keys stay text, with their zeros."""
    raw = spark.read.csv(path, header=True, inferSchema=False)
    return raw.select(F.trim(key).alias("padmap_id"), F.trim(drug).alias("padmap_drug"))


def with_key(cells: DataFrame, source: str = "plate_scene", pattern: str | None = None) -> DataFrame:
    """``cells`` with padmap_id, from plate and scene or by a pattern from a text column."""
    if source == "plate_scene":
        key: Column = F.concat(pad_number(F.col("plate"), 4), F.lit("_s"), pad_number(F.col("scene"), 2))
    elif source in ("source_path", "original_cell_id"):
        key = regex_first(F.col(source), pattern or DEFAULT_KEY)
    else:
        raise ValueError(f"no key comes from {source}")
    return cells.withColumn("padmap_id", key)


def apply_registry(cells: DataFrame, registry: DataFrame, how: str = "left", update_drug: bool = True, update_groups: bool = True) -> DataFrame:
    """Join labels by padmap_id; cells without one keep what they have, or UNK.

    ``how`` is left, inner or outer.  Of several labels of a key the least counts.
    """
    labels = registry.groupBy("padmap_id").agg(F.min("padmap_drug").alias("padmap_drug"))
    out = cells.join(labels, "padmap_id", {"outer": "full"}.get(how, how))

    def label(name: str) -> Column:
        own = F.nullif(name, F.lit("")) if name in cells.columns else F.lit(None).cast("string")
        return F.coalesce(F.nullif("padmap_drug", F.lit("")), own, F.lit(UNKNOWN))

    if update_drug:
        out = out.withColumn("drug", label("drug"))
    if update_groups:
        out = out.withColumn("GroupLabels_Strict", label("GroupLabels_Strict"))
    return out


def match_report(cells: DataFrame, registry: DataFrame) -> DataFrame:
    """How many cells found a label, how many labels there were, and the keys that found none."""
    labels = registry.select("padmap_id", "padmap_drug").dropDuplicates(["padmap_id"]).withColumn("_hit", F.lit(True))
    joined = cells.join(labels, "padmap_id", "left")
    return joined.agg(
        F.count("*").alias("total"), F.count_if("_hit").alias("matched"), F.count_if(F.col("_hit").isNull()).alias("unmatched"),
        F.round(100 * F.try_divide(F.count_if("_hit"), F.count("*")), 2).alias("percent"), F.count_distinct("padmap_drug").alias("drugs"),
        F.count_distinct(F.when(F.col("_hit").isNull(), F.col("padmap_id"))).alias("unmatched_ids"),
    )


def unmatched_keys(cells: DataFrame, registry: DataFrame) -> DataFrame:
    return cells.select("padmap_id").distinct().join(registry.select("padmap_id").distinct(), "padmap_id", "left_anti")


def propagate(labelled: DataFrame, table: DataFrame, key: str = "Cell_ID", columns: tuple[str, ...] = ("drug", "GroupLabels_Strict")) -> DataFrame:
    """A sibling table with new labels; its old ones go, and so do rows of cells that went."""
    return table.drop(*columns).join(labelled.select(key, *columns), key)


def numbered_ids(cells: DataFrame, drug: str = "drug", order: tuple[str, ...] = ("source_filename", "label"), name: str = "Cell_ID") -> DataFrame:
    """``sc_<drug>_<n>`` by order within each drug; cells without a drug keep their ids.

    A drug may hold most cells, so that its numbers come from sorted ranges and
    their sizes, not from one window that a single task would sort.
    """
    from cytoframe.plans.checkpoints import checkpointed

    known = F.col(drug).isNotNull() & (F.col(drug) != UNKNOWN)
    parts = checkpointed(cells.where(known).repartitionByRange(drug, *order).sortWithinPartitions(drug, *order).withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    sizes = parts.groupBy(drug, "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    # A row for each drug and partition that meet: as many as there are drugs and partitions, at most.
    before = Window.partitionBy(drug).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).select(drug, "_part", "_start", "_first")
    n = F.col("_row") - F.col("_first") + F.col("_start") + 1
    named = parts.join(starts, [drug, "_part"]).withColumn(name, F.concat_ws("_", F.lit("sc"), F.col(drug), n.cast("string"))).select(*cells.columns)
    return named.unionByName(cells.where(~F.coalesce(known, F.lit(False))))
