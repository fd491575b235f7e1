"""Filters of cells: rules with reasons, morphology bounds, classifier thresholds."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe.plans import rules as R


def filter_cells(cells: DataFrame, config: dict[str, Any], require_included: bool = True, scale: float = 1.0, excluded: str = R.EXCLUDED) -> DataFrame:
    """``cells`` with filter_passed, filter_reasons and included by the rules; no row goes."""
    found = R.reasons(R.scaled(R.normalized(config), scale), dict(cells.dtypes), require_included, excluded)
    out = cells.withColumn("_reasons", found)
    passed = F.size("_reasons") == 0
    return out.withColumns({"filter_passed": passed, "filter_reasons": F.array_join("_reasons", ";"), "included": passed}).drop("_reasons")


def keep_passing(cells: DataFrame, config: dict[str, Any], require_included: bool = True, scale: float = 1.0) -> DataFrame:
    """The cells that pass, without reasons: bare predicates that reach the scan."""
    tests = R.predicates(R.scaled(R.normalized(config), scale), dict(cells.dtypes), require_included)
    return cells.where(reduce(lambda a, b: a & b, tests)) if tests else cells


def filter_summary(filtered: DataFrame) -> DataFrame:
    return filtered.agg(F.count("*").alias("n_cells"), F.count_if("filter_passed").alias("n_passed"), F.count_if(~F.col("filter_passed")).alias("n_failed"))


def reason_counts(filtered: DataFrame) -> DataFrame:
    """How often each reason occurs."""
    return filtered.where("filter_reasons <> ''").select(F.explode(F.split("filter_reasons", ";")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def primary_filter(cells: DataFrame, config: dict[str, Any]) -> DataFrame:
    """``cells`` with failure_reasons and included by the segmenter's own bounds."""
    out = cells.withColumn("failure_reasons", F.concat(R.primary_reasons(config), R.additional_reasons(config)))
    return out.withColumn("included", F.size("failure_reasons") == 0)


def morphology_filter(features: DataFrame, **limits: float | None) -> DataFrame:
    """Rows within inclusive bounds named ``<column>_min`` and ``<column>_max``; NaN and null pass every bound."""
    tests: list[Column] = []
    for key, limit in limits.items():
        if limit is None:
            continue
        column, _, bound = key.rpartition("_")
        v = F.col({"area": "area_px"}.get(column, column))
        out = (v < limit) if bound == "min" else (v > limit)
        tests.append(v.isNull() | F.isnan(v.cast("double")) | ~out)
    return features.where(reduce(lambda a, b: a & b, tests)) if tests else features


def particle_filter(particles: DataFrame, bounds: dict[str, Any]) -> DataFrame:
    """Particles off the edge: names that start with ``$`` are equal, others lie strictly between two values."""
    test = ~F.col("touching_edge")
    for key, value in bounds.items():
        test = test & (F.col(key[1:]) == value if key.startswith("$") else (F.col(key) > value[0]) & (F.col(key) < value[1]))
    return particles.where(test)


def passes_classifier(columns: list[str], threshold: float = 0.5, keep_class: str | None = "cell") -> Column:
    """Whether a crop's p_cell, 0 where it is null, and class let it through; never without p_cell."""
    if "p_cell" not in columns:
        return F.lit(False)
    ok = F.coalesce(F.col("p_cell").try_cast("double"), F.lit(0.0)) >= threshold
    if keep_class and "predicted_class" in columns:
        ok = ok & F.coalesce(F.col("predicted_class") == keep_class, F.lit(False))
    return ok


def filter_classified(cells: DataFrame, threshold: float = 0.5, keep_class: str | None = "cell", require_included: bool = False) -> DataFrame:
    out = cells.where(passes_classifier(cells.columns, threshold, keep_class))
    return out.where("included") if require_included and "included" in cells.columns else out


def with_filter_passed(cells: DataFrame, threshold: float = 0.5, keep_class: str | None = "cell") -> DataFrame:
    return cells.withColumn("filter_passed", passes_classifier(cells.columns, threshold, keep_class))


def is_finite(*columns: str) -> Column:
    """Whether all columns are numbers: not null, NaN or infinite."""
    values = F.array(*[F.col(c).cast("double") for c in columns])
    return F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def drop_nonfinite(cells: DataFrame, columns: list[str], key: str, *others: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Cells whose features are all finite, and the rows of other tables that belong to them."""
    kept = cells.where(is_finite(*columns))
    ids = kept.select(key).distinct()
    return kept, [o.join(ids, key, "left_semi") for o in others]


def apply_annotations(cells: DataFrame, annotations: DataFrame) -> DataFrame:
    """Cells with an annotator's notes and overrides by label: include and exclude decide, others stay as they are."""
    joined = cells.join(annotations, "image_id", "left")
    key = F.col("label").cast("string")
    override = F.element_at("overrides", key)
    return joined.withColumns(
        {
            "override": override, "note": F.element_at("notes", key),
            "included": F.when(override == "include", True).when(override == "exclude", False).otherwise(F.col("included")),
        }
    ).drop("notes", "overrides")


def central_label(central: Column, cells: Column) -> Column:
    """A document's central label, else that of its first central cell."""
    return F.coalesce(central, F.get(F.filter(cells, lambda c: c["is_central"]), F.lit(0))["label"])
