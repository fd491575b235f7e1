"""Where spots lie in cells of like length: classes by exact quantiles, and a density on a fixed grid for each of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.operators.aggregates import percentiles

#: Each class is a row of what is broadcast and a grid in each task.
MOST_CLASSES = 256


def length_classes(cells: DataFrame, length: str = "length", classes: int = 5, key: str = "cell_id") -> DataFrame:
    """(key, length_class, length): cells by quantiles of their length, each class from its lower edge up to below its upper one.

    Edges are exact and linear between the closest ranks.  As the classes are
    half open, the longest cells are in none; cells without a length too.
    """
    if not 1 <= classes <= MOST_CLASSES:
        raise ValueError(f"classes are 1 to {MOST_CLASSES}")
    own = cells.where(F.col(length).isNotNull() & ~F.isnan(F.col(length).cast("double"))).select(key, F.col(length).cast("double").alias("length"))
    edges = percentiles(own.withColumn("_all", F.lit(1)), ["_all"], "length", [k / classes for k in range(classes + 1)], "_edges").select("_edges")
    above = F.size(F.filter("_edges", lambda e: e <= F.col("length")))
    return own.join(F.broadcast(edges)).where(F.col("length") < F.element_at("_edges", -1)).select(key, (above - 1).alias("length_class"), "length")


def spot_moments(spots: DataFrame, classes: DataFrame, weight: str, x: str, y: str, cutoff: float, key: str) -> tuple[DataFrame, DataFrame]:
    """The spots that count, with their class, and a row for each class: its spots, and the inverse of its kernel's covariance.

    The kernel is the weighted covariance of the spots times the square of
    n ** (-1 / 6), n their effective number.  Classes of less than 3 spots, and
    those whose spots lie on one line, have no kernel.
    """
    w, px, py = (F.col(c).cast("double") for c in (weight, x, y))
    known = [c.isNotNull() & ~F.isnan(c) for c in (w, px, py)]
    held = spots.where(known[0] & known[1] & known[2] & (w > 0) & (w >= cutoff)).select(key, w.alias("w"), px.alias("x"), py.alias("y")).join(classes.select(key, "length_class"), key)
    total = lambda e: F.sum(F.expr(e))
    sums = held.groupBy("length_class").agg(F.count("*").alias("n_spots"), total("w").alias("s"), total("w * w").alias("s2"), (total("w * x") / total("w")).alias("mx"), (total("w * y") / total("w")).alias("my"), total("w * x * x").alias("sxx"), total("w * y * y").alias("syy"), total("w * x * y").alias("sxy"))
    scale = "pow(s * s / s2, -1 / 3D) / (1 - s2 / (s * s))"
    spread = sums.where("n_spots > 2").selectExpr("length_class", "n_spots", f"(sxx / s - mx * mx) * {scale} AS cxx", f"(syy / s - my * my) * {scale} AS cyy", f"(sxy / s - mx * my) * {scale} AS cxy").withColumn("det", F.expr("cxx * cyy - cxy * cxy")).where("det > 1e-12 * cxx * cyy")
    return held, spread.selectExpr("length_class", "n_spots", "cyy / det AS ixx", "cxx / det AS iyy", "-cxy / det AS ixy")


def spot_density(spots: DataFrame, classes: DataFrame, weight: str = "peak_intensity", x: str = "x", y: str = "y", cutoff: float = 0.0, across: int = 21, along: int = 61, key: str = "cell_id", rows: int = 2000) -> DataFrame:
    """(length_class, n_spots, grid_row, grid_column, density): weighted kernel density of each class on a grid over [0, 1] x [0, 1], 1 at its greatest.

    ``x`` runs across a cell and over the columns, ``y`` along it and over the
    rows.  Spots are as many as there are; each task sums the grids of the
    classes that it meets, ``rows`` spots at a time, and only these sums are
    shuffled.  Spots without a place or a positive weight of at least ``cutoff``
    do not count, nor do those of cells without a class.
    """
    held, kernels = spot_moments(spots, classes, weight, x, y, cutoff, key)
    gx, gy = np.linspace(0, 1, across), np.linspace(0, 1, along)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids: dict[int, np.ndarray] = {}
        for batch in batches:
            own = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            for k in np.unique(own[0]):
                w, px, py, ixx, iyy, ixy = (c[own[0] == k] for c in own[1:])
                grid = grids.setdefault(int(k), np.zeros((along, across)))
                for i in range(0, len(w), rows):
                    at = slice(i, i + rows)
                    dx, dy = gx[None, :] - px[at, None], gy[None, :] - py[at, None]
                    fx, fy = -0.5 * ixx[0] * dx**2, -0.5 * iyy[0] * dy**2
                    grid += np.einsum("n,nyx->yx", w[at], np.exp(fy[:, :, None] + fx[:, None, :] - ixy[0] * dy[:, :, None] * dx[:, None, :]))
        for k, grid in grids.items():
            r, c = np.indices(grid.shape)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(grid.size, k), pa.int32()), pa.array(r.ravel(), pa.int32()), pa.array(c.ravel(), pa.int32()), pa.array(grid.ravel())], names=["length_class", "grid_row", "grid_column", "z"])

    dealt = held.join(F.broadcast(kernels), "length_class").select(F.col("length_class").cast("int"), "w", "x", "y", "ixx", "iyy", "ixy")
    sums = dealt.mapInArrow(summed, "length_class int, grid_row int, grid_column int, z double").groupBy("length_class", "grid_row", "grid_column").agg(F.sum("z").alias("z"))
    tops = sums.groupBy("length_class").agg(F.max("z").alias("top"))
    counts = kernels.select("length_class", "n_spots")
    return sums.join(F.broadcast(tops), "length_class").join(F.broadcast(counts), "length_class").select("length_class", "n_spots", "grid_row", "grid_column", (F.col("z") / F.col("top")).alias("density"))
