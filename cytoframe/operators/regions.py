"""Annotated outlines as masks: polygons are filled row by row from the sorted crossings of their edges, in DataFrame operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe.functions import imaging as I
from cytoframe.operators import pixels as P

#: What a mask of levels has at an outline's core and around it.
CORE, EDGE = 254, 125


def cut_corners(values: Column) -> Column:
    """A line's coordinates with each inner corner cut at a quarter and three quarters of its edges; the ends stay."""
    inner = F.transform(F.sequence(F.lit(0), F.size(values) - 2), lambda i: F.array(F.get(values, i) * 0.75 + F.get(values, i + 1) * 0.25, F.get(values, i) * 0.25 + F.get(values, i + 1) * 0.75))
    return F.when(F.size(values) < 3, values).otherwise(F.concat(F.slice(values, 1, 1), F.flatten(inner), F.slice(values, -1, 1)))


def smoothed(rois: DataFrame, rounds: int = 1) -> DataFrame:
    for _ in range(rounds):
        rois = rois.withColumns({"xs": cut_corners(F.col("xs")), "ys": cut_corners(F.col("ys"))})
    return rois


def spans(rois: DataFrame, keys: tuple[str, ...] = ("image_id", "label")) -> DataFrame:
    """(keys, y, x_from, x_to): runs of pixels whose centres are in the polygon (keys, xs, ys), both ends included.

    Inside is where an odd number of edges crosses the row at or left of the pixel;
    an edge covers its upper end and not its lower one.  Outlines of under three
    points, or with coordinates that are null or not finite, have none; repeated ones
    count once, and different ones of a key are one outline with its holes.  Where
    height and width are among the keys, rows and runs are those within the image.
    """
    ok = (F.size("xs") == F.size("ys")) & (F.size("xs") >= 3) & F.forall(F.concat("xs", "ys"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 1e9))
    x, y = F.col("xs"), F.col("ys")
    following = F.sequence(F.lit(0), F.size(x) - 1)
    edge = F.transform(following, lambda i: F.struct(F.get(x, i).alias("x1"), F.get(y, i).alias("y1"), F.get(x, (i + 1) % F.size(x)).alias("x2"), F.get(y, (i + 1) % F.size(y)).alias("y2")))
    edges = rois.where(ok).select(*keys, "xs", "ys").distinct().select(*keys, F.explode(edge).alias("e")).select(*keys, "e.*").where("y1 <> y2")
    first, last = F.ceil(F.least("y1", "y2")), F.ceil(F.greatest("y1", "y2")) - 1
    if "height" in keys:
        first, last = F.greatest(first, F.lit(0)), F.least(last, F.col("height") - 1)
    rows = edges.where(first <= last).withColumn("y", F.explode(F.sequence(first, last)))
    crossing = F.col("x1") + (F.col("y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    lines = rows.groupBy(*keys, "y").agg(F.sort_array(F.collect_list(crossing)).alias("c"))
    pairs = F.transform(F.sequence(F.lit(0), F.size("c") - 2, F.lit(2)), lambda i: F.struct(F.ceil(F.get("c", i)).alias("x_from"), (F.ceil(F.get("c", i + 1)) - 1).alias("x_to")))
    runs = lines.select(*keys, "y", F.explode(pairs).alias("p")).select(*keys, "y", "p.x_from", "p.x_to")
    if "width" in keys:
        runs = runs.withColumns({"x_from": F.greatest("x_from", F.lit(0)), "x_to": F.least("x_to", F.col("width") - 1)})
    return runs.where("x_from <= x_to")


def filled(rois: DataFrame, sizes: DataFrame) -> DataFrame:
    """(image_id, label, y, x): the pixels of outlines (image_id, label, xs, ys) within their images (image_id, height, width)."""
    sized = rois.join(sizes.select("image_id", "height", "width"), "image_id")
    runs = spans(sized, ("image_id", "label", "height", "width"))
    return runs.select("image_id", "label", F.col("y").cast("int").alias("y"), F.explode(F.sequence(F.col("x_from").cast("int"), F.col("x_to").cast("int"))).alias("x")).distinct()


def eroded_within(mask: DataFrame, sizes: DataFrame, radius: int, keys: tuple[str, ...]) -> DataFrame:
    """Mask pixels whose disk, as far as it is within the image, is in the mask: an image's border takes nothing away."""
    offsets = P._offsets(radius)
    sized = mask.join(sizes.select("image_id", "height", "width"), "image_id")
    y, x = F.col("y"), F.col("x")
    there = F.size(F.filter(offsets, lambda o: (y + o["dy"] >= 0) & (y + o["dy"] < F.col("height")) & (x + o["dx"] >= 0) & (x + o["dx"] < F.col("width"))))
    votes = mask.select(*keys, "y", "x", F.explode(offsets).alias("o")).select(*keys, (y + F.col("o.dy")).alias("y"), (x + F.col("o.dx")).alias("x")).groupBy(*keys, "y", "x").agg(F.count("*").alias("_n"))
    return sized.withColumn("_need", there).join(votes, [*keys, "y", "x"]).where("_n = _need").select(*keys, "y", "x")


def level_masks(rois: DataFrame, sizes: DataFrame, radius: int = 2, rounds: int = 1) -> DataFrame:
    """(image_id, y, x, value): 254 in the cores of an image's outlines, 125 around them; the rest of an image has no row.

    A core is an outline, its corners cut ``rounds`` times, filled and eroded by a
    disk; around it is what a disk larger by one adds to all cores.
    """
    core = eroded_within(filled(smoothed(rois, rounds), sizes), sizes, radius, ("image_id", "label")).select("image_id", "y", "x").distinct()
    around = P.dilate(core, radius + 1, ("image_id",)).join(sizes.select("image_id", "height", "width"), "image_id").where("y >= 0 AND y < height AND x >= 0 AND x < width").select("image_id", "y", "x")
    marked = core.withColumn("_core", F.lit(True))
    return around.join(marked, ["image_id", "y", "x"], "left").select("image_id", "y", "x", F.when(F.col("_core"), CORE).otherwise(EDGE).alias("value"))


def instance_masks(rois: DataFrame, planes: DataFrame, radius: int = 2, rounds: int = 1) -> DataFrame:
    """(image_id, height, width, labels): the filled outlines of an image (image_id, height, width, pixels), divided by a flood of its values from the connected cores."""
    area = filled(smoothed(rois, rounds), planes)
    core = eroded_within(area, planes, radius, ("image_id", "label")).select("image_id", "y", "x").distinct().withColumn("core", F.lit(1))
    both = area.select("image_id", "y", "x").distinct().join(core, ["image_id", "y", "x"], "left")
    listed = both.groupBy("image_id").agg(F.collect_list(F.struct("y", "x", F.coalesce("core", F.lit(0)).alias("core"))).alias("area"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                h, w = int(r.height), int(r.width)
                mask, core_of = np.zeros((h, w), bool), np.zeros((h, w), bool)
                for p in r.area if r.area is not None else ():
                    mask[p["y"], p["x"]], core_of[p["y"], p["x"]] = True, bool(p["core"])
                found = I.watershed(np.asarray(r.pixels, float).reshape(h, w), I.label(core_of), mask)
                yield pd.DataFrame([(r.image_id, h, w, found.astype(int).ravel().tolist())], columns=["image_id", "height", "width", "labels"])

    kind = dict(planes.dtypes)["image_id"]
    return planes.select("image_id", "height", "width", "pixels").join(listed, "image_id", "left").mapInPandas(run, f"image_id {kind}, height int, width int, labels array<int>")
