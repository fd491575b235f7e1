"""Image algebra on long tables: pixels (keys, y, x, value) and masks (keys, label, y, x).

All of it is grouping, joining and windows, so that an image of any size is
spread over tasks; keys default to the image.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KEY = ("image_id",)


def unfold(planes: DataFrame, keys: tuple[str, ...] = ("image_id", "channel"), array: str = "pixels", width: str | int = "width") -> DataFrame:
    """Planes of arrays in raster order as pixels."""
    w = F.col(width) if isinstance(width, str) else F.lit(width)
    at = planes.select(*keys, w.alias("_w"), F.posexplode(array).alias("_p", "value"))
    return at.select(*keys, F.floor(F.col("_p") / F.col("_w")).cast("int").alias("y"), (F.col("_p") % F.col("_w")).cast("int").alias("x"), F.col("value").cast("double").alias("value"))


def unfold_masks(masks: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Label arrays as mask pixels; the background has none."""
    return unfold(masks, keys, "labels").where("value > 0").select(*keys, F.col("value").cast("int").alias("label"), "y", "x")


def fold(pixels: DataFrame, height: int, width: int, keys: tuple[str, ...] = ("image_id", "channel"), value: str = "value") -> DataFrame:
    """Pixels as arrays in raster order, zeros where there is none."""
    cells = F.map_from_entries(F.collect_list(F.struct((F.col("y") * width + F.col("x")).alias("p"), F.col(value).alias("v"))))
    return pixels.groupBy(*keys).agg(cells.alias("_m")).select(*keys, F.lit(height).alias("height"), F.lit(width).alias("width"), F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), lambda p: F.coalesce(F.element_at("_m", p), F.lit(0))).alias("pixels"))


def disk(spark: SparkSession, radius: int) -> DataFrame:
    """(dy, dx) of a disk: (2 radius + 1)^2 rows at most."""
    side = spark.range(-radius, radius + 1)
    pairs = side.select(F.col("id").cast("int").alias("dy"), F.explode(F.sequence(F.lit(-radius), F.lit(radius))).alias("dx"))
    return pairs.where(F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx") <= radius * radius)


def _offsets(radius: int) -> Column:
    return F.array(*[F.struct(F.lit(y).alias("dy"), F.lit(x).alias("dx")) for y in range(-radius, radius + 1) for x in range(-radius, radius + 1) if y * y + x * x <= radius * radius])


def disk_size(radius: int) -> int:
    return sum(y * y + x * x <= radius * radius for y in range(-radius, radius + 1) for x in range(-radius, radius + 1))


def dilate(mask: DataFrame, radius: int, keys: tuple[str, ...] = (*KEY, "label"), height: int | None = None, width: int | None = None) -> DataFrame:
    """Every pixel within a disk of a mask's; within the image, where its size is given."""
    out = mask.select(*keys, "y", "x", F.explode(_offsets(radius)).alias("o")).select(*keys, (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"))
    if height is not None:
        out = out.where((F.col("y") >= 0) & (F.col("y") < height) & (F.col("x") >= 0) & (F.col("x") < width))
    return out.distinct()


def erode(mask: DataFrame, radius: int, keys: tuple[str, ...] = (*KEY, "label")) -> DataFrame:
    """Pixels whose whole disk is in the mask; beyond the image nothing is."""
    reached = mask.select(*keys, "y", "x", F.explode(_offsets(radius)).alias("o")).groupBy(*keys, (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x")).agg(F.count("*").alias("_n"))
    return reached.where(F.col("_n") == disk_size(radius)).drop("_n")


def background_ring(mask: DataFrame, outer: int = 5, inner: int = 3, keys: tuple[str, ...] = (*KEY, "label"), height: int | None = None, width: int | None = None) -> DataFrame:
    """What lies within ``outer`` of a cell, but not within ``inner``."""
    return dilate(mask, outer, keys, height, width).join(dilate(mask, inner, keys, height, width), [*keys, "y", "x"], "left_anti")


def shell_core(mask: DataFrame, radius: int = 2, keys: tuple[str, ...] = (*KEY, "label")) -> DataFrame:
    """Mask pixels with their zone: the eroded mask is the core, the rest the shell."""
    core = erode(mask, radius, keys).withColumn("zone", F.lit("core"))
    return mask.join(core, [*keys, "y", "x"], "left").withColumn("zone", F.coalesce("zone", F.lit("shell")))


def shell_core_stats(zones: DataFrame, pixels: DataFrame, keys: tuple[str, ...] = (*KEY, "label"), image: tuple[str, ...] = KEY) -> DataFrame:
    joined = zones.join(pixels, [*image, "y", "x"])
    shell, core = F.avg(F.when(F.col("zone") == "shell", F.col("value"))), F.avg(F.when(F.col("zone") == "core", F.col("value")))
    return joined.groupBy(*keys).agg(shell.alias("shell_mean"), core.alias("core_mean"), (shell / (core + 1e-10)).alias("shell_core_ratio"))


def background_stats(ring: DataFrame, pixels: DataFrame, keys: tuple[str, ...] = (*KEY, "label"), image: tuple[str, ...] = KEY) -> DataFrame:
    return ring.join(pixels, [*image, "y", "x"]).groupBy(*keys).agg(F.avg("value").alias("bg_mean"), F.median("value").alias("bg_median"), F.stddev_pop("value").alias("bg_std"))


def region_properties(mask: DataFrame, keys: tuple[str, ...] = (*KEY, "label"), pixel_microns: float = 1.0) -> DataFrame:
    """Shape of every region from its raw moments, in one aggregation.

    Axes, eccentricity and orientation are those of the ellipse of the same
    second moments; boxes are half open.
    """
    y, x = F.col("y").cast("double"), F.col("x").cast("double")
    m = mask.groupBy(*keys).agg(
        F.count("*").alias("area"), F.avg(y).alias("centroid_row"), F.avg(x).alias("centroid_col"), F.min("y").alias("bbox_min_row"), F.min("x").alias("bbox_min_col"),
        (F.max("y") + 1).alias("bbox_max_row"), (F.max("x") + 1).alias("bbox_max_col"), F.avg(y * y).alias("_yy"), F.avg(x * x).alias("_xx"), F.avg(y * x).alias("_xy"),
    )
    # 1/12 is the variance of a pixel's own extent.
    m = m.withColumns({"_a": F.col("_yy") - F.col("centroid_row") ** 2 + 1 / 12, "_b": F.col("_xx") - F.col("centroid_col") ** 2 + 1 / 12, "_c": F.col("_xy") - F.col("centroid_row") * F.col("centroid_col")})
    root = F.sqrt(((F.col("_a") - F.col("_b")) / 2) ** 2 + F.col("_c") ** 2)
    m = m.withColumns({"_l1": (F.col("_a") + F.col("_b")) / 2 + root, "_l2": F.greatest((F.col("_a") + F.col("_b")) / 2 - root, F.lit(0.0))})
    area = F.col("area").cast("double")
    return m.select(
        *keys, "area", (area * pixel_microns**2).alias("area_um2"), "centroid_row", "centroid_col", "bbox_min_row", "bbox_min_col", "bbox_max_row", "bbox_max_col",
        (4 * F.sqrt("_l1")).alias("major_axis"), (4 * F.sqrt("_l2")).alias("minor_axis"),
        F.sqrt(F.greatest(1 - F.try_divide(F.col("_l2"), F.col("_l1")), F.lit(0.0))).alias("eccentricity"),
        F.when(F.col("_a") == F.col("_b"), F.when(F.col("_c") < 0, -math.pi / 4).otherwise(math.pi / 4)).otherwise(0.5 * F.atan2(2 * F.col("_c"), F.col("_a") - F.col("_b"))).alias("orientation"),
        (area / ((F.col("bbox_max_row") - F.col("bbox_min_row")) * (F.col("bbox_max_col") - F.col("bbox_min_col")))).alias("extent"),
        F.sqrt(4 * area / math.pi).alias("equivalent_diameter"), F.round(F.try_divide(F.sqrt("_l2"), F.sqrt("_l1")), 3).alias("aspect_ratio"),
    )


def hu_moments(mask: DataFrame, keys: tuple[str, ...] = (*KEY, "label")) -> DataFrame:
    """The seven invariants of Hu (1962) of every region."""
    centre = mask.groupBy(*keys).agg(F.avg(F.col("y").cast("double")).alias("_cy"), F.avg(F.col("x").cast("double")).alias("_cx"))
    y, x = F.col("y") - F.col("_cy"), F.col("x") - F.col("_cx")
    orders = [(p, q) for p in range(4) for q in range(4) if 2 <= p + q <= 3]
    m = mask.join(centre, list(keys)).groupBy(*keys).agg(F.count("*").cast("double").alias("_m"), *[F.sum(F.pow(y, F.lit(p)) * F.pow(x, F.lit(q))).alias(f"_u{p}{q}") for p, q in orders])
    n = {(p, q): F.col(f"_u{p}{q}") / F.pow("_m", F.lit((p + q) / 2 + 1)) for p, q in orders}
    a, b, c, d = n[3, 0] + n[1, 2], n[2, 1] + n[0, 3], n[3, 0] - 3 * n[1, 2], 3 * n[2, 1] - n[0, 3]
    e, f = n[2, 0] - n[0, 2], n[1, 1]
    hu = [
        n[2, 0] + n[0, 2], e**2 + 4 * f**2, c**2 + d**2, a**2 + b**2, c * a * (a**2 - 3 * b**2) + d * b * (3 * a**2 - b**2), e * (a**2 - b**2) + 4 * f * a * b, d * a * (a**2 - 3 * b**2) - c * b * (3 * a**2 - b**2),
    ]
    return m.select(*keys, *[h.alias(f"hu_moment_{i}") for i, h in enumerate(hu)])


def intensity_panel(mask: DataFrame, pixels: DataFrame, keys: tuple[str, ...] = (*KEY, "label", "channel"), on: tuple[str, ...] = (*KEY, "y", "x")) -> DataFrame:
    """Sixteen statistics of every region and channel; entropy by ``entropy``."""
    joined = mask.join(pixels, list(on))
    return intensity_stats(joined, keys).join(entropy(joined, keys), list(keys), "left")


def intensity_stats(values: DataFrame, keys: tuple[str, ...], value: str = "value") -> DataFrame:
    v = F.col(value)
    p = values.groupBy(*keys).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.var_pop(v).alias("var"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.percentile(v, F.array(*map(F.lit, (0.05, 0.25, 0.5, 0.75, 0.95)))).alias("_q"), F.skewness(v).alias("skewness"), F.kurtosis(v).alias("kurtosis"),
    )
    q = [F.get("_q", i) for i in range(5)]
    enough = F.col("n") >= 4
    return p.select(
        *keys, "mean", q[2].alias("median"), "std", "var", "min", "max", (F.col("max") - F.col("min")).alias("range"), q[1].alias("q1"), q[3].alias("q3"), (q[3] - q[1]).alias("iqr"), q[0].alias("p5"), q[4].alias("p95"),
        F.try_divide("std", F.abs("mean")).alias("cv"), F.when(enough, F.col("skewness")).alias("skewness"), F.when(enough, F.col("kurtosis")).alias("kurtosis"),
    )


def entropy(values: DataFrame, keys: tuple[str, ...], value: str = "value", bins: int = 64) -> DataFrame:
    """Shannon's sum over the densities of a histogram from minimum to maximum."""
    limits = values.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(value).alias("_n"))
    flat = F.col("_lo") == F.col("_hi")
    lo = F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo"))
    width = F.when(flat, F.lit(1.0)).otherwise(F.col("_hi") - F.col("_lo")) / bins
    place = F.least(F.floor((F.col(value) - lo) / width), F.lit(bins - 1))
    counts = values.join(limits, list(keys)).groupBy(*keys, place.alias("_bin"), width.alias("_w"), F.col("_n")).agg(F.count("*").alias("_k"))
    density = F.col("_k") / F.col("_n") / F.col("_w")
    return counts.groupBy(*keys).agg((-F.sum(density * F.log2(density + 1e-10))).alias("entropy"))


def isodata_thresholds(pixels: DataFrame, keys: tuple[str, ...] = KEY, bins: int = 256, rounds: int = 100) -> DataFrame:
    """(keys, threshold): the fixed point of the mean of both sides' means, over a histogram of each image.

    The histogram is aggregated; its fixed point is found in its one row.
    """
    limits = pixels.groupBy(*keys).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = pixels.join(limits, list(keys)).groupBy(*keys, "_lo", width.alias("_w"), place.cast("int").alias("_b")).agg(F.count("*").alias("_k"))
    rows = counts.groupBy(*keys).agg(F.collect_list(F.struct((F.col("_lo") + (F.col("_b") + 0.5) * F.col("_w")).alias("c"), F.col("_k").alias("k"))).alias("_h"))

    def step(state: Column, _: Column) -> Column:
        # Both sides in one pass over the histogram, and no more passes once the threshold stays: a `when` works out one branch.
        t = state["t"]

        def add(s: Column, b: Column) -> Column:
            low, w = b["c"] <= t, b["c"] * b["k"]
            none, zero = F.lit(0).cast("long"), F.lit(-0.0)
            return F.struct((s["n"] + F.when(low, b["k"]).otherwise(none)).alias("n"), (s["s"] + F.when(low, w).otherwise(zero)).alias("s"), (s["m"] + F.when(low, none).otherwise(b["k"])).alias("m"), (s["r"] + F.when(low, zero).otherwise(w)).alias("r"))

        def moved(s: Column) -> Column:
            new = F.coalesce((F.try_divide(s["s"], s["n"]) + F.try_divide(s["r"], s["m"])) / 2, t)
            return F.struct(new.alias("t"), (new == t).alias("done"))

        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("s"), F.lit(0).cast("long").alias("m"), F.lit(0.0).alias("r"))
        return F.when(state["done"], state).otherwise(F.aggregate("_h", start, add, moved))

    n = F.aggregate("_h", F.lit(0).cast("long"), lambda s, b: s + b["k"])
    start = F.aggregate("_h", F.lit(0.0), lambda s, b: s + b["c"] * b["k"]) / n
    first = F.struct(start.alias("t"), F.lit(False).alias("done"))
    return rows.select(*keys, F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first, step, lambda state: state["t"]).alias("threshold"))


def threshold_mask(pixels: DataFrame, thresholds: DataFrame, keys: tuple[str, ...] = KEY, dark: bool = True) -> DataFrame:
    """Pixels on one side of their image's threshold."""
    joined = pixels.join(thresholds, list(keys))
    return joined.where(F.col("value") < F.col("threshold") if dark else F.col("value") > F.col("threshold")).drop("threshold")


def range_mask(pixels: DataFrame, low: float, high: float) -> DataFrame:
    return pixels.where((F.col("value") > low) & (F.col("value") < high))


def _mirrored(pixels: DataFrame, axis: str, size: int, r: int) -> DataFrame:
    """Pixels and their reflections beyond both borders of one axis."""
    at = F.col(axis)
    spots = F.array_compact(F.array(at, F.when((at >= 1) & (at <= r), -at), F.when((at >= size - 1 - r) & (at <= size - 2), 2 * (size - 1) - at)))
    return pixels.withColumn(axis, F.explode(spots))


def box_stats(pixels: DataFrame, height: int, width: int, size: int, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Mean and standard deviation in a window around each pixel, borders reflected: windows along rows, then along columns."""
    r = size // 2
    wide = _mirrored(pixels, "x", width, r)
    row = Window.partitionBy(*keys, "y").orderBy("x").rowsBetween(-r, r)
    wide = wide.withColumns({"_s": F.sum("value").over(row), "_ss": F.sum(F.col("value") ** 2).over(row)}).where((F.col("x") >= 0) & (F.col("x") < width))
    tall = _mirrored(wide, "y", height, r)
    column = Window.partitionBy(*keys, "x").orderBy("y").rowsBetween(-r, r)
    tall = tall.withColumns({"_s": F.sum("_s").over(column), "_ss": F.sum("_ss").over(column)}).where((F.col("y") >= 0) & (F.col("y") < height))
    mean = F.col("_s") / size**2
    return tall.withColumns({"local_mean": mean, "local_std": F.sqrt(F.greatest(F.col("_ss") / size**2 - mean**2, F.lit(0.0)))}).drop("_s", "_ss")


def sauvola_mask(pixels: DataFrame, height: int, width: int, size: int = 15, k: float = 0.2, dark: bool = True, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Pixels on one side of m (1 + k (s / R - 1)), R half the image's range."""
    span = pixels.groupBy(*keys).agg(((F.max("value") - F.min("value")) / 2).alias("_r"))
    out = box_stats(pixels, height, width, size, keys).join(span, list(keys))
    t = F.col("local_mean") * (1 + k * (F.coalesce(F.try_divide("local_std", "_r"), F.lit(0.0)) - 1))
    return out.where(F.col("value") < t if dark else F.col("value") > t).drop("_r", "local_mean", "local_std")


def local_stats(pixels: DataFrame, points: DataFrame, radius: int = 1, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Value, minimum, maximum, deviation and mean around given points."""
    spread = points.select(*keys, "y", "x", F.explode(_offsets(radius)).alias("o")).select(*keys, F.col("y").alias("py"), F.col("x").alias("px"), (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"))
    here = (F.col("y") == F.col("py")) & (F.col("x") == F.col("px"))
    out = spread.join(pixels, [*keys, "y", "x"]).groupBy(*keys, "py", "px")
    return out.agg(F.max(F.when(here, F.col("value"))).alias("value"), F.min("value").alias("min"), F.max("value").alias("max"), F.stddev_pop("value").alias("std"), F.avg("value").alias("mean")).withColumnsRenamed({"py": "y", "px": "x"})


def block_minimum(pixels: DataFrame, factor: int, keys: tuple[str, ...] = KEY) -> DataFrame:
    return pixels.groupBy(*keys, F.floor(F.col("y") / factor).cast("int").alias("y"), F.floor(F.col("x") / factor).cast("int").alias("x")).agg(F.min("value").alias("value"))


def crop_edges(pixels: DataFrame, height: int, width: int, fraction: float) -> DataFrame:
    """The middle of images, without a fraction under 0.4 of each side; coordinates start at 0 again."""
    if not 0 <= fraction < 0.4:
        raise ValueError("the fraction lies in [0, 0.4)")
    dy, dx = int(height * fraction), int(width * fraction)
    inner = pixels.where((F.col("y") >= dy) & (F.col("y") < height - dy) & (F.col("x") >= dx) & (F.col("x") < width - dx))
    return inner.withColumns({"y": F.col("y") - dy, "x": F.col("x") - dx})


def tile_origins(length: int, size: int, pad: int) -> list[int]:
    """Where tiles start along an axis: steps of size - 2 pad, and one flush with the end."""
    step = size - 2 * pad
    if step < 1:
        raise ValueError("a tile is larger than its padding")
    if length <= size:
        return [0]
    return sorted({*range(0, length - size, step), length - size})


def tiles(pixels: DataFrame, height: int, width: int, size: int, pad: int, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Pixels of overlapping tiles: ty and tx name the tile, y and x count within it."""

    def owners(axis: str, starts: list[int]) -> Column:
        return F.filter(F.array(*map(F.lit, starts)), lambda s: (F.col(axis) >= s) & (F.col(axis) < s + size))

    out = pixels.withColumn("ty", F.explode(owners("y", tile_origins(height, size, pad)))).withColumn("tx", F.explode(owners("x", tile_origins(width, size, pad))))
    return out.withColumns({"y": F.col("y") - F.col("ty"), "x": F.col("x") - F.col("tx")})


def untile(tiled: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Tiles put together again; where they overlap, their mean."""
    return tiled.groupBy(*keys, (F.col("y") + F.col("ty")).alias("y"), (F.col("x") + F.col("tx")).alias("x")).agg(F.avg("value").alias("value"))


def overlap_matrix(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Every pair of labels of two masks that share pixels: shared and own areas, their shares and IoU."""
    left, right = a.select(*keys, "y", "x", F.col("label").alias("a")), b.select(*keys, "y", "x", F.col("label").alias("b"))
    shared = left.join(right, [*keys, "y", "x"]).groupBy(*keys, "a", "b").agg(F.count("*").alias("overlap_area"))
    out = shared.join(left.groupBy(*keys, "a").agg(F.count("*").alias("frame1_area")), [*keys, "a"]).join(right.groupBy(*keys, "b").agg(F.count("*").alias("frame2_area")), [*keys, "b"])
    return out.select(
        *keys, "a", "b", "overlap_area", "frame1_area", "frame2_area", (F.col("overlap_area") / F.col("frame1_area")).alias("frame1_overlap_frac"), (F.col("overlap_area") / F.col("frame2_area")).alias("frame2_overlap_frac"),
        (F.col("overlap_area") / (F.col("frame1_area") + F.col("frame2_area") - F.col("overlap_area"))).alias("iou"),
    )


def neighbours(mask: DataFrame, radius: int = 2, keys: tuple[str, ...] = KEY) -> DataFrame:
    """(label, neighbour): labels that a dilation of a region reaches."""
    grown = dilate(mask, radius, (*keys, "label"))
    other = mask.select(*keys, "y", "x", F.col("label").alias("neighbour"))
    return grown.join(other, [*keys, "y", "x"]).where("label <> neighbour").select(*keys, "label", "neighbour").distinct()


def neighbour_counts(mask: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """How many of each mask pixel's eight neighbours are in the mask."""
    around = F.array(*[F.struct(F.lit(y).alias("dy"), F.lit(x).alias("dx")) for y in (-1, 0, 1) for x in (-1, 0, 1) if y or x])
    votes = mask.select(*keys, "y", "x", F.explode(around).alias("o")).select(*keys, (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"))
    counted = votes.groupBy(*keys, "y", "x").agg(F.count("*").alias("n"))
    return mask.join(counted, [*keys, "y", "x"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def central_selection(mask: DataFrame, cells: DataFrame, height: int, width: int, window: int = 20, tie: str = "area", keys: tuple[str, ...] = KEY) -> DataFrame:
    """Cells with is_central, distance and included: of those that reach the middle window, the nearest; of equals the largest."""
    cy, cx = (height - 1) / 2.0, (width - 1) / 2.0
    inside = (F.col("y") >= max(0, int(cy - window))) & (F.col("y") < min(height, int(cy + window + 1))) & (F.col("x") >= max(0, int(cx - window))) & (F.col("x") < min(width, int(cx + window + 1)))
    reach = mask.where(inside).select(*keys, "label").distinct()
    distance = F.sqrt((F.col("centroid_row") - cy) ** 2 + (F.col("centroid_col") - cx) ** 2)
    near = cells.join(reach, [*keys, "label"], "left_semi").select(*keys, "label", distance.alias("distance_to_center_px"), F.coalesce(F.nanvl(F.col(tie).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("_tie"))
    best = near.groupBy(*keys).agg(F.min(F.struct("distance_to_center_px", (-F.col("_tie")).alias("_t"), "label"))["label"].alias("_central"))
    out = cells.join(near.drop("_tie"), [*keys, "label"], "left").join(best, list(keys), "left")
    central = F.coalesce(F.col("label") == F.col("_central"), F.lit(False))
    included = F.col("included") & central if "included" in cells.columns else central
    return out.withColumns({"is_central": central, "included": included}).drop("_central")


def roi_or_centre_means(pixels: DataFrame, roi: DataFrame, height: int, width: int, keys: tuple[str, ...] = (*KEY, "channel"), image: tuple[str, ...] = KEY) -> DataFrame:
    """Mean value in a region, or in the window of half the size at the centre where there is no region."""
    marked = pixels.join(roi.select(*image, "y", "x").distinct().withColumn("_in", F.lit(True)), [*image, "y", "x"], "left")
    r = min(height, width) // 4
    centre = (F.abs(F.col("y") - height // 2) <= r) & (F.abs(F.col("x") - width // 2) <= r)
    own, middle = F.avg(F.when(F.col("_in"), F.col("value"))), F.avg(F.when(centre, F.col("value")))
    return marked.groupBy(*keys).agg(F.coalesce(own, middle).alias("mean"))


def filtered_composites(mask: DataFrame, passed: DataFrame, pixels: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Planes of an image with its mask, cut down to cells that passed, as one more channel."""
    kept = mask.join(passed.select(*keys, "label").distinct(), [*keys, "label"], "left_semi")
    return pixels.unionByName(kept.select(*keys, F.lit("Mask").alias("channel"), "y", "x", F.col("label").cast("double").alias("value")), allowMissingColumns=True)


def relabel(mask: DataFrame, merges: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Masks whose merged labels, (label, into), became one."""
    return mask.join(merges, [*keys, "label"], "left").withColumn("label", F.coalesce("into", "label")).drop("into")
