"""Acquisitions of many axes as tables of planes, particles cut from them, and training sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe.functions import imaging as I
from cytoframe.functions.geometry import imagej_fields


def with_axes(planes: DataFrame, axes: str, sizes: dict[str, int], channels: list[str] | None = None) -> DataFrame:
    """Planes with a column for each axis, from their page's number; axes name the slowest first, such as ``PTZC``."""
    left = F.col("page")
    out = {}
    for axis in reversed(axes):
        out[axis.lower()] = (left % sizes[axis]).cast("int")
        left = F.floor(left / sizes[axis])
    out = {k: out[k] for k in (a.lower() for a in axes)}
    if channels and "c" in out:
        out["channel"] = F.get(F.array(*map(F.lit, channels)), out["c"])
    return planes.withColumns(out)


def slices(planes: DataFrame, **at: int | str) -> DataFrame:
    """The planes at given places of given axes; a table that is written by them reads no other."""
    for axis, value in at.items():
        planes = planes.where(F.col(axis) == value)
    return planes


def by_channel(planes: DataFrame, *keys: str) -> DataFrame:
    """(keys, height, width, planes): all channels of a place as a map."""
    return planes.groupBy(*keys).agg(F.first("height").alias("height"), F.first("width").alias("width"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("channel", "pixels")))).alias("planes"))


def same_shapes(planes: DataFrame, *keys: str) -> DataFrame:
    """(keys, same): whether all planes of a group have one size."""
    return planes.groupBy(*keys).agg(((F.min("height") == F.max("height")) & (F.min("width") == F.max("width"))).alias("same"))


def pixel_size(info: Column, default: float) -> Column:
    """Micrometres a pixel from a description, or a default."""
    fields = imagej_fields(info)
    return F.coalesce(F.element_at(fields, F.lit("dCalibration")).try_cast("double"), F.element_at(fields, F.lit("pixel_width")).try_cast("double"), F.lit(default))


def particle_pixels(pixels: DataFrame, boxes: DataFrame, keys: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """Pixels within half-open boxes (keys, label, bbox ...), in the box's own coordinates."""
    joined = pixels.join(boxes.select(*keys, "label", "bbox_min_row", "bbox_min_col", "bbox_max_row", "bbox_max_col"), list(keys))
    inside = (F.col("y") >= F.col("bbox_min_row")) & (F.col("y") < F.col("bbox_max_row")) & (F.col("x") >= F.col("bbox_min_col")) & (F.col("x") < F.col("bbox_max_col"))
    return joined.where(inside).withColumns({"y": F.col("y") - F.col("bbox_min_row"), "x": F.col("x") - F.col("bbox_min_col")}).drop("bbox_min_row", "bbox_min_col", "bbox_max_row", "bbox_max_col")


def pixel_features(planes: DataFrame, sigmas: tuple[float, ...] = (1.0, 2.0)) -> DataFrame:
    """(image_id, y, x, features map): multi-scale features of every pixel, for a pixel classifier."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                found = I.multiscale_features(np.asarray(r.pixels, float).reshape(int(r.height), int(r.width)), sigmas)
                names, stack = list(found), np.stack([v.ravel() for v in found.values()], axis=1)
                y, x = np.divmod(np.arange(len(stack)), int(r.width))
                yield pd.DataFrame({"image_id": str(r.image_id), "y": y.astype(np.int32), "x": x.astype(np.int32), "features": [dict(zip(names, map(float, row), strict=True)) for row in stack]})

    return planes.select("image_id", "height", "width", "pixels").mapInPandas(run, "image_id string, y int, x int, features map<string,double>")


def training_samples(metadata: DataFrame, masks: DataFrame, images: DataFrame, train: int = 80, validation: int = 10) -> DataFrame:
    """Reviewed images with class and split: cell is 1, no_cell 2, others go; those without a mask or an image go too."""
    from cytoframe.functions.identity import review_status
    from cytoframe.operators.batching import hash_split

    status = review_status(F.col("status"))
    known = metadata.withColumn("class", F.when(status == "cell", 1).when(status == "no_cell", 2)).where(F.col("class").isNotNull())
    ready = known.join(masks.select("image_id").distinct(), "image_id", "left_semi").join(images.select("image_id", "path"), "image_id")
    return ready.withColumn("split", hash_split(F.col("image_id"), train, validation))


def training_tensors(samples: DataFrame, channels: list[str], multiple: int = 32, seed: int | None = None) -> DataFrame:
    """Samples (image_id, class, height, width, labels, planes) as (image_id, shape, image, target): channels chosen and stretched, missing ones zero, padded by reflection; with a seed they are augmented."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                h, w = int(r.height), int(r.width)
                own = dict(r.planes)
                stack = np.stack([np.asarray(own[c], float).reshape(h, w) if c in own else np.zeros((h, w)) for c in channels])
                span = np.ptp(stack, axis=(1, 2), keepdims=True)
                stack = (stack - stack.min(axis=(1, 2), keepdims=True)) / np.where(span > 0, span, 1)
                target = (np.asarray(r.labels, int).reshape(h, w) > 0) * int(r.kind)
                both = np.concatenate([I.pad_to_multiple(stack, multiple), np.pad(target, ((0, -h % multiple), (0, -w % multiple)))[None]])
                if seed is not None:
                    both = I.augment(both, (hash_text(str(r.image_id)) + seed) % (1 << 32))
                out.append((str(r.image_id), list(both.shape[1:]), both[:-1].ravel().tolist(), both[-1].astype(int).ravel().tolist()))
            yield pd.DataFrame(out, columns=["image_id", "shape", "image", "target"])

    chosen = samples.select("image_id", F.col("class").alias("kind"), "height", "width", "labels", "planes")
    return chosen.mapInPandas(run, "image_id string, shape array<int>, image array<double>, target array<int>")


def hash_text(text: str) -> int:
    import zlib

    return zlib.crc32(text.encode())
