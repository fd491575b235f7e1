"""Pixel classes by a U-Net whose weights are a table: Spark deals the images out, each executor holds the weights once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.functions import imaging as I
from cytoframe.functions.unet import UNet

WEIGHTS = "name string, shape array<int>, values binary, kind string"
#: Megabytes of weights that are broadcast at most, and pixels of all channels that go through a network at once.
MOST_WEIGHTS_MB, PIXELS_AT_ONCE = 1024, 1 << 20


def weights_table(spark: SparkSession, arrays: dict[str, np.ndarray]) -> DataFrame:
    """(name, shape, values, kind): a checkpoint's arrays, as they are kept in Parquet."""
    return spark.createDataFrame([(n, list(a.shape), np.ascontiguousarray(a).tobytes(), a.dtype.str) for n, a in arrays.items()], WEIGHTS)


class Weights:
    """A network that is broadcast as arrays and put together once in each worker."""

    def __init__(self, arrays: Broadcast):
        self.arrays, self._network = arrays, None

    def __getstate__(self) -> dict:
        return {"arrays": self.arrays, "_network": None}

    def network(self) -> UNet:
        if self._network is None:
            self._network = UNet(self.arrays.value)
        return self._network

    def __call__(self, planes: np.ndarray) -> np.ndarray:
        """Logits of one image (channels, rows, columns): a scorer for `segmentation.classify_crops` and `segmentation.predicted_cells`."""
        return self.network()(planes[None])[0]


def broadcast_weights(table: DataFrame, most_mb: int = MOST_WEIGHTS_MB) -> Weights:
    """The weights of a table (`weights_table`), whose size is checked before anything is read."""
    size = (table.agg(F.sum(F.octet_length("values")).alias("n")).first().n or 0) / (1 << 20)
    if size > most_mb:
        raise ValueError(f"{size:.0f} MB of weights, where {most_mb} may be broadcast")
    arrays = {r.name: np.frombuffer(r.values, r.kind).reshape(tuple(r.shape)) for r in table.collect()}
    UNet(arrays)
    return Weights(table.sparkSession.sparkContext.broadcast(arrays))


def _stretched(planes: np.ndarray) -> np.ndarray:
    """Each channel from 0 to 1; a flat one is 0."""
    low, span = planes.min(axis=(1, 2), keepdims=True), np.ptp(planes, axis=(1, 2), keepdims=True)
    return (planes - low) / np.where(span > 0, span, 1)


def _scored(network: UNet, images: list[np.ndarray], multiple: int) -> list[np.ndarray]:
    """Class probabilities of images; those of one shape go through the network together, a bounded number of pixels at a time."""
    out: list[np.ndarray | None] = [None] * len(images)
    shapes: dict[tuple, list[int]] = {}
    for i, x in enumerate(images):
        shapes.setdefault(x.shape, []).append(i)
    for shape, at in shapes.items():
        step = max(1, PIXELS_AT_ONCE // max(1, int(np.prod(shape))))
        for k in range(0, len(at), step):
            some = at[k : k + step]
            logits = network(np.stack([I.pad_to_multiple(_stretched(images[i]), multiple) for i in some]))
            for i, one in zip(some, I.softmax(logits[:, :, : shape[1], : shape[2]].astype(float), axis=1), strict=True):
                out[i] = one
    return out


_PREDICTED = "image_id string, height int, width int, classes array<int>, probabilities array<array<double>>, error string"


def predict(images: DataFrame, weights: Weights, channels: list[int] | None = None, multiple: int = 32) -> DataFrame:
    """(image_id, height, width, classes, probabilities, error) of images (image_id, height, width, planes array<array<double>>).

    ``channels`` are the planes that the network sees, in its order, the first alone
    unless they are named; planes that an image lacks are zeros.  Planes are
    stretched to 0..1, padded by reflection to multiples of ``multiple`` and
    unpadded after.  ``classes`` is the likeliest class of each pixel, the lower of
    equals, row by row, ``probabilities`` an array of pixels for each class.  Images
    without planes, of no pixels or of the wrong size have an error and no classes;
    values that are null or not finite are 0.
    """
    chosen = channels or [0]

    def decoded(h: int | None, w: int | None, planes: pa.Scalar) -> np.ndarray:
        if h is None or w is None or not planes.is_valid or not len(planes.values) or h * w <= 0:
            raise ValueError("no pixels")
        found = []
        for c in chosen:
            plane = planes.values[c] if 0 <= c < len(planes.values) else None
            values = np.zeros(h * w) if plane is None or not plane.is_valid else np.nan_to_num(plane.values.to_numpy(zero_copy_only=False).astype(float), posinf=0.0, neginf=0.0)
            if len(values) != h * w:
                raise ValueError(f"{len(values)} values for {h} by {w} pixels")
            found.append(values.reshape(h, w))
        return np.stack(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = weights.network()
        for whole in batches:
            for start in range(0, len(whole), 256):
                batch = whole.slice(start, 256)
                ids, heights, widths = (batch.column(k).to_pylist() for k in range(3))
                images, errors = [], []
                for h, w, planes in zip(heights, widths, batch.column(3), strict=True):
                    try:
                        images.append(decoded(h, w, planes))
                        errors.append(None)
                    except ValueError as error:
                        errors.append(str(error))
                scored = iter(_scored(network, images, multiple))
                p = [None if e else next(scored) for e in errors]
                classes = [None if x is None else x.argmax(axis=0).ravel().astype(np.int32) for x in p]
                probabilities = [None if x is None else list(x.reshape(len(x), -1)) for x in p]
                columns = [(ids, pa.string()), (heights, pa.int32()), (widths, pa.int32()), (classes, pa.list_(pa.int32())), (probabilities, pa.list_(pa.list_(pa.float64()))), (errors, pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=[n.split()[0] for n in _PREDICTED.split(", ")])

    return images.select(F.col("image_id").cast("string"), F.col("height").cast("int"), F.col("width").cast("int"), F.col("planes").cast("array<array<double>>")).mapInArrow(run, _PREDICTED)


def class_summary(predicted: DataFrame, names: tuple[str, ...] = ("background", "cell", "non_cell")) -> DataFrame:
    """(image_id, n_<class>, p_<class>, predicted_class): pixels and mean probability of each class; the likeliest, the lower of equals."""
    n = [(F.size("classes") - F.size(F.array_remove("classes", k))).cast("long").alias(f"n_{name}") for k, name in enumerate(names)]
    mean = [F.aggregate(F.get("probabilities", F.lit(k)), F.lit(0.0), lambda a, x: a + x) / F.size(F.get("probabilities", F.lit(k))) for k in range(len(names))]
    best = F.array_position(F.array(*[m.alias(name) for m, name in zip(mean, names, strict=True)]), F.greatest(*mean))
    label = F.element_at(F.array(*map(F.lit, names)), best.cast("int"))
    return predicted.where("error IS NULL").select("image_id", *n, *[m.alias(f"p_{name}") for m, name in zip(mean, names, strict=True)], label.alias("predicted_class"))


def cell_masks(predicted: DataFrame, threshold: float = 0.5, margin: float | None = None) -> DataFrame:
    """(image_id, height, width, labels): 1 in the largest component of pixels whose likeliest class is cell, at ``threshold``, ``margin`` ahead of class 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, w = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            masks = []
            for k, (classes, p) in enumerate(zip(batch.column(3), batch.column(4), strict=True)):
                of = [x.values.to_numpy().reshape(h[k], w[k]) for x in p.values]
                sure = (classes.values.to_numpy().reshape(h[k], w[k]) == 1) & (of[1] >= threshold)
                masks.append(I.largest_component(sure & (of[1] >= of[2] + margin) if margin is not None else sure).ravel().astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(masks, pa.list_(pa.int32()))], names=["image_id", "height", "width", "labels"])

    return predicted.where("error IS NULL").mapInArrow(run, "image_id string, height int, width int, labels array<int>")
