"""Per-image segmentation and per-cell features: one image at a time in numpy, images spread over tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe import schemas
from cytoframe.functions import imaging as I
from cytoframe.operators.plugins import REGISTRY, Context, Plugin, matching


def per_plane(planes: DataFrame, kernel: Callable[[np.ndarray], np.ndarray], column: str = "pixels") -> DataFrame:
    """Planes (.., height, width, pixels) with pixels replaced by a kernel's plane; a null plane stays null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for pixels, h, w in zip(batch[column], batch["height"], batch["width"], strict=True):
                out.append(None if pixels is None else np.asarray(kernel(np.asarray(pixels, float).reshape(int(h), int(w))), float).ravel().tolist())
            yield batch.assign(**{column: out})

    return planes.mapInPandas(run, planes.schema)


def label_planes(planes: DataFrame, method: int = 5, min_size: int = 20, min_hole: int = 20, invert: bool = False, **how: Any) -> DataFrame:
    """Label masks of planes: threshold, holes filled, small objects removed, components numbered in raster order."""

    def kernel(img: np.ndarray) -> np.ndarray:
        mask = I.binarize(-img + img.max() if invert else img, method, **how)
        return I.label(I.remove_small(I.fill_small_holes(mask, min_hole), min_size))

    return per_plane(planes, kernel).withColumn("labels", F.transform("pixels", lambda v: v.cast("int"))).drop("pixels")


def label_components(masks: DataFrame, column: str = "labels") -> DataFrame:
    """Components of masks numbered anew."""
    return per_plane(masks.withColumn("pixels", F.transform(column, lambda v: v.cast("double"))).drop(column), lambda m: I.label(m > 0)).withColumn(column, F.transform("pixels", lambda v: v.cast("int"))).drop("pixels")


def drift_shifts(planes: DataFrame, keys: tuple[str, ...] = ("image_id",), reference: str = "Phase", upsample: int = 10) -> DataFrame:
    """(keys, channel, dy, dx): the shift that registers each channel of an image on its reference."""
    ref = planes.where(F.col("channel") == reference).select(*keys, F.col("pixels").alias("_r"))
    pairs = planes.where(F.col("channel") != reference).join(ref, list(keys)).select(*keys, "channel", "height", "width", "pixels", "_r")
    schema = ", ".join(f"{k} string" for k in keys) + ", channel string, dy double, dx double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                shape = (int(r.height), int(r.width))
                rows.append((*[str(getattr(r, k)) for k in keys], r.channel, *I.drift(np.asarray(r[-1], float).reshape(shape), np.asarray(r.pixels, float).reshape(shape), upsample)))
            yield pd.DataFrame(rows, columns=[*keys, "channel", "dy", "dx"])

    return pairs.mapInPandas(run, schema)


def correct_drift(planes: DataFrame, shifts: DataFrame, keys: tuple[str, ...] = ("image_id",), at_most: float = 20.0) -> DataFrame:
    """Planes moved by their shifts; those without one, or with a larger one than ``at_most``, stay."""
    joined = planes.join(shifts, [*keys, "channel"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            moved = [p if pd.isna(dy) else I.shifted(np.asarray(p, float).reshape(int(h), int(w)), (dy, dx), at_most).ravel().tolist() for p, h, w, dy, dx in zip(b["pixels"], b["height"], b["width"], b["dy"], b["dx"], strict=True)]
            yield b.assign(pixels=moved)[list(planes.columns)]

    return joined.select(*planes.columns, "dy", "dx").mapInPandas(run, planes.schema)


def subtract_background(planes: DataFrame, method: str = "rolling_ball", **how: Any) -> DataFrame:
    return per_plane(planes, lambda img: I.subtract_background(img, method, **how))


def bandpass(planes: DataFrame, pixel_microns: float, smallest: float, largest: float) -> DataFrame:
    return per_plane(planes, lambda img: I.bandpass(img, pixel_microns, smallest, largest))


def morphology(mask: np.ndarray, offset: tuple[int, int] = (0, 0), pixel_microns: float = 1.0, intensity: np.ndarray | None = None) -> dict[str, float]:
    """All shape features of one region, by name."""
    yx = np.argwhere(mask).astype(float)
    out = dict.fromkeys(schemas.MORPHOLOGY, float("nan"))
    if not len(yx):
        return out
    area, c = len(yx), yx.mean(axis=0)
    d = yx - c
    a, b, ab = (d[:, 0] ** 2).mean() + 1 / 12, (d[:, 1] ** 2).mean() + 1 / 12, (d[:, 0] * d[:, 1]).mean()
    root = np.hypot((a - b) / 2, ab)
    l1, l2 = (a + b) / 2 + root, max((a + b) / 2 - root, 0)
    perimeter, hull = I.perimeter(mask), I.convex_area(mask)
    low, high = yx.min(axis=0), yx.max(axis=0) + 1
    mu = {(p, q): float((d[:, 0] ** p * d[:, 1] ** q).sum()) / area ** ((p + q) / 2 + 1) for p in range(4) for q in range(4) if 2 <= p + q <= 3}
    e, f, g, h = mu[3, 0] + mu[1, 2], mu[2, 1] + mu[0, 3], mu[3, 0] - 3 * mu[1, 2], 3 * mu[2, 1] - mu[0, 3]
    u, v = mu[2, 0] - mu[0, 2], mu[1, 1]
    hu = [mu[2, 0] + mu[0, 2], u * u + 4 * v * v, g * g + h * h, e * e + f * f, g * e * (e * e - 3 * f * f) + h * f * (3 * e * e - f * f), u * (e * e - f * f) + 4 * v * e * f, h * e * (e * e - 3 * f * f) - g * f * (3 * e * e - f * f)]
    rough = (perimeter - np.sqrt(max(perimeter**2 - 16 * area, 0))) / 4
    diameter, px = np.sqrt(4 * area / np.pi), pixel_microns
    out |= {
        "area_px": area, "area_um2": area * px**2, "perimeter_px": perimeter, "perimeter_um": perimeter * px, "major_axis_px": 4 * np.sqrt(l1), "major_axis_um": 4 * np.sqrt(l1) * px, "minor_axis_px": 4 * np.sqrt(l2), "minor_axis_um": 4 * np.sqrt(l2) * px,
        "eccentricity": np.sqrt(max(1 - l2 / l1, 0)), "solidity": area / max(hull, 1), "extent": area / np.prod(high - low), "orientation": 0.5 * np.arctan2(2 * ab, a - b) if a != b else (-np.pi / 4 if ab < 0 else np.pi / 4),
        "convex_area_px": hull, "filled_area_px": int(I.fill_holes(mask).sum()), "equivalent_diameter_px": diameter, "equivalent_diameter_um": diameter * px,
        "compactness": perimeter**2 / (4 * np.pi * area), "circularity": 4 * np.pi * area / perimeter**2 if perimeter else float("nan"), "rough_length_px": rough, "rough_length_um": rough * px, "aspect_ratio": round(float(np.sqrt(l2 / l1)), 3),
        **{f"hu_moment_{i}": x for i, x in enumerate(hu)}, "centroid_row": c[0] + offset[0], "centroid_col": c[1] + offset[1],
        **dict(zip(schemas.BBOX, (low[0] + offset[0], low[1] + offset[1], high[0] + offset[0], high[1] + offset[1]), strict=True)),
    }
    if intensity is not None:
        values = intensity[mask]
        out |= {"mean_intensity": values.mean(), "max_intensity": values.max(), "min_intensity": values.min()}
    outline = I.contour(mask.astype(float))
    line = I.midline(mask, outline)
    length = 4 * np.sqrt(l1)
    if line is not None:
        length = I.curve_length(line)
        w = I.widths(line, outline)
        w = w[np.isfinite(w)]
        k = I.curvature(line)
        chord = float(np.hypot(*(line[-1] - line[0])))
        out |= {"sinuosity": max(1.0, round(length / chord, 3)) if chord else float("nan"), "curvature_mean": k.mean(), "curvature_max": k.max(), "curvature_min": k.min(), "curvature_std": k.std()}
        if len(w):
            stats = {"median": np.median(w), "std": w.std(), "max": w.max(), "min": w.min(), "q1": np.percentile(w, 25), "q3": np.percentile(w, 75)}
            out |= {f"width_{s}_px": v for s, v in stats.items()} | {f"width_{s}_um": v * px for s, v in stats.items()}
    return {k: float(v) for k, v in (out | {"length_px": length, "length_um": length * px}).items()}


def intensity(values: np.ndarray, channel: str) -> dict[str, float]:
    """Sixteen statistics of a channel within a region."""
    names = schemas.intensity_names(channel)
    if not len(values):
        return dict.fromkeys(names, float("nan"))
    m, s = values.mean(), values.std()
    q = np.percentile(values, [5, 25, 50, 75, 95])
    shape = (float("nan"), float("nan"))
    if len(values) >= 4 and s:
        z = (values - m) / s
        shape = ((z**3).mean(), (z**4).mean() - 3)
    density = np.histogram(values, 64, density=True)[0]
    density = density[density > 0]
    stats = (m, q[2], s, s**2, values.min(), values.max(), np.ptp(values), q[1], q[3], q[3] - q[1], q[0], q[4], s / abs(m) if m else float("nan"), *shape, -(density * np.log2(density + 1e-10)).sum())
    return dict(zip(names, map(float, stats), strict=True))


def profile(p: np.ndarray | None, channel: str) -> dict[str, float]:
    names = schemas.profile_names(channel)
    if p is None or len(p) < 3:
        return dict.fromkeys(names, float("nan"))
    g, half = np.abs(np.gradient(p)), len(p) // 2
    a, b = p[:half].mean(), p[half:].mean()
    return dict(zip(names, map(float, (p.mean(), p.std(), p.min(), p.max(), np.ptp(p), g.mean(), g.max(), a / (b + 1e-10), a - b, p.argmax() / len(p), p.max())), strict=True))


def fluorescence(image: np.ndarray, mask: np.ndarray, line: np.ndarray | None, channel: str, points: int = 100, plugins: list[Plugin] | None = None) -> tuple[dict[str, float], np.ndarray | None, list[dict]]:
    """Background, zones, profile and plugin features of a channel; its profile, brighter half first, and its events."""
    ring = I.dilate(mask, 5) & ~I.dilate(mask, 3)
    core = I.erode(mask, 2)
    shell = mask & ~core
    mean = lambda zone: float(image[zone].mean()) if zone.any() else float("nan")
    back = image[ring]
    p = I.resampled(I.along_strip(line, image), points) if line is not None and len(line) >= 3 else None
    p = None if p is None or not np.isfinite(p).all() else I.oriented(p)
    d = np.abs(np.diff(p)) if p is not None else None
    values = {
        "bg_mean": mean(ring), "bg_median": float(np.median(back)) if len(back) else float("nan"), "bg_std": float(back.std()) if len(back) else float("nan"), "mean_bgsub": mean(mask) - (mean(ring) if np.isfinite(mean(ring)) else 0.0),
        "shell_mean": mean(shell), "core_mean": mean(core), "shell_core_ratio": mean(shell) / (mean(core) + 1e-10),
        **(dict.fromkeys(schemas.FLUORESCENCE[7:], float("nan")) if p is None else dict(zip(schemas.FLUORESCENCE[7:], map(float, (p.mean(), p.max(), d.mean(), d.max(), p.argmax() / (len(p) - 1), p.max())), strict=True))),
    }
    events: list[dict] = []
    ground = values["bg_mean"] if np.isfinite(values["bg_mean"]) else 0.0
    context = Context(image, mask, core, line, None if p is None else p - ground, ground)
    for plugin in matching(channel, REGISTRY if plugins is None else plugins):
        found, more = plugin.extract(context)
        values |= plugin.empty() | found
        events += more
    return {f"{channel}_{k}": v for k, v in values.items()}, p, events


def boxes(labels: np.ndarray) -> dict[int, tuple[int, int, int, int]]:
    """The half-open box of every label, in one pass over the image."""
    y, x = np.nonzero(labels > 0)
    own = labels[y, x]
    order = np.argsort(own, kind="stable")
    own, y, x = own[order], y[order], x[order]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, int)
    if not len(first):
        return {}
    sides = [f.reduceat(v, first) for f, v in ((np.minimum, y), (np.minimum, x), (np.maximum, y), (np.maximum, x))]
    return {int(k): (int(a), int(b), int(c) + 1, int(d) + 1) for k, a, b, c, d in zip(own[first], *sides, strict=True)}


FEATURES_SCHEMA = "image_id string, label int, features map<string,double>, profiles map<string,array<double>>, puncta array<struct<channel:string,punctum_id:int,y_px:double,x_px:double,sigma_px:double,peak_intensity:double,axial_s:double,radial_r:double>>, error string"


def extract_features(images: DataFrame, pixel_microns: float = 1.0, phase: str = "Phase", pad: int = 24) -> DataFrame:
    """Features, profiles and spots of every cell.

    ``images`` has a row for each image: image_id, height, width, labels
    array<int> and planes map<string, array<double>>.  A cell is cut out with
    ``pad`` pixels around it, so that nothing depends on the frame's size; a cell
    that fails is a row with its error, and its features are null.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                h, w = int(r.height), int(r.width)
                labels = np.asarray(r.labels, np.int32).reshape(h, w)
                planes = {k: np.asarray(v, float).reshape(h, w) for k, v in dict(r.planes).items()}
                for k, (top, left, bottom, right) in boxes(labels).items():
                    try:
                        y0, y1, x0, x1 = max(0, top - pad), min(h, bottom + pad), max(0, left - pad), min(w, right + pad)
                        mask = I.largest_component(labels[y0:y1, x0:x1] == k)
                        first = planes[phase][y0:y1, x0:x1] if phase in planes else None
                        features = morphology(mask, (y0, x0), pixel_microns, first)
                        line = I.midline(mask)
                        profiles, puncta = {}, []
                        for name, plane in planes.items():
                            cut = plane[y0:y1, x0:x1]
                            features |= intensity(cut[mask], name)
                            strip = I.along_strip(line, cut) if line is not None else None
                            features |= profile(strip if strip is not None and np.isfinite(strip).all() else None, name)
                            if name != phase:
                                more, p, events = fluorescence(cut, mask, line, name)
                                features |= more
                                if p is not None:
                                    profiles[name] = p.tolist()
                                puncta += [{"channel": name, **{c: e[c] for c in ("punctum_id", "sigma_px", "peak_intensity", "axial_s", "radial_r")}, "y_px": e["y_px"] + y0, "x_px": e["x_px"] + x0} for e in events]
                        out.append((r.image_id, int(k), {a: float(b) for a, b in features.items()}, profiles, puncta, None))
                    except (ValueError, np.linalg.LinAlgError, IndexError) as error:
                        out.append((r.image_id, int(k), {}, {}, [], f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(out, columns=["image_id", "label", "features", "profiles", "puncta", "error"])

    return images.select("image_id", "height", "width", "labels", "planes").mapInPandas(run, FEATURES_SCHEMA)


def feature_table(features: DataFrame, channels: list[str], phase: str = "Phase") -> DataFrame:
    """One column for each feature of a set of channels, in the schema's order; NaN is null."""
    names = schemas.feature_names(channels, phase)
    return features.select("image_id", "label", *[F.nanvl(F.element_at("features", F.lit(n)), F.lit(None)).alias(n) for n in names])


def profile_rows(features: DataFrame, cell: str = "cell_id", kind: str = "midline") -> DataFrame:
    return features.select(cell, F.explode("profiles").alias("channel", "profile")).select(F.col(cell).alias("cell_id"), "channel", F.lit(kind).alias("profile_kind"), F.size("profile").alias("n_points"), "profile")


def puncta_rows(features: DataFrame, cell: str = "cell_id") -> DataFrame:
    return features.select(F.col(cell).alias("cell_id"), F.explode("puncta").alias("p")).select("cell_id", "p.*")


def crops(images: DataFrame, cells: DataFrame, size: int = 154, pad: int = 6, mode: str = "reflect") -> DataFrame:
    """One crop for each cell: every channel's window and the cell's own mask as one stack of 16 bits.

    ``images`` as for features; ``cells`` has image_id, label, Cell_ID, box and
    centroid.  Cells are joined to their image as one list, so that an image is
    decoded once; a crop is (Cell_ID, channels, side, stack array<array<int>>).
    """
    wanted = cells.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct("label", "Cell_ID", *schemas.BBOX, "centroid_row", "centroid_col"))).alias("cells"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                h, w = int(r.height), int(r.width)
                labels = np.asarray(r.labels, np.int32).reshape(h, w)
                planes = {k: np.asarray(v, float).reshape(h, w) for k, v in dict(r.planes).items()}
                rows = []
                for c in r.cells:
                    side = max(size, c["bbox_max_row"] - c["bbox_min_row"] + 2 * pad, c["bbox_max_col"] - c["bbox_min_col"] + 2 * pad)
                    cy, cx = (round(m if m is not None and np.isfinite(m) else (a + b) / 2) for m, a, b in ((c["centroid_row"], c["bbox_min_row"], c["bbox_max_row"]), (c["centroid_col"], c["bbox_min_col"], c["bbox_max_col"])))
                    y0, x0 = cy - side // 2, cx - side // 2
                    cut = [np.rint(I.extract_window(p, y0, y0 + side, x0, x0 + side, mode)).astype(np.int64) for p in planes.values()]
                    own = I.extract_window(labels, y0, y0 + side, x0, x0 + side, "constant")
                    own = np.where(own == c["label"], own, 0)
                    stack = I.as_uint16([*cut, own.astype(np.int64)])
                    rows.append((c["Cell_ID"], r.image_id, int(c["label"]), ";".join([*planes, "Mask"]), int(side), [p.ravel().astype(int).tolist() for p in stack]))
                yield pd.DataFrame(rows, columns=["Cell_ID", "image_id", "label", "channels", "side", "stack"])

    joined = images.join(wanted, "image_id").select("image_id", "height", "width", "labels", "planes", "cells")
    return joined.mapInPandas(run, "Cell_ID string, image_id string, label int, channels string, side int, stack array<array<int>>")


def classify_crops(crop_table: DataFrame, scorer: Callable[[np.ndarray], np.ndarray], threshold: float = 0.5, use_mask: bool = True) -> DataFrame:
    """Class probabilities of crops by a scorer that takes (channels, rows, columns) and gives (3, rows, columns) logits.

    Channels are stretched to 0..1, padded to multiples of 32 by reflection and
    unpadded after; probabilities are means over the mask, or over the middle
    without one; ties go to the lower class.  A crop that fails has its error.
    """
    classes = ("background", "cell", "non_cell")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                try:
                    stack = np.array([np.asarray(p, float).reshape(r.side, r.side) for p in r.stack])
                    roi = stack[-1] > 0 if use_mask and len(stack) > 1 else np.zeros((r.side, r.side), bool)
                    planes = stack[:-1] if len(stack) > 1 else stack
                    low, span = planes.min(axis=(1, 2), keepdims=True), np.ptp(planes, axis=(1, 2), keepdims=True)
                    logits = scorer(I.pad_to_multiple((planes - low) / np.where(span > 0, span, 1)))[:, : r.side, : r.side]
                    p = I.softmax(np.asarray(logits, float))
                    if not roi.any():
                        k = r.side // 4
                        roi[r.side // 2 - k : r.side // 2 + k + 1, r.side // 2 - k : r.side // 2 + k + 1] = True
                    mean = [round(float(c[roi].mean()), 6) for c in p]
                    best = int(np.argmax(mean))
                    rows.append((r.Cell_ID, classes[best], mean[best], *mean, bool(mean[1] >= threshold), None))
                except (ValueError, IndexError) as error:
                    rows.append((r.Cell_ID, None, None, None, None, None, None, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(rows, columns=["Cell_ID", "predicted_class", "confidence", "p_background", "p_cell", "p_noncell", "predicted_cell", "error"])

    return crop_table.mapInPandas(run, "Cell_ID string, predicted_class string, confidence double, p_background double, p_cell double, p_noncell double, predicted_cell boolean, error string")


def predicted_cells(planes: DataFrame, scorer: Callable[[np.ndarray], np.ndarray], least: float = 0.6, margin: float = 0.1) -> DataFrame:
    """Label masks where a scorer sees cells: class 1 leads, by ``margin`` over class 2, at ``least``; the largest component."""

    def kernel(img: np.ndarray) -> np.ndarray:
        p = I.softmax(np.asarray(scorer(I.pad_to_multiple(img[None])), float))[:, : img.shape[0], : img.shape[1]]
        sure = (p.argmax(axis=0) == 1) & (p[1] >= least) & (p[1] >= p[2] + margin)
        return I.largest_component(sure).astype(int)

    return per_plane(planes, kernel)
