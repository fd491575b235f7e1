"""Declared schemas: no boundary inside the engine infers types."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_PLAIN = {"string": T.StringType, "int": T.IntegerType, "long": T.LongType, "double": T.DoubleType, "boolean": T.BooleanType, "timestamp": T.TimestampType}


def _schema(text: str) -> T.StructType:
    """A schema from its short form, without a session: ``name type`` or ``name: type`` with commas between."""
    tokens = re.findall(r"\w+|[<>,]", text)

    def kind() -> T.DataType:
        word = tokens.pop(0)
        if word in _PLAIN:
            return _PLAIN[word]()
        tokens.pop(0)
        if word == "array":
            out: T.DataType = T.ArrayType(kind())
        elif word == "map":
            key = kind()
            tokens.pop(0)
            out = T.MapType(key, kind())
        else:
            out = fields()
        tokens.pop(0)
        return out

    def fields() -> T.StructType:
        out = []
        while tokens and tokens[0] != ">":
            if tokens[0] == ",":
                tokens.pop(0)
            name = tokens.pop(0)
            out.append(T.StructField(name, kind()))
        return T.StructType(out)

    return fields()


BBOX = ("bbox_min_row", "bbox_min_col", "bbox_max_row", "bbox_max_col")

PLANES = _schema("image_id string, channel string, height int, width int, dtype string, page int, pixels array<double>, info string, error string")
PIXELS = _schema("image_id string, channel string, y int, x int, value double")
MASK_PIXELS = _schema("image_id string, label int, y int, x int")
MASKS = _schema("image_id string, height int, width int, labels array<int>")
CELL = _schema(
    "label int, cell_id string, included boolean, override string, note string, failure_reasons array<string>, bbox array<int>, centroid array<double>, touching_edge boolean,"
    " metrics struct<area: double, area_px: double, length_um: double, width_um: double, aspect_ratio: double, eccentricity: double, solidity: double, sinuosity: double, intensity: map<string, double>>,"
    " is_central boolean, distance_to_center_px double"
)
METADATA = T.StructType([T.StructField("image_id", T.StringType()), T.StructField("source_path", T.StringType()), T.StructField("central_label", T.IntegerType()), T.StructField("cells", T.ArrayType(CELL))])
BATCH_MANIFEST = _schema("batch string, source_path string, link_path string")
CROP_MANIFEST = _schema(
    "Cell_ID string, cell_hash string, segmentation_run_hash string, source_image string, image_id string, label int, source_path string, crop_path string, mask_path string,"
    " bbox_min_row int, bbox_min_col int, bbox_max_row int, bbox_max_col int, centroid_row double, centroid_col double, crop_size int, channels string, included boolean"
)
CLASSIFICATION = _schema("Cell_ID string, crop_path string, predicted_class string, confidence double, p_background double, p_cell double, p_noncell double, predicted_cell boolean")
LOOKUP = _schema(
    "cell_id string, hash string, source_path string, source_filename string, mask_label int, bbox_min_row int, bbox_min_col int, bbox_max_row int, bbox_max_col int, plate string, scene string, position string, created_at timestamp"
)
PROFILES = _schema("cell_id string, channel string, profile_kind string, n_points int, profile array<double>")
PUNCTA = _schema("cell_id string, channel string, punctum_id int, y_px double, x_px double, sigma_px double, peak_intensity double, axial_s double, radial_r double")
FEATURES_LONG = _schema("cell_id string, feature string, value double")
PADMAP = _schema("padmap_id string, padmap_drug string")
OVERLAP = _schema("frame1_id string, frame2_id string, overlap_area long, frame1_area long, frame2_area long, frame1_overlap_frac double, frame2_overlap_frac double, iou double")
DIAGNOSTICS = ("Cell_ID", "image_id", "label", "included", "filter_passed", "filter_reasons", "predicted_class", "p_cell", "area_px", "aspect_ratio", "length_um", "width_um")

INTENSITY = ("mean", "median", "std", "var", "min", "max", "range", "q1", "q3", "iqr", "p5", "p95", "cv", "skewness", "kurtosis", "entropy")
PROFILE = ("mean", "std", "min", "max", "range", "gradient_mean", "gradient_max", "polar_ratio", "polar_diff", "peak_position", "peak_value")
FLUORESCENCE = ("bg_mean", "bg_median", "bg_std", "mean_bgsub", "shell_mean", "core_mean", "shell_core_ratio", "midline_mean", "midline_max", "midline_gradient_mean", "midline_gradient_max", "midline_peak_position", "midline_peak_value")
#: Names and order of the shape columns.
MORPHOLOGY = (
    "area_px", "area_um2", "perimeter_px", "perimeter_um", "major_axis_px", "major_axis_um", "minor_axis_px", "minor_axis_um", "eccentricity", "solidity", "extent", "orientation", "convex_area_px", "filled_area_px",
    "equivalent_diameter_px", "equivalent_diameter_um", "compactness", "circularity", "rough_length_px", "rough_length_um", "aspect_ratio", *[f"hu_moment_{i}" for i in range(7)],
    "centroid_row", "centroid_col", *BBOX, "mean_intensity", "max_intensity", "min_intensity",
    "length_px", "length_um", "sinuosity", *[f"width_{s}_{u}" for s in ("median", "std", "max", "min", "q1", "q3") for u in ("px", "um")], "curvature_mean", "curvature_std", "curvature_max", "curvature_min",
)


def intensity_names(channel: str) -> list[str]:
    return [f"intensity_{channel}_{s}" for s in INTENSITY]


def profile_names(channel: str) -> list[str]:
    return [f"profile_{channel}_{s}" for s in PROFILE]


def fluorescence_names(channel: str) -> list[str]:
    return [f"{channel}_{s}" for s in FLUORESCENCE]


def feature_names(channels: list[str], phase: str = "Phase", plugins: list | None = None) -> list[str]:
    """The ordered feature columns of a set of channels: morphology, intensity and profiles of each, then fluorescence and plugin extras of all but phase."""
    from cytoframe.operators.plugins import REGISTRY, matching

    out = list(MORPHOLOGY)
    channels = channels if phase in channels else [phase, *channels]
    for channel in channels:
        out += intensity_names(channel)
    for channel in channels:
        out += profile_names(channel)
    for channel in channels:
        if channel != phase:
            out += fluorescence_names(channel)
            for plugin in matching(channel, REGISTRY if plugins is None else plugins):
                out += [f"{channel}_{s}" for s in plugin.suffixes]
    return out
