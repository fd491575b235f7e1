"""Pixel sizes: what a setting made for one calibration is at another."""

from __future__ import annotations

import math

REFERENCE = 0.0645
#: Settings in pixels, and the power of the scale that each follows.
SCALED = {"crop_size": 1, "min_bbox_pad": 1, "edge_width": 1, "window": 1, "block_size": 1, "min_branch_length": 1, "center_window_px": 1, "min_particle_size": 2, "min_hole_size": 2, "area_min": 2, "area_max": 2}
ODD = ("window", "block_size")


def spatial_scale(pixel_microns: float, reference: float = REFERENCE) -> float:
    """Pixels of this calibration for one of the reference's."""
    for value in (pixel_microns, reference):
        if not math.isfinite(value) or value <= 0:
            raise ValueError("pixel sizes are finite and above zero")
    return reference / pixel_microns


def scaled_integer(value: float, factor: float, minimum: int = 0, odd: bool = False) -> int:
    """A scaled whole number, halves up; for odd ones the odd number around it."""
    target = value * factor
    n = 2 * math.floor(target / 2) + 1 if odd else math.floor(target + 0.5)
    return max(minimum, n)


def scaled_settings(settings: dict, factor: float) -> dict:
    """A nested configuration whose known lengths and areas in pixels are scaled."""
    out = {}
    for key, value in settings.items():
        if isinstance(value, dict):
            out[key] = scaled_settings(value, factor)
        elif key in SCALED and isinstance(value, (int, float)) and not isinstance(value, bool):
            out[key] = scaled_integer(value, factor ** SCALED[key], 3 if key in ODD else 1, key in ODD)
        else:
            out[key] = value
    return out
