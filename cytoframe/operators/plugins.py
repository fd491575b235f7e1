"""Channel plugins: extra features of channels whose names they match."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from cytoframe.functions import imaging


@dataclass(frozen=True)
class Context:
    """What a plugin gets of one cell and channel; the profile is freed of its background."""

    image: np.ndarray
    mask: np.ndarray
    core: np.ndarray
    midline: np.ndarray | None
    profile: np.ndarray | None
    background: float


@dataclass(frozen=True)
class Plugin:
    """A name, the words of the channels that it is for, its features, and how to get them and its events."""

    name: str
    words: tuple[str, ...]
    suffixes: tuple[str, ...]
    extract: Callable[[Context], tuple[dict[str, float], list[dict]]]

    def matches(self, channel: str) -> bool:
        return any(w in channel.lower() for w in self.words)

    def empty(self) -> dict[str, float]:
        return dict.fromkeys(self.suffixes, float("nan"))


def _poles(c: Context) -> tuple[dict[str, float], list[dict]]:
    p = c.profile
    if p is None or len(p) < 10:
        return {}, []
    n, eps = len(p), 1e-10
    end, low, high = max(1, round(n * 0.1)), round(n * 0.45), round(n * 0.55)
    a, b, m = p[:end].mean(), p[-end:].mean(), p[low:high].mean()
    asym, rich = abs(a - b) / (a + b + eps), m / (0.5 * (a + b) + eps)
    state = 3 if rich >= 1.5 else 1 if asym >= 0.3 else 2
    return {"poleA": a, "poleB": b, "center": m, "polar_asym": asym, "center_enrichment": rich, "peak_count": float(imaging.count_peaks(p)), "state_code": float(state)}, []


#: How spots are looked for in a channel.
SPOT_SETTINGS = {"min_distance": 1, "threshold_rel": 0.1, "smooth": 0.5, "log_sigma": 1.0}


def _spots(c: Context) -> tuple[dict[str, float], list[dict]]:
    found = imaging.detect_spots(c.image, c.mask, c.core, c.background, **SPOT_SETTINGS)
    for i, s in enumerate(found):
        s["punctum_id"] = i
        s["axial_s"], s["radial_r"] = imaging.axial_radial(s["y_px"], s["x_px"], c.midline) if c.midline is not None and len(c.midline) > 1 else (float("nan"), float("nan"))
    if not found:
        return {"puncta_count": 0.0}, []
    peaks, sizes = [s["peak_intensity"] for s in found], [s["sigma_px"] for s in found]
    return {"puncta_count": float(len(found)), "puncta_total_intensity": sum(peaks), "puncta_max_intensity": max(peaks), "puncta_mean_sigma_px": float(np.mean(sizes)), "puncta_max_sigma_px": max(sizes), "puncta_fraction": sum(peaks) / (float(c.image[c.mask].sum()) + 1e-10)}, found if c.midline is not None else []


POLES = Plugin("poles", ("af405", "hada"), ("poleA", "poleB", "center", "polar_asym", "center_enrichment", "peak_count", "state_code"), _poles)
SPOTS = Plugin("spots", ("bod493", "bodipy"), ("puncta_count", "puncta_total_intensity", "puncta_max_intensity", "puncta_mean_sigma_px", "puncta_max_sigma_px", "puncta_fraction"), _spots)
REGISTRY: list[Plugin] = [POLES, SPOTS]


def matching(channel: str, plugins: list[Plugin]) -> list[Plugin]:
    return [p for p in plugins if p.matches(channel)]


def register(plugin: Plugin) -> None:
    REGISTRY.append(plugin)
