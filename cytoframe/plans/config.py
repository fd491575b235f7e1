"""A run's configuration: frozen, checked, hashed and scaled before anything is planned."""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import asdict, dataclass, field, fields, is_dataclass
from typing import Any, get_type_hints

from cytoframe.plans import calibration

STAGES = ("setup", "segment", "compile", "filter", "crop", "classify", "final", "metadata")


@dataclass(frozen=True)
class Inputs:
    image_dir: str = ""
    pattern: str = "*"
    recursive: bool = True
    n_batches: int = 1
    skip_list: str = ""


@dataclass(frozen=True)
class Segmentation:
    method: int = 5
    min_particle_size: int = 50
    min_hole_size: int = 50
    pixel_microns: float = calibration.REFERENCE
    reference_pixel_microns: float = calibration.REFERENCE
    phase_channel: str = "Phase"
    center_window_px: int = 20


@dataclass(frozen=True)
class Filter:
    enabled: bool = True
    rules: dict[str, Any] = field(default_factory=dict)
    require_included: bool = True


@dataclass(frozen=True)
class Crops:
    crop_size: int = 154
    min_bbox_pad: int = 6
    edge_pad_mode: str = "reflect"
    channels: tuple[str, ...] = ()


@dataclass(frozen=True)
class Classifier:
    enabled: bool = False
    threshold: float = 0.5
    keep_class: str = "cell"
    shards: int = 1


@dataclass(frozen=True)
class Labels:
    registry: str = ""
    source: str = "plate_scene"
    pattern: str = ""
    how: str = "left"


@dataclass(frozen=True)
class Run:
    name: str = "run"
    output_dir: str = "output"
    seed: int = 0
    inputs: Inputs = field(default_factory=Inputs)
    segmentation: Segmentation = field(default_factory=Segmentation)
    filter: Filter = field(default_factory=Filter)
    crops: Crops = field(default_factory=Crops)
    classifier: Classifier = field(default_factory=Classifier)
    labels: Labels = field(default_factory=Labels)

    def __post_init__(self) -> None:
        checks = {
            "n_batches": self.inputs.n_batches >= 1, "shards": self.classifier.shards >= 1, "threshold": 0 <= self.classifier.threshold <= 1, "method": self.segmentation.method in range(6),
            "edge_pad_mode": self.crops.edge_pad_mode in ("reflect", "constant"), "labels.how": self.labels.how in ("left", "inner", "outer"), "labels.source": self.labels.source in ("plate_scene", "source_path", "original_cell_id"),
        }
        if wrong := [k for k, ok in checks.items() if not ok]:
            raise ValueError(f"out of range: {', '.join(wrong)}")

    @property
    def scale(self) -> float:
        return calibration.spatial_scale(self.segmentation.pixel_microns, self.segmentation.reference_pixel_microns)

    def scaled(self) -> dict[str, Any]:
        """All settings in this calibration's pixels."""
        return calibration.scaled_settings(asdict(self), self.scale)

    def run_hash(self) -> str:
        """A digest of all that decides the result."""
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, default=str).encode()).hexdigest()[:16]


def _build(kind: type, values: dict[str, Any], where: str) -> Any:
    known = {f.name for f in fields(kind)}
    if unknown := sorted(set(values) - known):
        raise ValueError(f"unknown settings{f' in {where}' if where else ''}: {', '.join(unknown)}")
    hints = get_type_hints(kind)
    out = {}
    for key, value in values.items():
        if is_dataclass(hints[key]):
            out[key] = _build(hints[key], value or {}, f"{where}.{key}".lstrip("."))
        else:
            out[key] = tuple(value) if isinstance(value, list) else value
    return kind(**out)


def load(text: str, environment: dict[str, str] | None = None) -> Run:
    """A run from YAML or JSON text; ``$NAME`` in it comes from the environment."""
    import string

    text = string.Template(text).safe_substitute(os.environ if environment is None else environment)
    try:
        values = json.loads(text)
    except ValueError:
        import yaml

        values = yaml.safe_load(text)
    if not isinstance(values, dict):
        raise ValueError("a configuration is a mapping")
    return _build(Run, values, "")


def plan(run: Run) -> list[str]:
    """The stages of a run, in order, with their batches and shards."""
    out = ["setup", *[f"segment:{i + 1}" for i in range(run.inputs.n_batches)], "compile"]
    out += ["filter"] if run.filter.enabled else []
    out += ["crop", *[f"classify:{k}/{run.classifier.shards}" for k in range(run.classifier.shards)]] if run.classifier.enabled else []
    return [*out, "final", "metadata"]


def nested(flat: dict[str, Any]) -> dict[str, Any]:
    """Keys with dots as nested mappings."""
    out: dict[str, Any] = {}
    for key, value in flat.items():
        at = out
        *path, last = key.split(".")
        for p in path:
            at = at.setdefault(p, {})
        at[last] = value
    return out
