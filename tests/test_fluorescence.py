"""Fluorescence of cells on crops made by hand, against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoframe.functions import imaging as I
from cytoframe.operators import plugins as PL
from cytoframe.operators import segmentation as S


def kernel(sigma):
    r = int(4 * sigma + 0.5)
    k = [math.exp(-0.5 * t * t / sigma**2) for t in range(-r, r + 1)]
    return [v / sum(k) for v in k], r


def at(v, y, x, mode):
    h, w = v.shape
    if mode == "edge":
        return v[min(max(y, 0), h - 1), min(max(x, 0), w - 1)]
    y, x = y % (2 * h), x % (2 * w)
    return v[y if y < h else 2 * h - 1 - y, x if x < w else 2 * w - 1 - x]


def blurred(v, ky, kx, r, mode):
    return np.array([[sum(ky[a + r] * kx[b + r] * at(v, y + a, x + b, mode) for a in range(-r, r + 1) for b in range(-r, r + 1)) for x in range(v.shape[1])] for y in range(v.shape[0])])


def spots(img, mask, core, background, smooth=0.5, log_sigma=1.0, rel=0.1):
    """(y, x, intensity, |LoG|) of every peak, one rule after another."""
    above = np.maximum(img - background, 0)
    k, r = kernel(smooth)
    v = blurred(above, k, k, r, "edge")
    v = (v - v.min()) / np.ptp(v)
    k, r = kernel(log_sigma)
    k2 = [g * (t * t - log_sigma**2) / log_sigma**4 for t, g in zip(range(-r, r + 1), k, strict=True)]
    log = blurred(v, k2, k, r, "reflect") + blurred(v, k, k2, r, "reflect")
    response = np.where(mask & core, -log, 0.0)
    floor = max(rel * response.max(), response.min())
    found = []
    for y in range(1, img.shape[0] - 1):
        for x in range(1, img.shape[1] - 1):
            if response[y, x] > floor and response[y, x] == response[y - 1 : y + 2, x - 1 : x + 2].max():
                a, b = y, x
                for _ in range(2):
                    patch = v[a - 1 : a + 2, b - 1 : b + 2]
                    if patch[1, 1] == patch.max():
                        place = [c + 0.5 * (q[0] - q[2]) / (q[0] - 2 * q[1] + q[2]) for c, q in ((a, patch[:, 1]), (b, patch[1]))]
                        found.append((*place, above[y, x], abs(log[y, x])))
                        break
                    dy, dx = np.unravel_index(patch.argmax(), (3, 3))
                    a, b = a + dy - 1, b + dx - 1
    return found


def rod(h=24, w=44):
    y, x = np.mgrid[:h, :w]
    return (np.abs(y - 12) <= 5) & (np.abs(x - 22) <= 15)


def features(img, channel="AF405", mask=None):
    mask = rod() if mask is None else mask
    line = np.column_stack([np.full(25, 12.0), np.linspace(10, 34, 25)])
    f, p, events = S.fluorescence(np.asarray(img, float), mask, line, channel)
    return f, p, events


def ramp(falling=False):
    img = np.full((24, 44), 10.0)
    x = np.arange(44.0)
    img[rod()] = np.broadcast_to(20 + 3 * (44 - x if falling else x), (24, 44))[rod()]
    return img


def test_a_bright_second_pole_comes_first():
    up, p, _ = features(ramp())
    down, q, _ = features(ramp(falling=True))
    assert p[0] > p[-1] and up["AF405_midline_peak_position"] == 0.0 and q[0] > q[-1]
    assert up["AF405_poleA"] > up["AF405_poleB"] and down["AF405_poleA"] > down["AF405_poleB"]
    assert np.allclose(p, np.interp(np.linspace(0, 24, 100), np.arange(25), 20 + 3 * np.arange(34, 9, -1.0)))


def test_poles_are_freed_of_the_background():
    f, p, _ = features(ramp())
    n = p - 10
    assert f["AF405_bg_mean"] == 10 and f["AF405_midline_mean"] == pytest.approx(p.mean())
    a, b, m = n[:10].mean(), n[-10:].mean(), n[45:55].mean()
    assert (f["AF405_poleA"], f["AF405_poleB"], f["AF405_center"]) == pytest.approx((a, b, m))
    assert f["AF405_polar_asym"] == pytest.approx((a - b) / (a + b)) and f["AF405_center_enrichment"] == pytest.approx(m / (0.5 * (a + b)))
    assert f["AF405_state_code"] == (3 if m / (0.5 * (a + b)) >= 1.5 else 1 if (a - b) / (a + b) >= 0.3 else 2) == 1
    raw = (p[:10].mean() - p[-10:].mean()) / (p[:10].mean() + p[-10:].mean())
    assert raw < f["AF405_polar_asym"]  # the background would hide a part of it


def spotted(*places, ground=10.0, outside=()):
    img = np.full((24, 44), ground)
    y, x = np.mgrid[:24, :44]
    for a, b, height in (*places, *outside):
        img += height * np.exp(-((y - a) ** 2 + (x - b) ** 2) / 2)
    return img


@pytest.mark.parametrize(
    ("places", "outside", "ground"),
    [([(11.3, 15.2, 60), (13, 28.4, 40)], [], 10.0), ([(11.3, 15.2, 60), (13, 28.4, 40)], [(2, 4, 300)], 10.0), ([(8, 20, 50), (12, 20, 30), (12, 31, 6)], [(12, 41, 100)], 0.0), ([(12, 22, 5)], [(5.5, 22, 200)], 50.0), ([(12, 12, 70), (12, 14.5, 69)], [], 3.0)],
)
def test_spots_equal_plain_loops(places, outside, ground):
    img = spotted(*places, ground=ground, outside=outside) + np.random.default_rng(1).uniform(0, 0.3, (24, 44))
    f, _, events = features(img, "Bod493")
    want = spots(img, rod(), I.erode(rod(), 2), f["Bod493_bg_mean"])
    got = [(e["y_px"], e["x_px"], e["peak_intensity"], e["sigma_px"]) for e in events]
    assert len(got) == len(want) and np.allclose(sorted(got), sorted(want))
    assert f["Bod493_puncta_count"] == len(want)
    if want:
        peaks, sizes = [s[2] for s in want], [s[3] for s in want]
        assert f["Bod493_puncta_total_intensity"] == pytest.approx(sum(peaks)) and f["Bod493_puncta_max_intensity"] == pytest.approx(max(peaks))
        assert f["Bod493_puncta_mean_sigma_px"] == pytest.approx(np.mean(sizes)) and f["Bod493_puncta_max_sigma_px"] == pytest.approx(max(sizes))
        assert f["Bod493_puncta_fraction"] == pytest.approx(sum(peaks) / img[rod()].sum())


def test_a_bright_pixel_outside_weakens_what_is_inside():
    """The crop is stretched as a whole: a bright neighbour does not vanish before that."""
    alone = features(spotted((12, 22, 30)), "Bod493")[2]
    beside = features(spotted((12, 22, 30), outside=[(2, 2, 600)]), "Bod493")[2]
    assert len(alone) == len(beside) == 1 and beside[0]["sigma_px"] < alone[0]["sigma_px"] / 5
    assert beside[0]["peak_intensity"] == pytest.approx(alone[0]["peak_intensity"], rel=0.05)
    assert alone[0]["peak_intensity"] == pytest.approx(30, rel=0.02)  # ten of the forty are background


def test_cells_without_spots_core_or_line():
    f, _, events = features(np.full((24, 44), 7.0), "Bod493")
    assert f["Bod493_puncta_count"] == 0 and math.isnan(f["Bod493_puncta_fraction"]) and events == []
    thin = np.zeros((24, 44), bool)
    thin[12, 8:36] = True
    f, _, events = features(spotted((12, 22, 30)), "Bod493", thin)
    assert f["Bod493_puncta_count"] == 0 and events == []  # no core, no spots
    context = PL.Context(spotted((12, 22, 30)), rod(), I.erode(rod(), 2), None, None, 10.0)
    found, rows = PL.SPOTS.extract(context)
    assert found["puncta_count"] == 1 and rows == [] and PL.POLES.extract(context) == ({}, [])
    flat = np.zeros((5, 5))
    flat[2, 2:4] = 1
    assert I.refine_peak(2, 2, flat) is None and I.refine_peak(0, 2, flat) is None


def test_a_table_of_cells(spark):
    img, mask = spotted((11, 15, 60), (13, 28, 40)), rod().astype(int)
    rows = [("i", 24, 44, mask.ravel().tolist(), {"Phase": ramp().ravel().tolist(), "AF405": ramp().ravel().tolist(), "Bod493": img.ravel().tolist()})]
    df = spark.createDataFrame(rows, "image_id string, height int, width int, labels array<int>, planes map<string,array<double>>")
    got = S.extract_features(df).first()
    assert got.error is None and got.features["AF405_poleA"] > got.features["AF405_poleB"] and got.profiles["AF405"][0] > got.profiles["AF405"][-1]
    assert len(got.puncta) == 2 == got.features["Bod493_puncta_count"] and {(round(p.y_px), round(p.x_px)) for p in got.puncta} == {(11, 15), (13, 28)}
    assert all(p.sigma_px != 1.5 and 0 <= p.axial_s <= 1 for p in got.puncta)
    assert S.profile_rows(S.extract_features(df).withColumn("cell_id", F.lit("c"))).where("channel = 'AF405'").first().n_points == 100
