import io
import struct
import zipfile

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cytoframe.functions import imaging as I
from cytoframe.operators import regions as R
from cytoframe.sources import rois as S


# ---- the format ------------------------------------------------------------


def test_a_file_put_together_by_hand():
    head = b"Iout" + struct.pack(">hBBhhhhH", 227, 7, 0, 10, 20, 14, 25, 3) + bytes(16) + bytes(2 + 4 + 4 + 4 + 2) + struct.pack(">h", 0) + bytes(4) + struct.pack(">ii", 9, 0)
    assert len(head) == 64
    got = S.decode_roi(head + struct.pack(">6h", 0, 5, 2, 0, 1, 4))
    assert got == {"name": None, "kind": "freehand", "top": 10, "left": 20, "bottom": 14, "right": 25, "position": 9, "xs": [20.0, 25.0, 22.0], "ys": [10.0, 11.0, 14.0]}
    box = head[:6] + b"\1" + head[7:16] + b"\0\0" + head[18:]
    assert S.decode_roi(box)["xs"] == [20.0, 25.0, 25.0, 20.0] and S.decode_roi(box)["ys"] == [10.0, 10.0, 14.0, 14.0]
    for bad in (b"", b"Iout", b"Jout" + head[4:], head[:6] + b"\x63" + head[7:], head):
        with pytest.raises((ValueError, struct.error)):
            S.decode_roi(bad)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-16-be"), min_size=1, max_size=12).filter(lambda t: all(ord(c) < 0x10000 for c in t)), st.sampled_from(["polygon", "freehand", "traced", "polyline", "point"]), st.lists(st.tuples(st.integers(-2000, 2000), st.integers(-2000, 2000)), min_size=1, max_size=30), st.booleans())
def test_round_trip(name, kind, points, fractions):
    xs, ys = ([v[k] + (0.25 if fractions else 0.0) for v in points] for k in (0, 1))
    got = S.decode_roi(S.encode_roi(name, kind, xs, ys, 3))
    assert (got["name"], got["kind"], got["xs"], got["ys"], got["position"]) == (name, kind, xs, ys, 3)
    assert got["left"] <= min(xs) and got["right"] >= max(xs) and got["top"] <= min(ys) and got["bottom"] >= max(ys)


def test_archives_are_a_table(spark, tmp_path):
    rows = [("a", 0, "one", "polygon", [0.0, 4.0, 4.0], [0.0, 0.0, 4.0]), ("a", 1, "one", "freehand", [1.5, 2.0, 3.0], [1.0, 2.0, 9.0]), ("b", 0, "é漢", "rectangle", [2.0, 6.0], [3.0, 5.0])]
    df = spark.createDataFrame(rows, "archive string, number int, name string, kind string, xs array<double>, ys array<double>")
    for r in S.archives(df.repartition(3)).collect():
        (tmp_path / f"{r.archive}.zip").write_bytes(r.content)
    (tmp_path / "single.roi").write_bytes(S.encode_roi("alone", "line", [1.0, 2.0], [3.0, 4.0]))
    (tmp_path / "broken.zip").write_bytes(b"no archive")
    with zipfile.ZipFile(tmp_path / "part.zip", "w") as z:
        z.writestr("x.roi", b"Iout")
        z.writestr("notes.txt", "no region")
    (tmp_path / "other.tif").write_bytes(b"II")
    got = {(r.archive, r.number): r for r in S.read_rois(spark, str(tmp_path)).collect()}
    assert set(got) == {("a", 0), ("a", 1), ("b", 0), ("single", 0), ("broken", None), ("part", 0)}
    assert [(got[k].name, got[k].kind, got[k].xs, got[k].ys) for k in [("a", 0), ("a", 1)]] == [r[2:] for r in rows[:2]]
    assert got["b", 0].name == "é漢" and got["b", 0].xs == [2.0, 6.0, 6.0, 2.0] and got["single", 0].ys == [3.0, 4.0]
    assert got["broken", None].error and got["part", 0].error and all(got[k].error is None for k in [("a", 0), ("a", 1), ("b", 0), ("single", 0)])


def test_repeated_names_stay_apart():
    data = S.encode_archive([{"name": "n", "kind": "point", "xs": [float(k)], "ys": [0.0]} for k in range(3)])
    assert len(zipfile.ZipFile(io.BytesIO(data)).namelist()) == 3 and [r["xs"] for r in S.decode_archive("/x/a.zip", data)] == [[0.0], [1.0], [2.0]]


# ---- masks -----------------------------------------------------------------


def inside(xs, ys, y, x):
    """Whether a pixel's centre is in a polygon: an odd number of edges to its right."""
    odd = False
    for x1, y1, x2, y2 in zip(xs, ys, [*xs[1:], xs[0]], [*ys[1:], ys[0]], strict=True):
        if (y1 <= y) != (y2 <= y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x:
            odd = not odd
    return odd


def polygons(seed, n=40):
    r = np.random.default_rng(seed)
    rows = [(f"i{k % 7}", k, (r.uniform(-4, 16, m) if k % 2 else r.integers(-3, 15, m)).astype(float).tolist(), (r.uniform(-4, 16, m) if k % 3 else r.integers(-3, 15, m)).astype(float).tolist()) for k, m in enumerate(r.integers(3, 9, n))]
    return [*rows, ("i0", 90, [1.0, 2.0], [1.0, 2.0]), ("i1", 91, None, None), ("i1", 92, [1.0, None, 3.0], [1.0, 5.0, 3.0]), ("i2", 93, [1.0, float("nan"), 3.0], [1.0, 5.0, 3.0]), ("i2", 94, [0.0, 0.0, 9.0, 9.0], [2.0, 2.0, 2.0, 2.0]), ("i9", 95, [0.0, 5.0, 5.0], [0.0, 0.0, 5.0]), ("i3", 96, [-9e8, 9e8, 9e8, -9e8], [-9e8, -9e8, 9e8, 9e8])]


SIZES = [(f"i{k}", 12, 10 + k) for k in range(7)]


def tables(spark, rows):
    return spark.createDataFrame(rows, "image_id string, label int, xs array<double>, ys array<double>"), spark.createDataFrame(SIZES, "image_id string, height int, width int")


def test_filling_is_a_test_of_every_pixel(spark):
    rows = polygons(1)
    rois, sizes = tables(spark, rows)
    got = {(r.image_id, r.label, r.y, r.x) for r in R.filled(rois.union(rois.limit(3)), sizes).collect()}
    size = {k: (h, w) for k, h, w in SIZES}
    good = [r for r in rows if r[0] in size and r[2] and len(r[2]) > 2 and not any(v is None or v != v for v in r[2])]
    want = {(i, k, y, x) for i, k, xs, ys in good for y in range(size[i][0]) for x in range(size[i][1]) if inside(xs, ys, y, x)}
    assert got == want and any(k == 96 for _, k, _, _ in got)


def test_spans_without_an_image(spark):
    rois = spark.createDataFrame([("a", 1, [-2.0, 3.0, 3.0, -2.0], [-1.0, -1.0, 2.0, 2.0])], "image_id string, label int, xs array<double>, ys array<double>")
    assert sorted(map(tuple, R.spans(rois).collect())) == [("a", 1, y, -2, 2) for y in (-1, 0, 1)]


def test_corners_are_cut_and_ends_stay(spark):
    df = spark.createDataFrame([([0.0, 4.0, 8.0],), ([1.0, 5.0],), ([],)], "v array<double>")
    assert [r.c for r in df.select(R.cut_corners(F.col("v")).alias("c")).collect()] == [[0.0, 1.0, 3.0, 5.0, 7.0, 8.0], [1.0, 5.0], []]


def cut(v):
    return [v[0], *[w for a, b in zip(v, v[1:], strict=False) for w in (a * 0.75 + b * 0.25, a * 0.25 + b * 0.75)], v[-1]]


def masks(rows, radius, rounds):
    """Filled and core pixels of each image, by loops over all pixels."""
    d = [(y, x) for y in range(-radius, radius + 1) for x in range(-radius, radius + 1) if y * y + x * x <= radius * radius]
    out = {}
    for i, h, w in SIZES:
        area, core = np.zeros((h, w), bool), np.zeros((h, w), bool)
        for _, _, xs, ys in [r for r in rows if r[0] == i]:
            for _ in range(rounds):
                xs, ys = cut(xs), cut(ys)
            m = np.array([[inside(xs, ys, y, x) for x in range(w)] for y in range(h)])
            area |= m
            core |= np.array([[all(m[y + a, x + b] for a, b in d if 0 <= y + a < h and 0 <= x + b < w) for x in range(w)] for y in range(h)])
        out[i] = area, core
    return out


@pytest.mark.parametrize(("radius", "rounds"), [(1, 1), (2, 0)])
def test_levels_and_instances(spark, radius, rounds):
    r = np.random.default_rng(3)
    rows = [(f"i{k % 6}", k, *[(r.uniform(0, 12) + 5 * np.array(c)).tolist() for c in ([-1, 0.5, 1.2, 0.3], [-0.7, -1, 0.4, 1.3])]) for k in range(14)]
    rois, sizes = tables(spark, rows)
    want = masks(rows, radius, rounds)
    got = {(p.image_id, p.y, p.x): p.value for p in R.level_masks(rois, sizes, radius, rounds).collect()}
    for i, h, w in SIZES:
        core = want[i][1]
        around = I.dilate(core, radius + 1)
        level = np.where(core, 254, np.where(around, 125, 0))
        assert np.array_equal(level, [[got.get((i, y, x), 0) for x in range(w)] for y in range(h)])
    planes = sizes.withColumn("pixels", F.transform(F.sequence(F.lit(1), F.col("height") * F.col("width")), lambda v: (v % 7).cast("double")))
    found = {p.image_id: np.array(p.labels).reshape(p.height, p.width) for p in R.instance_masks(rois, planes, radius, rounds).collect()}
    assert set(found) == {i for i, _, _ in SIZES} and not found["i6"].any()
    for i, h, w in SIZES:
        area, core = want[i]
        seeds = I.label(core)
        assert np.array_equal(found[i][core], seeds[core]) and not found[i][~area].any()
        assert np.array_equal(found[i], I.watershed((np.arange(1, h * w + 1) % 7).astype(float).reshape(h, w), seeds, area))
