import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoframe.functions import imaging as I
from cytoframe.operators import stacks as K


def test_axes_and_slices(spark):
    p = spark.createDataFrame([("a", i, 2, 2, [float(i)] * 4) for i in range(12)], "image_id string, page int, height int, width int, pixels array<double>")
    t = K.with_axes(p, "TZC", {"T": 2, "Z": 3, "C": 2}, ["Phase", "Cy5"])
    one = K.slices(t, t=1, z=2, channel="Cy5").first()
    assert one.page == 11 and K.slices(t, t=0, z=0).count() == 2
    m = K.by_channel(t, "image_id", "t", "z").where("t = 1 and z = 2").first()
    assert m.planes == {"Phase": [10.0] * 4, "Cy5": [11.0] * 4}
    assert K.same_shapes(p, "image_id").first().same
    s = p.select(K.pixel_size(F.lit("ImageJ=1\ndCalibration = 0.1"), 0.5).alias("a"), K.pixel_size(F.lit("none"), 0.5).alias("b")).first()
    assert (s.a, s.b) == (0.1, 0.5)


def test_particles_and_pixel_features(spark):
    px = spark.createDataFrame([("a", y, x, float(10 * y + x)) for y in range(6) for x in range(6)], "image_id string, y int, x int, value double")
    box = spark.createDataFrame([("a", 3, 1, 2, 3, 5)], "image_id string, label int, bbox_min_row int, bbox_min_col int, bbox_max_row int, bbox_max_col int")
    got = {(r.y, r.x): r.value for r in K.particle_pixels(px, box).collect()}
    assert got == {(y, x): 10.0 * (y + 1) + x + 2 for y in range(2) for x in range(3)}
    planes = spark.createDataFrame([("a", 6, 6, [float(i) for i in range(36)])], "image_id string, height int, width int, pixels array<double>")
    f = K.pixel_features(planes)
    assert f.count() == 36 and f.where("y = 2 and x = 3").first().features["raw"] == 15.0


def test_training_set(spark):
    meta = spark.createDataFrame([("a", "pass"), ("b", "FAIL"), ("c", "discarded"), ("d", "pass")], "image_id string, status string")
    masks = spark.createDataFrame([("a",), ("b",), ("c",)], "image_id string")
    images = spark.createDataFrame([(i, f"/{i}") for i in "abcd"], "image_id string, path string")
    s = K.training_samples(meta, masks, images)
    assert {(r.image_id, r["class"]) for r in s.collect()} == {("a", 1), ("b", 2)}
    full = s.join(spark.createDataFrame([("a", 3, 5, [0, 1] * 7 + [0], {"Phase": [float(i) for i in range(15)]}), ("b", 3, 5, [1] * 15, {"Phase": [0.0] * 15})], "image_id string, height int, width int, labels array<int>, planes map<string,array<double>>"), "image_id")
    t = {r.image_id: r for r in K.training_tensors(full, ["Phase", "Cy5"], 4).collect()}
    assert t["a"].shape == [4, 8] and len(t["a"].image) == 64 and set(t["b"].target) == {0, 2} and max(t["a"].image) == 1.0
    a = K.training_tensors(full, ["Phase"], 4, seed=1).orderBy("image_id").collect()
    assert a == K.training_tensors(full, ["Phase"], 4, seed=1).orderBy("image_id").collect()


def test_kernels_of_meshes_and_scores():
    line = np.stack([np.full(11, 10.0), np.linspace(5, 25, 11)], axis=1)
    img = np.arange(30 * 40, dtype=float).reshape(30, 40)
    s = I.straighten(img, line, np.full(11, 6.0), 7)
    assert s.shape == (11, 7) and s[:, 3] == pytest.approx(I.bilinear(img, line[:, 0], line[:, 1]))
    assert len(I.merge_points(np.array([[0, 0], [0, 1], [0, 2], [9, 9]], float), 1)) == 2
    target = np.zeros((4, 4), int)
    target[:2] = 1
    sure = np.stack([(target == k) * 20.0 for k in range(3)])
    assert I.dice_loss(sure, target) < 0.01 and I.focal_loss(sure, target) < 1e-6 and I.focal_loss(-sure, target, 0) > 1
    assert I.pad_together([np.ones((1, 2, 3)), np.ones((1, 4, 1))]).shape == (2, 1, 4, 3)
    core = np.zeros((20, 20))
    core[4:9, 4:9] = core[12:17, 12:17] = 1
    assert I.seeds_from_scores(core, 1 - core).max() == 2
    d = I.border_distance(np.pad(np.ones((9, 9), int), 2), 0, 3)
    assert d.max() == 3 and d[2, 2] == 1
