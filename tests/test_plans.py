import numpy as np
import pytest

from cytoframe.plans import calibration as C
from cytoframe.plans import config, pipeline, sweep
from cytoframe.sources import tables, tiff


def test_calibration():
    s = C.spatial_scale(0.0645, 0.10317)
    assert C.scaled_integer(96, s) == 154 and C.scaled_integer(80, C.spatial_scale(0.0645, 0.103) ** 2) == 204
    for value, factor, minimum, odd, want in ((5, 0.5, 0, False, 3), (0, 2, 0, False, 0), (1, 0.01, 1, False, 1), (9, 0.01, 3, True, 3), (9, 2, 3, True, 19), (9, 1.6, 3, True, 15)):
        assert C.scaled_integer(value, factor, minimum, odd) == want
    for bad in (0, -1, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            C.spatial_scale(bad)
    assert C.scaled_settings({"a": {"crop_size": 10, "area_min": 10, "x": 3}}, 2) == {"a": {"crop_size": 20, "area_min": 40, "x": 3}}


def test_config_and_plan():
    run = config.load("inputs:\n  n_batches: 2\n  image_dir: $HERE/x\nclassifier: {enabled: true, shards: 3}\n", {"HERE": "/tmp"})
    assert run.inputs.image_dir == "/tmp/x"
    assert config.plan(run) == ["setup", "segment:1", "segment:2", "compile", "filter", "crop", "classify:0/3", "classify:1/3", "classify:2/3", "final", "metadata"]
    assert run.run_hash() == config.load('{"inputs": {"n_batches": 2, "image_dir": "/tmp/x"}, "classifier": {"enabled": true, "shards": 3}}').run_hash()
    with pytest.raises(ValueError, match="unknown"):
        config.load("inputs: {nope: 1}")
    with pytest.raises(ValueError, match="threshold"):
        config.load("classifier: {threshold: 2}")
    assert config.nested({"a.b": 1, "a.c.d": 2}) == {"a": {"b": 1, "c": {"d": 2}}}
    assert '"<redacted>"' in tables.run_metadata({"api_key": "x"}, [], "h")


def test_sweeps(spark):
    p = {"a": [1, 2, 3], "b": ["x", "y"]}
    assert sweep.grid(spark, p).count() == 6
    draws = [tuple(r) for r in sweep.random_draws(spark, p, 4, 1).collect()]
    assert draws == [tuple(r) for r in sweep.random_draws(spark, p, 4, 1).collect()] and len(set(draws)) == 4


def _picture(seed: int) -> np.ndarray:
    r = np.random.default_rng(seed)
    y, x = np.mgrid[:96, :128]
    img = 1000 + r.normal(0, 5, (96, 128))
    for cy, cx in ((25, 40), (60, 80)):
        img[(np.abs(y - cy) <= 5) & (np.abs(x - cx) <= 16)] = 400
    img[:6, 100:128] = 400
    return img


def test_images_to_labelled_cells(spark, tmp_path):
    for k, name in enumerate(("060225_0101_s01_m1_Phase", "060225_0101_s02_m1_Phase")):
        stack = np.stack([_picture(k), 2000 - _picture(k)]).astype(np.uint16)
        (tmp_path / f"{name}.tif").write_bytes(tiff.encode(stack))
    (tmp_path / "broken.tif").write_bytes(b"II*\0nothing")
    planes = tiff.read_planes(spark, str(tmp_path), "*.tif*")
    bad = planes.where("error is not null").collect()
    assert [r.image_id for r in bad] == ["broken"]
    from pyspark.sql import functions as F

    named = planes.where("error is null").withColumn("channel", F.when(F.col("page") == 0, "Phase").otherwise("AF405"))
    sources = tiff.list_files(spark, str(tmp_path)).select("image_id", F.col("path").alias("source_path"))
    registry = spark.createDataFrame([("0101_s01", "INH")], "padmap_id string, padmap_drug string")
    run = config.load(f"output_dir: {tmp_path}/out\nsegmentation: {{method: 1}}\nfilter: {{rules: {{area_min: 100, area_max: 1000, touching_edge: false}}}}")
    done = pipeline.run_all(spark, named, sources, run, registry)
    got = sorted((r.image_id[-12:-9], r.drug, r.area_px) for r in done.collect())
    assert [g[1] for g in got] == ["INH", "INH", "UNK", "UNK"] and all(300 < g[2] < 400 for g in got)
    ids = sorted(r.Cell_ID for r in done.collect())
    assert ids[-4:] and "sc_INH_1" in ids and "sc_INH_2" in ids
    assert spark.read.csv(f"{tmp_path}/out/metadata", header=True).count() == 4
    status = pipeline.with_status(sources, planes.groupBy("image_id").agg(F.max("error").alias("error")))
    assert {r.status: r.n for r in pipeline.status_counts(status).collect()} == {"success": 2, "failed": 1}


def test_written_files_come_back(spark, tmp_path):
    rows = [("a", 3, 4, [[float(i) for i in range(12)]], "uint16")]
    out = tiff.write_files(spark.createDataFrame(rows, "name string, height int, width int, planes array<array<double>>, dtype string"), str(tmp_path / "o")).collect()
    back = tiff.read_planes(spark, str(tmp_path / "o")).first()
    assert out[0].name == "a" and back.pixels == rows[0][3][0] and back.dtype == "uint16"
    assert tiff.read_planes(spark, str(tmp_path / "o"), header_only=True).first().pixels is None
