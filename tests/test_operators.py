import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoframe import schemas
from cytoframe.functions import imaging as I
from cytoframe.functions import identity as ID
from cytoframe.operators import aggregates as A
from cytoframe.operators import batching as B
from cytoframe.operators import export as X
from cytoframe.operators import filtering as FL
from cytoframe.operators import joins as J
from cytoframe.operators import labels as L
from cytoframe.operators import pixels as P
from cytoframe.operators import segmentation as S
from cytoframe.operators import tracking as T
from cytoframe.plans import rules as R
from cytoframe.sources import tables


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_rules_with_reasons(spark):
    c = spark.createDataFrame([("a", 1, True, 150, 3.0, False), ("a", 2, True, 20, 3.0, False), ("a", 3, False, 150, 3.0, False)], "image_id string, label int, included boolean, area_px int, aspect_ratio double, touching_edge boolean")
    f = FL.filter_cells(c, {"rules": {"area_px": {"min": 100, "max": 500}, "aspect_ratio": {"min": 2}, "touching_edge": False}})
    assert rows(f.select("included", "filter_reasons"), "label") == [(True, ""), (False, "area_px:below_min"), (False, "segmenter_excluded")]
    assert rows(FL.filter_summary(f)) == [(3, 1, 2)]
    g = spark.createDataFrame([("x", None), ("7", float("nan")), ("5", float("inf"))], "a string, b double")
    f = FL.filter_cells(g, {"a": {"min": 6}, "b": {"max": 1}, "gone": 1}, False)
    assert [r.filter_reasons for r in f.collect()] == ["a:not_numeric;b:not_finite;gone:missing", "b:not_finite;gone:missing", "a:below_min;b:not_finite;gone:missing"]


def test_predicates_agree_with_reasons(spark):
    g = spark.createDataFrame([("x", None, True), ("7", float("nan"), True), ("5", float("inf"), True), ("7", 0.5, True), ("7", 0.5, False), (None, 1.0, None), ("8", -float("inf"), True)], "a string, b double, included boolean")
    for config in ({"a": {"min": 6}, "b": {"max": 1}}, {"a": {"max": 7}}, {"b": {"min": 0}}, {"b": {}}, {"a": "7", "included": True}, {"gone": {"min": 1}}, {}):
        want = FL.filter_cells(g, config).where("filter_passed").drop("filter_passed", "filter_reasons", "included")
        assert sorted(map(str, want.collect())) == sorted(map(str, FL.keep_passing(g, config).drop("included").collect())), config


def test_predicates_reach_the_scan(spark):
    t = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").withColumn("area_px", F.col("l_quantity"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = FL.keep_passing(t, {"area_min": 10, "l_linestatus": "O"})._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity,10.0)" in plan and "EqualTo(l_linestatus,O)" in plan


@pytest.mark.parametrize("payload", [{"rules": {"area_px": {"min": 60, "max": 300}, "length_um": {"min": 1}}}, {"area_min": 60, "area_max": 300, "length_um_min": 1}, {"area": {"min": 60, "max": 300}, "length": {"min": 1}}])
def test_rules_in_three_spellings_are_scaled_alike(payload):
    before = json.dumps(payload)
    assert R.scaled(R.normalized(payload), 2) == {"area_px": {"min": 240, "max": 1200}, "length_um": {"min": 1}}
    assert json.dumps(payload) == before
    with pytest.raises(ValueError):
        R.scaled(R.normalized({"area_px": 100}), 2)


def test_area_rules_hold_at_every_calibration(spark):
    for s in (0.5, 1, 2.5):
        c = spark.createDataFrame([(30.0 * s * s,), (100.0 * s * s,), (400.0 * s * s,)], "area_px double")
        assert [r.included for r in FL.filter_cells(c, {"area_min": 60, "area_max": 300}, True, s).collect()] == [False, True, False]


def test_nan_passes_morphology_bounds(spark):
    f = spark.createDataFrame([(1, float("nan")), (2, 5.0), (3, None), (4, 1.0)], "i int, solidity double")
    assert [r.i for r in FL.morphology_filter(f, solidity_max=3.0).collect()] == [1, 3, 4]


def test_classifier_filter(spark):
    c = spark.createDataFrame([("a", 0.9, "cell"), ("b", 0.1, "non_cell"), ("c", None, "cell"), ("d", 0.9, "non_cell")], "Cell_ID string, p_cell double, predicted_class string")
    assert [r.Cell_ID for r in FL.filter_classified(c, 0.5).collect()] == ["a"]
    assert FL.filter_classified(c.drop("p_cell"), 0.5).count() == 0


def test_crops_classes_and_labels(spark):
    cells = spark.createDataFrame([("i", 1, "old", 5.0, "x_0101_s01.tif"), ("i", 2, "old", 6.0, "y")], "image_id string, label long, Cell_ID string, area_px double, source_path string")
    crops = spark.createDataFrame([("i", 1, "sc_pass", 9.0), ("i", 2, "sc_fail", 9.0)], "image_id string, label int, Cell_ID string, area_px double")
    classes = spark.createDataFrame([("sc_pass", 0.9, "cell", 1.0), ("sc_fail", 0.1, "non_cell", 2.0)], "Cell_ID string, p_cell double, predicted_class string, area_px double")
    registry = spark.createDataFrame([("0101_s01", "INH"), ("0102_s01", "RIF")], schemas.PADMAP)
    out = J.finalize(cells, crops, classes, registry)
    assert rows(out.select("Cell_ID", "area_px", "area_px_crop", "area_px_unet", "drug")) == [("sc_pass", 5.0, 9.0, 1.0, "INH")]
    keyed = L.with_key(cells, "source_path")
    assert rows(L.match_report(keyed, registry)) == [(2, 1, 1, 50.0, 1, 0)]
    assert {r.drug for r in L.apply_registry(keyed, registry, "outer").collect()} == {"INH", "RIF", "UNK"}


def test_keys_hold_whole_numbers(spark):
    cells = spark.createDataFrame([("/in/12345_s01.tif",), ("/in/2345_s01.tif",), ("x_0101_s101_m2.tif",), ("t7_rep2_s03",), ("345_s01",)], "source_path string")
    registry = spark.createDataFrame([("12345_s01", "A"), ("2345_s01", "B"), ("0101_s10", "C"), ("0101_s101", "D"), ("t7_rep2_s03", "E")], schemas.PADMAP)
    got = L.apply_registry(L.with_key(cells, "source_path"), registry)
    assert {r.source_path: r.drug for r in got.collect()} == {"/in/12345_s01.tif": "A", "/in/2345_s01.tif": "B", "x_0101_s101_m2.tif": "D", "t7_rep2_s03": "E", "345_s01": "UNK"}


def test_sessions_read_documents_once(spark, tmp_path):
    cell = lambda label, included=True, central=False: {"label": label, "included": included, "is_central": central}
    docs = [("a", 2, [cell(1), cell(2), cell(2, False)]), ("b", None, [cell(1), cell(3, False, True), cell(3), cell(4, True, True)]), ("c", None, [cell(1)]), ("d", 1, [cell(1)]), ("e", 1, []), ("f", 1, None)]
    spark.createDataFrame([{"image_id": i, "source_path": i, "central_label": k, "cells": c} for i, k, c in docs], schemas.METADATA).write.parquet(str(tmp_path / "d"))
    d, ids = spark.read.parquet(str(tmp_path / "d")), spark.createDataFrame([(i,) for i in "aabcef"], "image_id string")
    notes = spark.createDataFrame([("b", {}, {"3": "include", "1": "exclude"})], "image_id string, notes map<string,string>, overrides map<string,string>")
    got = J.session_cells(d, notes, ids, ids, True, True)
    assert rows(got.select("image_id", "label", "override"), "image_id", "label") == [("a", 2, None), ("b", 3, "include"), ("b", 3, "include")]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    assert J.session_cells(d, notes, ids, ids, False, False).count() == 8
    kept = J.masks_with_images(ids.distinct(), d, ids.distinct())
    assert rows(kept.groupBy("image_id").count(), "image_id") == [("a", 2), ("b", 3), ("c", 1)]
    # What is not included goes before documents are joined: the filter lies below both joins.
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Join") < plan.index("filter(cells")


def test_masked_images_build_documents_once(spark):
    from cytoframe import catalog

    plan = catalog.queries()["masked_images"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1


def test_numbers_within_each_drug(spark):
    c = spark.createDataFrame([(f"f{i % 5}", i, "A" if i % 3 else "UNK" if i % 2 else None, f"h{i}") for i in range(60)], "source_filename string, label int, drug string, Cell_ID string")
    got = {(r.source_filename, r.label): r.Cell_ID for r in L.numbered_ids(c).collect()}
    known = sorted((r.source_filename, r.label) for r in c.where("drug = 'A'").collect())
    assert [got[k] for k in known] == [f"sc_A_{i + 1}" for i in range(len(known))]
    assert all(got[(r.source_filename, r.label)] == r.Cell_ID for r in c.where("drug is null or drug = 'UNK'").collect()) and len(got) == 60


def test_merge_and_union(spark):
    old = spark.createDataFrame([("a", "f", 1.0)], schemas.FEATURES_LONG)
    new = spark.createDataFrame([("a", "f", 2.0), ("b", "g", 3.0)], schemas.FEATURES_LONG)
    assert rows(J.merge_existing(old, new), "cell_id") == [("a", "f", 1.0), ("b", "g", 3.0)]
    assert rows(J.duplicates(old, new)) == [("a",)]
    with pytest.raises(ValueError):
        tables.union_shards([])


def test_lookup(spark):
    c = spark.createDataFrame([("/d/060225_0101_s3_m12.tif", 4, 1, 2, 3, 4)], "source_path string, mask_label int, bbox_min_row int, bbox_min_col int, bbox_max_row int, bbox_max_col int")
    t = J.add_cells(spark.createDataFrame([], schemas.LOOKUP), J.lookup_rows(c))
    r = t.first()
    assert J.has_cell(t, r.cell_id) and J.has_cell(t, r.hash) and not J.has_cell(t, "no")
    assert J.cells_of(t, "0101", "3").count() == 1 and set(t.columns) == set(schemas.LOOKUP.names)


def test_batches_and_shards(spark):
    images = spark.createDataFrame([(f"/x/{d}/i{i:02d}.tif",) for d in "ab" for i in range(5)], "path string")
    m = {r.source_path: (r.batch, r.link_path) for r in B.round_robin(images, 5).collect()}
    assert m["/x/a/i00.tif"] == ("batch1", "batch1/i00.tif") and m["/x/b/i00.tif"][0] == "batch1" and m["/x/b/i00.tif"][1].startswith("batch1/i00_")
    skip = spark.createDataFrame([("i01",), ("i02.tif",), ("/x/a/i03.tif",)], "token string")
    kept = B.round_robin(images, 5, skip=skip)
    assert kept.count() == 5 and {r.source_path: r.batch for r in kept.collect()}["/x/b/i03.tif"] == m["/x/b/i03.tif"][0]
    assert B.manifest_is_current(B.round_robin(images, 5), images.withColumnRenamed("path", "source_path"))
    assert [B.parse_shard("1/4"), B.stride_shard(images, "1/4", "path").count()] == [(1, 4), 3]
    for bad in ("4/4", "x", "-1/2"):
        with pytest.raises(ValueError):
            B.parse_shard(bad)
    sizes = [r["count"] for r in B.contiguous_chunks(images, 3, "path").groupBy("chunk").count().orderBy("chunk").collect()]
    assert sizes == [4, 3, 3]
    numbered = B.ranked(images.repartition(7), "path").orderBy("i").collect()
    assert [r.i for r in numbered] == list(range(10)) and [r.path for r in numbered] == sorted(r.path for r in numbered)
    e = B.expected_minus_done(spark.createDataFrame([("b", "img_a"), ("b", "img_b")], "batch string, image_id string"), spark.createDataFrame([("img_a",)], "image_id string"), spark.createDataFrame([("img_b", "boom")], "image_id string, error string"))
    assert rows(e) == [("b", "img_b", "boom")]


def test_skip_list_file(spark, tmp_path):
    folder = tmp_path / "skip"
    folder.mkdir()
    (folder / "s.txt").write_text("# header\n\nimage_a\nimage_b  # inline\n# trailing\n")
    assert sorted(r.token for r in tables.read_skip_list(spark, str(folder)).collect()) == ["image_a", "image_b"]
    new = spark.createDataFrame([("image_a",), ("c",), ("",)], "token string")
    assert tables.append_skip_list(spark, str(folder), new, "added") == ["c"] and tables.append_skip_list(spark, str(folder), new) == []


def test_metadata_documents(spark, tmp_path):
    doc = {"image_id": "img_a", "source_path": "/i/img_a.tif", "cells": [{"label": 5, "included": True, "bbox": [10, 20, 30, 40], "centroid": [50.5, 60.25], "failure_reasons": ["bad_shape", "edge"], "metrics": {"area": 123.0, "intensity": {"Phase": 1.0, "AF405": 2.0}}, "is_central": True}]}
    (tmp_path / "img_a_meta.json").write_text(json.dumps(doc))
    flat = tables.flatten_cells(tables.read_metadata(spark, str(tmp_path)))
    r = tables.with_intensity_columns(flat, ["Phase", "AF405"]).first()
    assert (r.cell_id, r.bbox_x1, r.bbox_y2, r.centroid_y, r.centroid_x, r.area, r.failure_reasons, r.intensity_Phase, r.intensity_AF405) == ("img_a_5", 10, 40, 50.5, 60.25, 123.0, "bad_shape; edge", 1.0, 2.0)
    notes = spark.createDataFrame([("img_a", json.dumps({"cell_notes": {"5": " hi "}, "cell_overrides": {"5": "Exclude", "6": "maybe"}}))], "image_id string, json string")
    a = FL.apply_annotations(flat, tables.annotation_maps(notes)).first()
    assert (a.included, a.override, a.note) == (False, "exclude", "hi")
    back = tables.metadata_documents(flat).first()
    assert (back.n_cells_total, back.n_cells_filtered, back.cells[0].label) == (1, 1, 5)


def test_summary_and_matrix(spark):
    wide = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, float("nan"))], "Cell_ID string, f double, g double")
    long = X.features_long(wide, ["f", "g", "none"])
    r = {x.feature: x for x in A.feature_summary(long).collect()}
    assert (r["f"].mean, r["f"].n_valid, r["g"].n_valid, r["g"].pct_missing, r["f"].q50) == (2.0, 2, 1, 50.0, 2.0)
    m = A.wide_matrix(long)
    assert m.columns == ["feature", "a", "b"] and rows(m) == [("f", 1.0, 3.0), ("g", 2.0, None)]
    with pytest.raises(ValueError):
        A.wide_matrix(long, most=1)


def test_exports(spark, tmp_path):
    c = ID.ensure_ids(spark.createDataFrame([("/d/060225_0101_s3_m12_Phase.tif", 4, 1, 2, 3, 4, 9.0)], "source_path string, label int, bbox_min_row int, bbox_min_col int, bbox_max_row int, bbox_max_col int, area_px double"), bbox=schemas.BBOX)
    X.write_all(c, ["area_px"], str(tmp_path), "r", wide=True)
    assert spark.read.parquet(f"{tmp_path}/features").count() == 1 and spark.read.parquet(f"{tmp_path}/puncta").count() == 0
    m = spark.read.csv(f"{tmp_path}/mapping", header=True).first()
    assert (m.plate, m.scene, m.position, m.drug, m.segmentation_run_hash) == ("0101", "3", "12", "UNK", "r") and len(m) == 18
    assert spark.read.csv(f"{tmp_path}/diagnostics", header=True).columns == list(schemas.DIAGNOSTICS)


@pytest.fixture(scope="module")
def picture(spark):
    r = np.random.default_rng(5)
    img = I.gaussian(r.normal(size=(24, 30)), 1.5)
    mask = I.label(img > 0.05)
    px = spark.createDataFrame([("p", y, x, float(img[y, x])) for y in range(24) for x in range(30)], "image_id string, y int, x int, value double")
    mp = spark.createDataFrame([("p", int(mask[y, x]), int(y), int(x)) for y, x in np.argwhere(mask)], schemas.MASK_PIXELS)
    return img, mask, px, mp


def test_relational_images_agree_with_kernels(spark, picture):
    img, mask, px, mp = picture
    own = mp.groupBy("image_id").agg(F.count("*")).first()
    assert own[1] == (mask > 0).sum()

    def plane(df):
        out = np.zeros(mask.shape, bool)
        for r in df.select("y", "x").collect():
            out[r.y, r.x] = True
        return out

    whole = mp.withColumn("label", F.lit(1))
    assert (plane(P.dilate(whole, 2, height=24, width=30)) == I.dilate(mask > 0, 2)).all()
    assert (plane(P.erode(whole, 2)) == I.erode(mask > 0, 2)).all()
    m, s = I.box_means(img, 5)
    for r in P.box_stats(px, 24, 30, 5).collect():
        assert r.local_mean == pytest.approx(m[r.y, r.x]) and r.local_std == pytest.approx(s[r.y, r.x], abs=1e-6)
    assert (plane(P.sauvola_mask(px, 24, 30, 5)) == I.mask_sauvola(img, 5)).all()
    t = P.isodata_thresholds(px).first().threshold
    assert abs(t - I.isodata(img)) < np.ptp(img) / 64
    for r in P.region_properties(mp).collect():
        f = S.morphology(mask == r.label)
        assert (r.area, r.bbox_min_row, r.bbox_max_col) == (f["area_px"], f["bbox_min_row"], f["bbox_max_col"])
        assert r.major_axis == pytest.approx(f["major_axis_px"]) and r.orientation == pytest.approx(f["orientation"], abs=1e-6) and r.eccentricity == pytest.approx(f["eccentricity"], abs=1e-6)
    hu = {r.label: r for r in P.hu_moments(mp).collect()}
    f = S.morphology(mask == 1)
    assert [hu[1][f"hu_moment_{i}"] for i in range(7)] == pytest.approx([f[f"hu_moment_{i}"] for i in range(7)], abs=1e-9)
    panel = {r.label: r for r in P.intensity_panel(mp, px.withColumn("channel", F.lit("c"))).collect()}
    largest = int(np.bincount(mask.ravel())[1:].argmax()) + 1
    want = S.intensity(img[mask == largest], "c")
    for k in schemas.INTENSITY:
        assert panel[largest][k] == pytest.approx(want[f"intensity_c_{k}"], rel=1e-6, abs=1e-6), k
    assert (plane(P.unfold_masks(P.fold(mp.withColumnRenamed("label", "v"), 24, 30, ("image_id",), "v").withColumnRenamed("pixels", "labels"))) == (mask > 0)).all()


def test_isodata_stops_where_the_threshold_stays(spark):
    import time

    values = [((i * 37) % 251) ** 1.5 + (900 if i % 3 else 0) for i in range(1200)]
    px = spark.createDataFrame([("a", i // 40, i % 40, v) for i, v in enumerate(values)], "image_id string, y int, x int, value double").coalesce(1)
    lo, w = min(values), (max(values) - min(values)) / 256
    places = [lo + (min(int((v - lo) // w), 255) + 0.5) * w for v in values]
    t = sum(places) / len(places)
    for _ in range(100):
        low, high = [c for c in places if c <= t], [c for c in places if c > t]
        t = (sum(low) / len(low) + sum(high) / len(high)) / 2
    began = time.perf_counter()
    assert P.isodata_thresholds(px, rounds=400_000).first().threshold == pytest.approx(t, rel=1e-9)
    assert time.perf_counter() - began < 30  # passes over 256 bins in every one of these rounds would take minutes


def test_tiles_cover_and_come_back(picture):
    img, _, px, _ = picture
    assert P.tile_origins(24, 10, 2) == [0, 6, 12, 14] and P.tile_origins(5, 10, 2) == [0]
    back = {(r.y, r.x): r.value for r in P.untile(P.tiles(px, 24, 30, 10, 2)).collect()}
    assert len(back) == img.size and all(v == pytest.approx(img[k]) for k, v in back.items())


def _movie(spark):
    frames = []
    for t in range(4):
        m = np.zeros((30, 40), int)
        m[4:14, 3 + t : 15 + t] = 1
        if t < 2:
            m[18:28, 5:35] = 2
        else:
            m[18:28, 5:19] = 2
            m[18:28, 21:35] = 3
        frames += [(t, int(m[y, x]), int(y), int(x)) for y, x in np.argwhere(m)]
    return spark.createDataFrame(frames, "t int, label int, y int, x int")


def test_tracking(spark):
    mask = _movie(spark)
    cells = mask.groupBy("t", "label").agg(F.count("*").alias("area")).withColumns({"cell_id": T.cell_name(F.col("t"), F.col("label")), "touching_edge": F.lit(False)})
    links = T.overlap_links(T.frame_overlaps(mask), cells)
    assert {tuple(r) for r in links.collect()} == {("0_1", "1_1"), ("1_1", "2_1"), ("2_1", "3_1"), ("0_2", "1_2"), ("1_2", "2_2"), ("1_2", "2_3"), ("2_2", "3_2"), ("2_3", "3_3")}
    names = {r.cell_id: r.lineage for r in T.lineages(cells.select("t", "cell_id"), links).collect()}
    assert names["3_1"] == "1" and names["1_2"] == "2" and names["3_2"] == "2.1" and names["3_3"] == "2.2"
    assert rows(T.relatives(links, "3_3", 3), "generation") == [(1, "2_3"), (2, "1_2"), (3, "0_2")]
    assert {r.cell_id for r in T.forward_exhaustive(links, "0_2", 1, 2).collect()} == {"1_2", "2_2", "2_3", "3_2", "3_3"}
    family = {r.cell_id: r for r in T.with_family(cells, links).collect()}
    assert family["1_2"].daughters == ["2_2", "2_3"] and family["0_1"].n_mother == 0
    again, _ = T.track(mask)
    assert again.count() == mask.count()


def test_lineages_read_links_once_and_broadcast_none(spark, tmp_path, monkeypatch):
    spark.range(1, 400).selectExpr("cast(id as string) daughter", "cast(floor(id / 3) as string) mother").write.parquet(str(tmp_path / "links"))
    links, cells = spark.read.parquet(str(tmp_path / "links")), spark.range(400).selectExpr("0 t", "cast(id as string) cell_id")
    plans, real = [], T.checkpointed

    def kept(df):
        out = real(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
        return out

    monkeypatch.setattr(T, "checkpointed", kept)
    names = {r.cell_id: r.lineage for r in T.lineages(cells, links).collect()}
    assert len(names) == 400 and names["0"] == "1" and names["1"] == "1.1" and names["5"] == "1.1.3" and names["399"].count(".") == 5
    # The one broadcast is that of where the founders' ranges start, a number for each partition.
    assert sum("FileScan" in p for p in plans) == 1 and [("_start" in p) for p in plans if "BroadcastHashJoin" in p] == [True]


def test_assignment_takes_each_cell_once(spark):
    mask = _movie(spark)
    shape = P.region_properties(mask, ("t", "label")).withColumns({"cell_id": T.cell_name(F.col("t"), F.col("label")), "features": F.array("major_axis", "minor_axis", F.col("area").cast("double")), "area": F.col("area").cast("double")})
    got = {(r.a, r.b): r.rule for r in T.assign(T.transition_features(shape, T.frame_overlaps(mask))).collect()}
    assert got[("0_1", "1_1")] == "one" and got[("1_2", "2_2")] == "split" and got[("1_2", "2_3")] == "split" and got[("2_3", "3_3")] == "one"


def test_split_and_drift(spark):
    labels = np.zeros((10, 20), int)
    labels[2:8, 2:18] = 1
    seeds = np.zeros((10, 20), int)
    seeds[4, 4], seeds[4, 15] = 1, 2
    images = spark.createDataFrame([(0, 10, 20, labels.ravel().tolist()), (1, 10, 20, labels.ravel().tolist())], "t int, height int, width int, labels array<int>")
    cut = T.split_cells(images, spark.createDataFrame([(0, 1, seeds.ravel().tolist())], "t int, label int, seeds array<int>"))
    assert {r.t: len(set(r.labels)) for r in cut.collect()} == {0: 3, 1: 2}
    s = spark.createDataFrame([("a", 1, 1.5, -2.0), ("a", 2, 1.0, -1.0)], "position string, t int, dy double, dx double")
    assert rows(T.common_area(T.drift_series(s), 30, 40)) == [("a", 3, 30, 0, 37)]


def test_features_crops_and_classes(spark):
    y, x = np.mgrid[:60, :80]
    m = np.zeros((60, 80), int)
    m[(np.abs(y - 20) <= 6) & (np.abs(x - 35) <= 20)] = 1
    m[45:57, 60:72] = 2
    phase, af = 100.0 - 50 * (m > 0), 10 + 5.0 * (m == 1) * (x > 35)
    images = spark.createDataFrame([("a", 60, 80, m.ravel().tolist(), {"Phase": phase.ravel().tolist(), "AF405": af.ravel().tolist(), "Bod493": af.ravel().tolist()})], "image_id string, height int, width int, labels array<int>, planes map<string,array<double>>")
    f = S.extract_features(images, 0.1)
    t = {r.label: r for r in S.feature_table(f, ["Phase", "AF405", "Bod493"]).collect()}
    assert len(t[1]) == 178 and t[1].area_px == 13 * 41 and t[1].intensity_Phase_mean == 50 and t[1].area_um2 == pytest.approx(13 * 41 * 0.01)
    assert t[1].AF405_state_code in (1.0, 2.0) and t[1].AF405_bg_mean == pytest.approx(10) and t[1].AF405_mean_bgsub == pytest.approx(5 * 20 / 41) and t[1].width_q3_px > 10 and t[1].length_um == pytest.approx(4.1, abs=0.3)
    with_id = f.withColumn("cell_id", F.concat_ws("_", "image_id", F.col("label").cast("string")))
    p = S.profile_rows(with_id)
    assert p.columns == schemas.PROFILES.names and {r.n_points for r in p.collect()} == {100}
    assert S.puncta_rows(with_id).columns[:3] == ["cell_id", "channel", "punctum_id"]
    cells = P.region_properties(P.unfold_masks(images)).withColumn("Cell_ID", F.concat(F.lit("c"), F.col("label")))
    c = S.crops(images, cells, 30, 4)
    r = {x.Cell_ID: x for x in c.collect()}
    assert r["c1"].side == 49 and r["c2"].side == 30 and len(r["c2"].stack) == 4 and set(r["c2"].stack[-1]) == {0, 2} and r["c1"].channels.endswith(";Mask")

    def scorer(planes):
        out = np.zeros((3, *planes.shape[1:]))
        out[1] = 4 * (planes[0] < 0.5)
        return out

    k = {x.Cell_ID: x for x in S.classify_crops(c, scorer).collect()}
    assert k["c1"].predicted_class == "cell" and k["c1"].predicted_cell and k["c1"].error is None
    bad = S.classify_crops(c, lambda planes: (_ for _ in ()).throw(ValueError("no"))).first()
    assert bad.error == "ValueError: no" and bad.p_cell is None


def test_random_forest(spark):
    d = spark.createDataFrame([(float(i), float("nan") if i % 7 == 0 else float(i % 3), float(i >= 50)) for i in range(100)], "a double, b double, y double")
    model = A.random_forest(d, ["a", "b"], "y", 10, scale=True)
    out = A.forest_predict(model, d, ["a", "b"], True)
    assert out.where("prediction = y").count() > 95 and len(out.first().probability) == 2


def test_siblings(spark):
    files = spark.createDataFrame([(f"/d/{n}",) for n in ("a_Phase.tif", "a_AF405.tif", "a_Bod493.tif", "a_mask.tif", "b_Cy5.tif", "c_Phase.tif", "c_OG514.tif")], "path string")
    s = J.siblings(files, ["AF405", "Bod493", "Cy5", "Phase"])
    assert {(r.base, r.channel) for r in s.collect()} == {("a", "Phase"), ("a", "AF405"), ("a", "Bod493"), ("c", "Phase"), ("c", "OG514")}
    images = spark.createDataFrame([("a", "/d", "a")], "image_id string, dir string, base string")
    got = rows(J.channel_paths(images, s, ["Bod493", "Cy5"]).orderBy("rank", "channel").select("channel", "path"))
    assert got == [("Phase", "/d/a_Phase.tif"), ("Bod493", "/d/a_Bod493.tif"), ("Cy5", None), ("AF405", "/d/a_AF405.tif")]


@pytest.mark.parametrize("keys", [["k"], []])
def test_percentiles_are_exact(spark, keys):
    r = np.random.default_rng(8)
    rows_ = [("a", float(v)) for v in r.integers(0, 9, 501)] + [("b", float(v)) for v in r.normal(size=300)] + [("c", 4.0), ("c", None), ("d", None)]
    d = spark.createDataFrame(rows_, "k string, v double").repartition(5)
    got = {(tuple(x)[:-1] or ("",))[0]: x.q for x in A.percentiles(d, keys, "v", [0.0, 0.05, 0.5, 0.77, 1.0]).collect()}
    for k in ("a", "b", "c") if keys else ("",):
        own = [v for g, v in rows_ if v is not None and (not keys or g == k)]
        np.testing.assert_allclose(got[k], np.percentile(own, [0, 5, 50, 77, 100]), atol=1e-9)
    assert "d" not in got
