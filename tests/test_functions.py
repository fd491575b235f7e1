import hashlib
import itertools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoframe import schemas
from cytoframe.functions import geometry as G
from cytoframe.functions import identity as ID
from cytoframe.functions import vectors as V


def one(spark, *columns, rows=((1,),), schema="i int"):
    return spark.createDataFrame(list(rows), schema).select(*columns).first()


def test_schema_names():
    names = schemas.feature_names(["Phase", "AF405", "Bod493"])
    assert len(names) == len(set(names)) == 176 and schemas.feature_names(["AF405", "Bod493"]) == names
    assert " ".join(names[:21]) == "area_px area_um2 perimeter_px perimeter_um major_axis_px major_axis_um minor_axis_px minor_axis_um eccentricity solidity extent orientation convex_area_px filled_area_px equivalent_diameter_px equivalent_diameter_um compactness circularity rough_length_px rough_length_um aspect_ratio"
    assert " ".join(names[28:56]) == "centroid_row centroid_col bbox_min_row bbox_min_col bbox_max_row bbox_max_col mean_intensity max_intensity min_intensity length_px length_um sinuosity width_median_px width_median_um width_std_px width_std_um width_max_px width_max_um width_min_px width_min_um width_q1_px width_q1_um width_q3_px width_q3_um curvature_mean curvature_std curvature_max curvature_min"
    assert names[56] == "intensity_Phase_mean" and names[104] == "profile_Phase_mean"
    assert " ".join(names[137:157]) == "AF405_bg_mean AF405_bg_median AF405_bg_std AF405_mean_bgsub AF405_shell_mean AF405_core_mean AF405_shell_core_ratio AF405_midline_mean AF405_midline_max AF405_midline_gradient_mean AF405_midline_gradient_max AF405_midline_peak_position AF405_midline_peak_value AF405_poleA AF405_poleB AF405_center AF405_polar_asym AF405_center_enrichment AF405_peak_count AF405_state_code"
    assert " ".join(names[170:]) == "Bod493_puncta_count Bod493_puncta_total_intensity Bod493_puncta_max_intensity Bod493_puncta_mean_sigma_px Bod493_puncta_max_sigma_px Bod493_puncta_fraction"


def test_cell_hash_is_the_digest_of_name_label_and_box(spark):
    r = one(spark, ID.cell_hash(F.lit("/a/b/x_Phase.tif"), F.lit(7), [F.lit(i) for i in (1, 2, 3, 4)]).alias("h"))
    assert r.h == hashlib.sha256(b"x_Phase.tif|7|1,2,3,4").hexdigest()[:16]


@pytest.mark.parametrize(
    ("stem", "known", "phase", "want"),
    [
        ("run_2026_strain_stain_s01m01_Cy5_ORG", ["Cy5", "OG514"], "Phase", ("Cy5", "run_2026_strain_stain_s01m01")),
        ("site01_Phase PH3_ORG", ["Phase"], "Phase", ("Phase", "site01")),
        ("run_2026_strain_stain_sCy5DA-01_s01m01_Phase", ["Cy5"], "Phase", ("Phase", "run_2026_strain_stain_sCy5DA-01_s01m01")),
        ("site42_CustomPhase", ["Cy5"], "CustomPhase", ("CustomPhase", "site42")),
        ("plain", ["Cy5"], "Phase", (None, "plain")),
        ("a_Cy5_b_Cy5DA.x", ["Cy5", "Cy5DA"], "Phase", ("Cy5DA", "a_Cy5_b")),
    ],
)
def test_channel_token(spark, stem, known, phase, want):
    t = one(spark, ID.channel_token(F.lit(stem), known, phase).alias("t")).t
    assert (t.channel, t.base) == want


@pytest.mark.parametrize(
    ("name", "want"),
    [("x_060225_0101_s3_m12_Phase.tif", ("0101", "3", "12")), ("060225_x_0101_s3.tif", ("UNK", "3", "UNK")), ("nothing.tif", ("UNK", "UNK", "UNK")), ("060225_12_060226_0102.tif", ("UNK", "UNK", "UNK"))],
)
def test_filename_metadata(spark, name, want):
    assert tuple(one(spark, ID.filename_metadata(F.lit(name)).alias("m")).m) == want


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_filename_metadata_token_by_token(spark):
    tokens = ["060225", "0101", "01012", "0602255", "s3", "m12", "s", "ms3", "s3x", "", "x.y"]
    names = ["_".join(t) + end for n in (1, 2, 3) for t in itertools.product(tokens, repeat=n) for end in (".tif", "")]

    def plain(name):
        found = re.sub(r"(?<=.)\.[^.]*$", "", name).split("_")
        first = lambda c: next((t[1:] for t in found if re.fullmatch(f"{c}[0-9]+", t)), "UNK")
        at = next((i for i, t in enumerate(found) if re.fullmatch("[0-9]{6}", t)), None)
        after = found[at + 1] if at is not None and at + 1 < len(found) else ""
        return after if re.fullmatch("[0-9]{4}", after) else "UNK", first("s"), first("m")

    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", ID.filename_metadata(F.col("n")).alias("m"))
    assert {r.n: tuple(r.m) for r in df.collect()} == {n: plain(n) for n in names}
    assert tuple(one(spark, ID.filename_metadata(F.lit(None).cast("string")).alias("m")).m) == ("UNK", "UNK", "UNK")
    assert "lambda" not in _plan(df)  # three searches in one text, no loops over its tokens for each


def test_basename_of_both_separators(spark):
    paths = {"/a/b.tif": "b.tif", "a\\b/c": "c", "a/b\\c": "c", "b": "b", "a/": "", "a\\": "", "": "", "é/ü.tif": "ü.tif"}
    df = spark.createDataFrame([(p,) for p in paths], "p string").select("p", ID.basename(F.col("p")).alias("b"))
    assert {r.p: r.b for r in df.collect()} == paths and "split(" not in _plan(df)


def test_secrets_in_long_words(spark):
    import time

    long = "x" * 60_000
    texts = {
        long: (long, 0), f"{long} my_Token={long} y": (f"{long} my_Token=<redacted> y", 1), f"{long}token = 'a b'password:c": (f"{long}token = <redacted>password:<redacted>", 2), "tokens of a secret": ("tokens of a secret", 0),
        "-API_KEYS\t: \"q\"token=z": ("-API_KEYS\t: <redacted>token=<redacted>", 2), "": ("", 0), None: (None, None),
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    began = time.perf_counter()
    got = df.select("t", ID.redacted_text(F.col("t")).alias("r"), ID.count_secrets(F.col("t")).alias("n")).collect()
    assert {r.t: (r.r, r.n) for r in got} == texts
    assert time.perf_counter() - began < 15  # a search from each character of a long word takes its square


def test_numbers_are_read_once(spark):
    texts = {"1 2, 3e1;-4 x .5": [[1.0, 2.0], [30.0, -4.0]], "": [], "7": [], "1 2 1e999 4": [[1.0, 2.0], [float("inf"), 4.0]], None: []}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", ID.numbers_in(F.col("t"), 2).alias("n"))
    assert {r.t: r.n for r in df.collect()} == texts and _plan(df).count("regexp_extract_all") == 1


def test_text_helpers(spark):
    r = one(
        spark,
        ID.pad_number(F.lit("7"), 4).alias("a"), ID.pad_number(F.lit("12345"), 4).alias("b"), ID.slug(F.lit("..a b!")).alias("c"), ID.slug(F.lit("..")).alias("d"), ID.review_status(F.lit(" PASS ")).alias("e"),
        ID.canonical_channels(F.array(F.lit("hada"), F.lit("")), 4).alias("f"), ID.numbers_in(F.lit("[1 2 3 4 5 6 7e1]")).alias("g"), ID.as_bool(F.lit("Yes")).alias("h"), ID.as_bool(F.lit(None)).alias("i"), ID.regex_first(F.lit("ab12"), r"(\d+)").alias("j"), ID.regex_first(F.lit("ab"), r"(\d+)").alias("k"),
        ID.diagnose_log(F.lit("x\nslurmstepd: oom-kill\n")).alias("l"), ID.diagnose_log(F.lit("Traceback\nKeyError: 'a'\nValueError: b")).alias("m"), ID.stem(F.lit("/a/b.c.tif")).alias("n"),
    )
    assert tuple(r) == ("0007", "12345", "a_b", "run", "cell", ["AF405", "AF405", "Bod493", "Channel3"], [[1.0, 2.0, 3.0, 4.0, 5.0, 6.0]], True, False, "12", None, "out of memory", "ValueError: b", "b.c")


def test_redaction():
    assert ID.redacted({"a": {"api_key": "x", "b": [{"password": "y", "c": 1}]}}) == {"a": {"api_key": "<redacted>", "b": [{"password": "<redacted>", "c": 1}]}}


def test_vectors_agree_with_numpy(spark):
    r = np.random.default_rng(3)
    p, q = r.normal(size=37), r.normal(size=37)
    a, b = F.array(*map(F.lit, map(float, p))), F.array(*map(F.lit, map(float, q)))
    got = one(
        spark,
        V.gradient(a).alias("g"), V.resample(a, 100).alias("r"), V.percentile(a, 30).alias("p"), V.moving_average(a, 5).alias("m"), V.correlation(a, b).alias("c"), V.zscore(a).alias("z"), V.reorient(a).alias("o"),
        V.interpolate(F.lit(2.5), F.array(*map(F.lit, (0.0, 2.0, 4.0))), F.array(*map(F.lit, (1.0, 3.0, 9.0)))).alias("i"), V.interpolate(F.lit(-1.0), F.array(*map(F.lit, (0.0, 2.0))), F.array(*map(F.lit, (1.0, 3.0)))).alias("j"), V.moving_average(a, 4).alias("m4"),
    )
    np.testing.assert_allclose(got.g, np.gradient(p))
    np.testing.assert_allclose(got.r, np.interp(np.linspace(0, 1, 100), np.linspace(0, 1, 37), p), atol=1e-12)
    np.testing.assert_allclose(got.p, np.percentile(p, 30))
    np.testing.assert_allclose(got.m, np.convolve(p, np.ones(5) / 5, "same"), atol=1e-12)
    np.testing.assert_allclose(got.m4, np.convolve(p, np.ones(4) / 4, "same"), atol=1e-12)
    np.testing.assert_allclose(got.c, np.corrcoef(p, q)[0, 1])
    np.testing.assert_allclose(got.z, (p - p.mean()) / p.std())
    flip = p[:18].mean() < p.mean()
    assert got.o.flipped == flip
    np.testing.assert_allclose(got.o.profile, p[::-1] if flip else p)
    assert (got.i, got.j) == (4.5, 1.0)


def test_pole_features_of_a_ramp(spark):
    p = [*np.linspace(10, 5, 50), *np.linspace(5, 1, 50)]
    f = one(spark, V.pole_features(F.array(*map(F.lit, map(float, p)))).alias("f")).f
    assert f.poleA > f.poleB and f.polar_asym > 0
    assert one(spark, V.pole_state(F.lit(f.polar_asym), F.lit(f.center_enrichment)).alias("s")).s == 1
    assert one(spark, V.pole_state(F.lit(float("nan")), F.lit(1.0)).alias("s")).s == -1
    assert one(spark, V.pole_features(F.array(F.lit(1.0))).alias("f")).f is None


def test_geometry(spark):
    xs, ys = F.array(*map(F.lit, (0.0, 1.0, 1.0, 2.0))), F.array(*map(F.lit, (0.0, 0.0, 1.0, 1.0)))
    r = one(
        spark,
        G.polyline_length(xs, ys, 2.0).alias("l"), G.sinuosity(xs, ys).alias("s"), G.bend_angles(xs, ys).alias("b"), G.intersect_lines(*map(F.lit, (0.0, 0.0, 2.0, 2.0, 0.0, 2.0, 2.0, 0.0))).alias("i"), G.angle_between(*map(F.lit, (1.0, 0.0, 0.0, 1.0))).alias("a"),
        G.orientation_sign(*map(F.lit, (0.0, 0.0, 1.0, 0.0, 0.5, 1.0))).alias("o"), G.imagej_fields(F.lit("ImageJ=1\n a = 1\nb = x = y")).alias("j"), G.crop_window(*map(F.lit, (1, 1, 3, 3, 2.0, 2.0)), 6, 1).alias("w"), F.size(G.line_crossings((F.lit(-1.0), F.lit(0.5)), (F.lit(3.0), F.lit(0.5)), F.array(*map(F.lit, (0.0, 2.0, 2.0, 0.0))), F.array(*map(F.lit, (0.0, 0.0, 2.0, 2.0))))).alias("n"),
    )
    assert r.l == 6.0 and r.s == round(3 / math.hypot(2, 1), 3) and r.b == [90.0, -90.0]
    assert (r.i.x, r.i.y) == (1.0, 1.0) and abs(r.a - math.pi / 2) < 1e-12 and r.o == 1.0 and r.j == {"a": "1", "b": "x = y"}
    assert tuple(r.w) == (-1, 5, -1, 5) and r.n == 2
    assert G.flat_page("TZCYX", {"T": 2, "Z": 3, "C": 4}, {"T": 1, "Z": 2, "C": 3}) == 23


def test_closed_curve_has_no_sinuosity(spark):
    with pytest.raises(Exception, match="sinuosity"):
        one(spark, G.sinuosity(F.array(F.lit(0.0), F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(1.0), F.lit(0.0))))
