"""Densities of spots by length class against direct sums over all spots and places."""

import numpy as np
import pytest

from cytoframe.operators import density as D


def direct(spots, across, along):
    """A kernel at every spot, one place of the grid after the other."""
    w, x, y = np.array(spots).T
    share = w / w.sum()
    covariance = np.cov(np.stack([x, y]), aweights=share)
    n = 1 / (share**2).sum()
    inverse = np.linalg.inv(covariance * n ** (-1 / 3))
    out = np.zeros((along, across))
    for r in range(along):
        for c in range(across):
            d = np.stack([c / (across - 1) - x, r / (along - 1) - y])
            out[r, c] = (w * np.exp(-0.5 * np.einsum("in,ij,jn->n", d, inverse, d))).sum()
    return out / out.max()


def test_density_equals_direct_sums(spark):
    r = np.random.default_rng(4)
    cells = [(f"c{i}", float(v)) for i, v in enumerate(r.permutation(101))]
    spots = [(f"c{r.integers(101)}", float(r.gamma(2)), float(a), float(b)) for a, b in r.random((3000, 2))]
    spots += [("c1", None, 0.5, 0.5), ("c1", 9.0, None, 0.5), ("c1", 9.0, 0.5, float("nan")), ("c1", -3.0, 0.5, 0.5), ("none", 9.0, 0.5, 0.5), (None, 9.0, 0.5, 0.5)]
    spots += [spots[0]] * 1500  # repeated rows, a hot class
    classes = D.length_classes(spark.createDataFrame([*cells, ("x", None), ("y", float("nan"))], "cell_id string, length double"))
    of = {k: v.length_class for k, v in ((v.cell_id, v) for v in classes.collect())}
    assert of == {c: int(v // 20) for c, v in cells if v < 100}
    df = spark.createDataFrame(spots, "cell_id string, peak_intensity double, x double, y double").repartition(7)
    got = D.spot_density(df, classes, across=6, along=9, cutoff=0.5, rows=64).collect()
    grids = {k: np.zeros((9, 6)) for k in range(5)}
    for v in got:
        grids[v.length_class][v.grid_row, v.grid_column] = v.density
    assert len(got) == 5 * 54
    for k in grids:
        own = [s[1:] for s in spots if of.get(s[0]) == k and None not in s and not np.isnan(s[3]) and s[1] >= 0.5]
        assert {v.n_spots for v in got if v.length_class == k} == {len(own)}
        np.testing.assert_allclose(grids[k], direct(own, 6, 9), atol=1e-9)


def test_classes_without_a_kernel(spark):
    classes = spark.createDataFrame([("a", 0), ("b", 1)], "cell_id string, length_class int")
    schema = "cell_id string, peak_intensity double, x double, y double"
    line = spark.createDataFrame([("a", 1.0, 0.1 * k, 0.1 * k) for k in range(5)] + [("b", 1.0, 0.1, 0.2), ("b", 1.0, 0.3, 0.1)], schema)
    assert D.spot_density(line, classes).count() == 0 and D.spot_density(line.limit(0), classes).count() == 0
    cells = spark.createDataFrame([("a", 2.0), ("b", 2.0)], "cell_id string, length double")
    assert D.length_classes(cells).count() == 0 and D.length_classes(cells.limit(0)).count() == 0
    with pytest.raises(ValueError):
        D.length_classes(cells, classes=0)
