import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoframe.catalog_networks import small_network
from cytoframe.functions import unet as U
from cytoframe.operators import networks as N
from cytoframe.operators import segmentation as S


def network(r, base=2, depth=2, inputs=2, classes=3, attention=False, bilinear=False, dtype=float):
    """Random arrays of a whole network, named as a checkpoint names them."""
    a = {}

    def conv(name, *shape, bias=None):
        a[f"{name}.weight"] = r.normal(size=shape)
        if bias:
            a[f"{name}.bias"] = r.normal(size=bias)

    def norm(name, n):
        a.update({f"{name}.weight": r.normal(size=n), f"{name}.bias": r.normal(size=n), f"{name}.running_mean": r.normal(size=n), f"{name}.running_var": r.uniform(0.5, 2, n), f"{name}.num_batches_tracked": np.array(3)})

    def block(name, i, o):
        conv(f"{name}.conv.0", o, i, 3, 3)
        norm(f"{name}.conv.1", o)
        conv(f"{name}.conv.3", o, o, 3, 3)
        norm(f"{name}.conv.4", o)

    block("encoder.stem", inputs, base)
    for k in range(depth):
        block(f"encoder.down_blocks.{k}.conv", base << k, base << (k + 1))
    for k in range(depth):
        deep, skip = base << (depth - k), base << (depth - k - 1)
        if bilinear:
            conv(f"decoder.up_blocks.{k}.up.1", skip, deep, 1, 1, bias=skip)
        else:
            conv(f"decoder.up_blocks.{k}.up", deep, skip, 2, 2, bias=skip)
        block(f"decoder.up_blocks.{k}.conv", 2 * skip, skip)
        if attention:
            m, g = max(skip // 2, 1), f"decoder.attention_gates.{k}"
            for part, o, i in (("W_g", m, deep), ("W_x", m, skip), ("psi", 1, m)):
                conv(f"{g}.{part}.0", o, i, 1, 1)
                norm(f"{g}.{part}.1", o)
    conv("decoder.outc", classes, base, 1, 1, bias=classes)
    return {k: v.astype(dtype) if v.ndim else v for k, v in a.items()}


class Slow:
    """The same network pixel by pixel, normalised after each convolution."""

    def __init__(self, arrays):
        self.a = arrays

    def conv(self, x, name):
        w = self.a[f"{name}.weight"]
        k = w.shape[-1]
        out = np.zeros((len(w), *x.shape[1:]))
        for o, y, xx in np.ndindex(*out.shape):
            total = self.a.get(f"{name}.bias", np.zeros(len(w)))[o]
            for c, i, j in np.ndindex(x.shape[0], k, k):
                yy, xs = y + i - k // 2, xx + j - k // 2
                if 0 <= yy < x.shape[1] and 0 <= xs < x.shape[2]:
                    total += w[o, c, i, j] * x[c, yy, xs]
            out[o, y, xx] = total
        return out

    def norm(self, x, name):
        g = [self.a[f"{name}.{p}"][:, None, None] for p in ("running_mean", "running_var", "weight", "bias")]
        return (x - g[0]) / np.sqrt(g[1] + 1e-5) * g[2] + g[3]

    def block(self, x, name):
        for c, n in ((0, 1), (3, 4)):
            x = np.maximum(self.norm(self.conv(x, f"{name}.conv.{c}"), f"{name}.conv.{n}"), 0)
        return x

    def resize(self, x, h, w):
        out = np.zeros((len(x), h, w))
        for c, y, xx in np.ndindex(*out.shape):
            a, b = (t * (s - 1) / (n - 1) if n > 1 else 0 for t, s, n in ((y, x.shape[1], h), (xx, x.shape[2], w)))
            y0, x0 = min(int(a), max(x.shape[1] - 2, 0)), min(int(b), max(x.shape[2] - 2, 0))
            y1, x1, fa, fb = min(y0 + 1, x.shape[1] - 1), min(x0 + 1, x.shape[2] - 1), a - y0, b - x0
            out[c, y, xx] = (1 - fa) * ((1 - fb) * x[c, y0, x0] + fb * x[c, y0, x1]) + fa * ((1 - fb) * x[c, y1, x0] + fb * x[c, y1, x1])
        return out

    def __call__(self, x, depth, attention, bilinear):
        kept = [self.block(x, "encoder.stem")]
        for k in range(depth):
            x = kept[-1]
            small = np.array([[[x[c, 2 * i : 2 * i + 2, 2 * j : 2 * j + 2].max() for j in range(x.shape[2] // 2)] for i in range(x.shape[1] // 2)] for c in range(len(x))])
            kept.append(self.block(small, f"encoder.down_blocks.{k}.conv"))
        x = kept.pop()
        for k in range(depth):
            skip = kept.pop()
            weighed = skip
            if attention:
                g = f"decoder.attention_gates.{k}"
                part = lambda v, p, g=g: self.norm(self.conv(v, f"{g}.{p}.0"), f"{g}.{p}.1")
                joint = part(np.maximum(part(self.resize(x, *skip.shape[1:]), "W_g") + part(skip, "W_x"), 0), "psi")
                weighed = skip / (1 + np.exp(-np.clip(joint, -700, 700)))
            up = f"decoder.up_blocks.{k}.up"
            if bilinear:
                big = self.conv(self.resize(x, 2 * x.shape[1], 2 * x.shape[2]), f"{up}.1")
            else:
                w, big = self.a[f"{up}.weight"], np.zeros((self.a[f"{up}.weight"].shape[1], 2 * x.shape[1], 2 * x.shape[2]))
                for c, o, y, xx, i, j in np.ndindex(len(x), len(big), x.shape[1], x.shape[2], 2, 2):
                    big[o, 2 * y + i, 2 * xx + j] += x[c, y, xx] * w[c, o, i, j]
                big += self.a[f"{up}.bias"][:, None, None]
            room = np.zeros((len(big), *skip.shape[1:]))
            dy, dx = (skip.shape[1] - big.shape[1]) // 2, (skip.shape[2] - big.shape[2]) // 2
            room[:, dy : dy + big.shape[1], dx : dx + big.shape[2]] = big
            x = self.block(np.concatenate([weighed, room]), f"decoder.up_blocks.{k}.conv")
        return self.conv(x, "decoder.outc")


@pytest.mark.parametrize(("attention", "bilinear", "depth", "shape"), [(False, False, 1, (8, 8)), (True, False, 2, (8, 8)), (False, True, 2, (8, 8)), (True, True, 1, (7, 5)), (False, False, 2, (9, 6))])
def test_layers_equal_plain_loops(attention, bilinear, depth, shape):
    r = np.random.default_rng(depth + attention)
    arrays = network(r, depth=depth, attention=attention, bilinear=bilinear)
    x = r.normal(size=(3, 2, *shape))
    got = U.UNet(arrays)(x)
    for one, logits in zip(x, got, strict=True):
        assert np.allclose(logits, Slow(arrays)(one, depth, attention, bilinear), atol=1e-6)


def test_older_names_channels_and_precision():
    r = np.random.default_rng(1)
    arrays = network(r)
    old = {new: o for o, new in U.OLDER_NAMES.items()}
    older = {next((old[p] + n[len(p) :] for p in old if n.startswith(p)), n): a for n, a in arrays.items()}
    x = r.normal(size=(1, 3, 8, 8))
    assert set(older) != set(arrays) and np.array_equal(U.UNet(older)(x), U.UNet(arrays)(x))
    assert np.array_equal(U.UNet(arrays)(x), U.UNet(arrays)(x[:, :2]))  # a third channel is not read
    assert np.array_equal(U.UNet(arrays)(x[:, :1]), U.UNet(arrays)(np.concatenate([x[:, :1], 0 * x[:, :1]], axis=1)))
    single = {k: v.astype(np.float32) if v.ndim else v for k, v in arrays.items()}
    assert U.UNet(single)(x).dtype == np.float32 and np.allclose(U.UNet(single)(x), U.UNet(arrays)(x), rtol=1e-3, atol=1e-3)
    with pytest.raises(ValueError, match="U-Net"):
        U.UNet({"a.weight": np.zeros(1)})


def test_weights_are_kept_in_parquet_and_their_size_is_checked(spark, tmp_path):
    arrays = network(np.random.default_rng(2), attention=True, dtype=np.float32)
    N.weights_table(spark, arrays).write.parquet(str(tmp_path / "w"))
    table = spark.read.parquet(str(tmp_path / "w"))
    back = N.broadcast_weights(table).arrays.value
    assert set(back) == set(arrays) and all(np.array_equal(back[k], arrays[k]) and back[k].dtype == arrays[k].dtype for k in arrays)
    with pytest.raises(ValueError, match="may be broadcast"):
        N.broadcast_weights(table, most_mb=0)


def images(spark, r):
    rows = [(f"i{k}", h, w, [r.normal(size=h * w).tolist() for _ in range(2)]) for k, (h, w) in enumerate([(8, 8), (5, 9), (8, 8), (33, 40), (1, 1)])]
    rows += [("none", 8, 8, None), ("flat", 4, 4, [[2.0] * 16]), ("short", 4, 4, [[1.0] * 15]), ("empty", 0, 4, [[]]), ("holes", 2, 2, [[None, float("nan"), float("inf"), 1.0]])]
    return rows, spark.createDataFrame([(*x, "more") for x in rows], "image_id string, height int, width int, planes array<array<double>>, classes string")


def test_prediction_of_a_table(spark):
    rows, df = images(spark, np.random.default_rng(3))
    arrays = network(np.random.default_rng(4))
    weights = N.broadcast_weights(N.weights_table(spark, arrays))
    got = {r.image_id: r for r in N.predict(df.repartition(3), weights, [0, 1], 4).collect()}
    assert len(got) == len(rows) and {k for k, r in got.items() if r.error} == {"none", "short", "empty"}
    slow = Slow(arrays)
    for name, h, w, planes in rows:
        if got[name].error or h > 10:
            continue
        x = np.zeros((2, h, w))
        for c, p in enumerate(planes):
            v = np.array([0.0 if t is None or not np.isfinite(t) else t for t in p]).reshape(h, w)
            x[c] = (v - v.min()) / (np.ptp(v) or 1)
        mode = "reflect" if h > -h % 4 and w > -w % 4 else "edge"
        logits = slow(np.pad(x, ((0, 0), (0, -h % 4), (0, -w % 4)), mode=mode), 2, False, False)[:, :h, :w]
        e = np.exp(logits - logits.max(axis=0))
        assert np.allclose(np.array(got[name].probabilities).reshape(3, h, w), e / e.sum(axis=0), atol=1e-6)
        assert got[name].classes == (e / e.sum(axis=0)).argmax(axis=0).ravel().tolist()
    assert N.predict(df.limit(0), weights).count() == 0
    summary = {r.image_id: r for r in N.class_summary(N.predict(df, weights, [0, 1], 4)).collect()}
    assert set(summary) == {k for k, r in got.items() if not r.error}
    for k, s in summary.items():
        p = np.array(got[k].probabilities).mean(axis=1)
        assert np.allclose([s.p_background, s.p_cell, s.p_non_cell], p) and s.predicted_class == ("background", "cell", "non_cell")[p.argmax()]
        assert [s.n_background, s.n_cell, s.n_non_cell] == np.bincount(got[k].classes, minlength=3).tolist()


def test_masks_are_the_largest_component(spark):
    p = np.array([[0.1, 0.1, 0.9, 0.1], [0.1, 0.1, 0.1, 0.1], [0.8, 0.8, 0.1, 0.45], [0.8, 0.1, 0.1, 0.1]])
    rows = [("a", 4, 4, (p > 0.4).astype(int).ravel().tolist(), [(0.5 - p / 2).ravel().tolist(), p.ravel().tolist(), (0.5 - p / 2).ravel().tolist()], None), ("b", 1, 1, [0], [[1.0], [0.0], [0.0]], None), ("c", 1, 1, None, None, "error")]
    df = spark.createDataFrame(rows, "image_id string, height int, width int, classes array<int>, probabilities array<array<double>>, error string")
    got = {r.image_id: np.array(r.labels).reshape(r.height, r.width).tolist() for r in N.cell_masks(df).collect()}
    assert got == {"a": [[0, 0, 0, 0], [0, 0, 0, 0], [1, 1, 0, 0], [1, 0, 0, 0]], "b": [[0]]}
    ahead = {r.image_id: sum(r.labels) for r in N.cell_masks(df, 0.85, 0.1).collect()}
    assert ahead == {"a": 1, "b": 0}


def test_a_network_scores_crops(spark):
    weights = N.broadcast_weights(N.weights_table(spark, small_network()))
    stack = [list(range(64)), [0] * 20 + [3] * 20 + [0] * 24]
    crop = spark.createDataFrame([("c1", 8, stack)], "Cell_ID string, side int, stack array<array<int>>")
    got = S.classify_crops(crop, weights).first()
    x = np.pad(np.arange(64).reshape(8, 8) / 63, ((0, 24), (0, 24)), mode="edge")
    logits = U.UNet(small_network())(x[None, None])[0][:, :8, :8]
    p = np.exp(logits) / np.exp(logits).sum(axis=0)
    want = [p[k].ravel()[20:40].mean() for k in range(3)]
    assert got.error is None and np.allclose([got.p_background, got.p_cell, got.p_noncell], want, atol=1e-5)


def test_query_takes_every_patch(spark):
    from cytoframe import catalog

    sf = "/root/testdata/sf0.001"
    got = catalog.queries()["unet_classes"](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/embeddings.parquet").count() and got.agg(F.count_distinct("predicted_class").alias("n")).first().n > 1
