"""Registered queries of networks and outlines, with SQL that says the same layer by layer and pixel by pixel."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from cytoframe.catalog import PIXELS_SQL, query, rounded, table
from cytoframe.operators import networks as N
from cytoframe.operators import regions as R
from cytoframe.sources import rois as RO

#: The arrays of a small network by name: a running number, and the shape.
_KERNELS = {
    "encoder.stem.conv.0": (2, 1, 3, 3), "encoder.stem.conv.3": (2, 2, 3, 3), "encoder.down_blocks.0.conv.conv.0": (4, 2, 3, 3), "encoder.down_blocks.0.conv.conv.3": (4, 4, 3, 3),
    "decoder.up_blocks.0.conv.conv.0": (2, 4, 3, 3), "decoder.up_blocks.0.conv.conv.3": (2, 2, 3, 3), "decoder.up_blocks.0.up": (4, 2, 2, 2), "decoder.outc": (3, 2, 1, 1),
}
_NUMBER = {name: 10 * k for k, name in enumerate(_KERNELS)}


def small_network() -> dict[str, np.ndarray]:
    """Weights by a rule, the same in SQL: of array t, element i is ((37 i + 101 t) mod 97 - 48) / 40."""

    def values(t: int, *shape: int) -> np.ndarray:
        i = np.arange(int(np.prod(shape)))
        return (((37 * i + 101 * t) % 97 - 48) / 40.0).reshape(shape)

    arrays = {}
    for name, shape in _KERNELS.items():
        t = _NUMBER[name]
        arrays[f"{name}.weight"] = values(t, *shape)
        if ".conv." not in name:
            arrays[f"{name}.bias"] = values(t + 1, shape[1] if name.endswith("up") else shape[0])
            continue
        stem, _, k = name.rpartition(".")
        norm, o = f"{stem}.{int(k) + 1}", shape[0]
        arrays |= {f"{norm}.weight": 1 + values(t + 1, o) / 4, f"{norm}.bias": values(t + 2, o) / 4, f"{norm}.running_mean": values(t + 3, o) / 4, f"{norm}.running_var": 1 + values(t + 4, o) ** 2}
    return arrays


def _v(t: int, i: str) -> str:
    return f"(((37 * ({i}) + 101 * {t}) % 97 - 48) / 40.0::DOUBLE)"


def _layer(out: str, source: str, name: str, size: int) -> str:
    """A convolution, its normalisation and the maximum with 0 over pixels (vec_id, c, y, x, v)."""
    o, c, k, _ = _KERNELS[name]
    t, r = _NUMBER[name], k // 2
    normed = f"(s - {_v(t + 3, 'o')} / 4) / sqrt(1 + power({_v(t + 4, 'o')}, 2) + 1e-5) * (1 + {_v(t + 1, 'o')} / 4) + {_v(t + 2, 'o')} / 4" if ".conv." in name else f"s + {_v(t + 1, 'o')}"
    return f"""{out}_w AS (SELECT i // {c * k * k} AS o, (i // {k * k}) % {c} AS c, (i // {k}) % {k} - {r} AS dy, i % {k} - {r} AS dx, {_v(t, 'i')} AS w FROM range({o * c * k * k}) r(i)),
{out}_s AS (SELECT vec_id, o, y - dy AS y, x - dx AS x, sum(v * w) AS s FROM {source} JOIN {out}_w USING (c) WHERE y - dy BETWEEN 0 AND {size - 1} AND x - dx BETWEEN 0 AND {size - 1} GROUP BY 1, 2, 3, 4),
{out} AS (SELECT vec_id, o AS c, y, x, {f'greatest(0, {normed})' if '.conv.' in name else normed} AS v FROM {out}_s)"""


_UP = _NUMBER["decoder.up_blocks.0.up"]
_UNET_SQL = f"""
WITH {PIXELS_SQL}, z AS (SELECT image_id AS vec_id, 0 AS c, y, x, coalesce((value - min(value) OVER w) / nullif(max(value) OVER w - min(value) OVER w, 0), 0) AS v FROM px WINDOW w AS (PARTITION BY image_id)),
{_layer('a1', 'z', 'encoder.stem.conv.0', 8)}, {_layer('a2', 'a1', 'encoder.stem.conv.3', 8)},
p AS (SELECT vec_id, c, y // 2 AS y, x // 2 AS x, max(v) AS v FROM a2 GROUP BY 1, 2, 3, 4),
{_layer('b1', 'p', 'encoder.down_blocks.0.conv.conv.0', 4)}, {_layer('b2', 'b1', 'encoder.down_blocks.0.conv.conv.3', 4)},
u AS (SELECT vec_id, o AS c, 2 * y + dy AS y, 2 * x + dx AS x, sum(v * {_v(_UP, 'c * 8 + o * 4 + dy * 2 + dx')}) + {_v(_UP + 1, 'o')} AS v FROM b2, range(2) o(o), range(2) dy(dy), range(2) dx(dx) GROUP BY vec_id, o, 2 * y + dy, 2 * x + dx),
j AS (SELECT vec_id, c, y, x, v FROM a2 UNION ALL SELECT vec_id, c + 2, y, x, v FROM u),
{_layer('d1', 'j', 'decoder.up_blocks.0.conv.conv.0', 8)}, {_layer('d2', 'd1', 'decoder.up_blocks.0.conv.conv.3', 8)}, {_layer('l', 'd2', 'decoder.outc', 8)},
wide AS (SELECT vec_id, y, x, max(v) FILTER (c = 0) AS l0, max(v) FILTER (c = 1) AS l1, max(v) FILTER (c = 2) AS l2 FROM l GROUP BY 1, 2, 3),
e AS (SELECT *, exp(l0 - greatest(l0, l1, l2)) AS e0, exp(l1 - greatest(l0, l1, l2)) AS e1, exp(l2 - greatest(l0, l1, l2)) AS e2 FROM wide),
q AS (SELECT vec_id, CASE WHEN e0 >= e1 AND e0 >= e2 THEN 0 WHEN e1 >= e2 THEN 1 ELSE 2 END AS k, e0 / (e0 + e1 + e2) AS p0, e1 / (e0 + e1 + e2) AS p1, e2 / (e0 + e1 + e2) AS p2 FROM e),
m AS (SELECT vec_id, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2, avg(p0) AS p0, avg(p1) AS p1, avg(p2) AS p2 FROM q GROUP BY 1)
SELECT CAST(vec_id AS VARCHAR) AS image_id, n0 AS n_background, n1 AS n_cell, n2 AS n_non_cell, round(p0, 6) AS p_background, round(p1, 6) AS p_cell, round(p2, 6) AS p_non_cell,
  CASE WHEN p0 >= p1 AND p0 >= p2 THEN 'background' WHEN p1 >= p2 THEN 'cell' ELSE 'non_cell' END AS predicted_class FROM m
"""


@query(_UNET_SQL)
def unet_classes(spark, sf_dir):
    """Patches through a network of one level: pixels and mean probability of each class."""
    patches = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.array("embedding").alias("planes"))
    weights = N.broadcast_weights(N.weights_table(spark, small_network()))
    return rounded(N.class_summary(N.predict(patches, weights, multiple=8)))


# ---- outlines --------------------------------------------------------------

#: Directions of sixteen points around the middle of an image of 32 by 32 pixels.
_AROUND = [(12, 0), (11, 5), (8, 8), (5, 11), (0, 12), (-5, 11), (-8, 8), (-11, 5), (-12, 0), (-11, -5), (-8, -8), (-5, -11), (0, -12), (5, -11), (8, -8), (11, -5)]
_AT_SQL = f"(CASE i {' '.join(f'WHEN {k} THEN {{}}' for k in range(16))} END)"


def _outlines(spark, sf_dir):
    """A star around the middle of an image for each vector."""
    e = table(spark, sf_dir, "embeddings")

    def along(axis):
        return F.array(*[16 + d[axis] * (0.5 + F.get("embedding", F.lit(k)).cast("double")) for k, d in enumerate(_AROUND)])

    return e.select(F.col("vec_id").alias("image_id"), F.lit(1).alias("label"), along(0).alias("xs"), along(1).alias("ys"))


_STAR_SQL = f"""star AS (SELECT vec_id, i, 16 + {_AT_SQL.format(*[d[0] for d in _AROUND])} * (0.5::DOUBLE + CAST(embedding[i + 1] AS DOUBLE)) AS x, 16 + {_AT_SQL.format(*[d[1] for d in _AROUND])} * (0.5::DOUBLE + CAST(embedding[i + 1] AS DOUBLE)) AS y
  FROM embeddings, range(16) r(i))"""


@query(f"WITH {_STAR_SQL} SELECT vec_id, CAST(0 AS INTEGER) AS number, 'cell ' || vec_id AS name, 'freehand' AS kind, count(*) AS n_points, sum(round(x) * (i + 1)) AS x_moment, sum(round(y) * (i + 1)) AS y_moment, CAST(min(round(y)) AS INTEGER) AS top, CAST(max(round(x)) AS INTEGER) AS right FROM star GROUP BY vec_id")
def roi_archives(spark, sf_dir):
    """Outlines written as archives and read back."""
    o = _outlines(spark, sf_dir)
    whole = o.select(F.col("image_id").cast("string").alias("archive"), F.lit(0).alias("number"), F.concat(F.lit("cell "), "image_id").alias("name"), F.lit("freehand").alias("kind"), F.transform("xs", lambda v: F.round(v)).alias("xs"), F.transform("ys", lambda v: F.round(v)).alias("ys"))
    back = RO.decoded(RO.archives(whole).select(F.concat(F.lit("/rois/"), "archive", F.lit(".zip")).alias("path"), "content"))

    def moment(c):
        return F.aggregate(F.transform(c, lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v)

    return back.select(F.col("archive").cast("long").alias("vec_id"), "number", "name", "kind", F.size("xs").cast("long").alias("n_points"), moment("xs").alias("x_moment"), moment("ys").alias("y_moment"), "top", "right")


_ROI_SQL = f"""WITH {_STAR_SQL}, cut AS (
  SELECT vec_id, 0 AS j, x, y FROM star WHERE i = 0 UNION ALL SELECT vec_id, 31, x, y FROM star WHERE i = 15
  UNION ALL SELECT a.vec_id, 2 * a.i + 1 + k, CASE k WHEN 0 THEN a.x * 0.75::DOUBLE + b.x * 0.25::DOUBLE ELSE a.x * 0.25::DOUBLE + b.x * 0.75::DOUBLE END, CASE k WHEN 0 THEN a.y * 0.75::DOUBLE + b.y * 0.25::DOUBLE ELSE a.y * 0.25::DOUBLE + b.y * 0.75::DOUBLE END
  FROM star a JOIN star b ON b.vec_id = a.vec_id AND b.i = a.i + 1, range(2) k(k)),
edge AS (SELECT a.vec_id, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM cut a JOIN cut b ON b.vec_id = a.vec_id AND b.j = (a.j + 1) % 32),
hit AS (SELECT vec_id, y, x1 + (y - y1) * (x2 - x1) / (y2 - y1) AS c FROM edge, range(32) r(y) WHERE (y1 <= y) <> (y2 <= y)),
filled AS (SELECT vec_id, y, x FROM hit, range(32) r(x) WHERE c > x GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1),
near AS (SELECT dy, dx FROM range(-2, 3) a(dy), range(-2, 3) b(dx) WHERE dy * dy + dx * dx <= 4),
core AS (SELECT f.vec_id, f.y, f.x FROM filled f, near n LEFT JOIN filled g ON g.vec_id = f.vec_id AND g.y = f.y + n.dy AND g.x = f.x + n.dx WHERE n.dy * n.dy + n.dx * n.dx <= 1 AND f.y + n.dy BETWEEN 0 AND 31 AND f.x + n.dx BETWEEN 0 AND 31 GROUP BY 1, 2, 3 HAVING count(*) = count(g.y)),
around AS (SELECT DISTINCT vec_id, y + dy AS y, x + dx AS x FROM core, near WHERE y + dy BETWEEN 0 AND 31 AND x + dx BETWEEN 0 AND 31),
marked AS (SELECT a.vec_id, a.y, a.x, CASE WHEN c.y IS NULL THEN 125 ELSE 254 END AS value FROM around a LEFT JOIN core c ON c.vec_id = a.vec_id AND c.y = a.y AND c.x = a.x)
SELECT vec_id, count(*) FILTER (value = 254) AS n_core, count(*) FILTER (value = 125) AS n_edge, CAST(sum(y * value) AS BIGINT) AS y_moment, CAST(sum(x * x * value) AS BIGINT) AS x_moment FROM marked GROUP BY 1"""


@query(_ROI_SQL)
def roi_level_masks(spark, sf_dir):
    """Outlines with cut corners as masks of two levels: their cores and what is around them."""
    o = _outlines(spark, sf_dir)
    m = R.level_masks(o, o.select("image_id", F.lit(32).alias("height"), F.lit(32).alias("width")), radius=1)
    weighed = [F.sum((F.col("y") * F.col("value")).cast("long")).alias("y_moment"), F.sum((F.col("x") * F.col("x") * F.col("value")).cast("long")).alias("x_moment")]
    return m.groupBy(F.col("image_id").alias("vec_id")).agg(F.count_if(F.col("value") == R.CORE).alias("n_core"), F.count_if(F.col("value") == R.EDGE).alias("n_edge"), *weighed)
