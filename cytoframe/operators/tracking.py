"""Cells over time: links by overlap, lineages, assignment and the repair of trajectories."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.plans.checkpoints import checkpointed


def frame_overlaps(mask: DataFrame) -> DataFrame:
    """Overlaps of consecutive frames: mask pixels (t, label, y, x) to pairs of cells ``t_label``."""
    name = lambda t, label: F.concat_ws("_", t.cast("string"), label.cast("string"))
    now = mask.select("t", "y", "x", F.col("label").alias("a"))
    after = mask.select((F.col("t") - 1).alias("t"), "y", "x", F.col("label").alias("b"))
    shared = now.join(after, ["t", "y", "x"]).groupBy("t", "a", "b").agg(F.count("*").alias("overlap_area"))
    areas = mask.groupBy("t", "label").agg(F.count("*").alias("n"))
    out = shared.join(areas.select("t", F.col("label").alias("a"), F.col("n").alias("frame1_area")), ["t", "a"]).join(areas.select((F.col("t") - 1).alias("t"), F.col("label").alias("b"), F.col("n").alias("frame2_area")), ["t", "b"])
    o, p, q = F.col("overlap_area"), F.col("frame1_area"), F.col("frame2_area")
    return out.select(name(F.col("t"), F.col("a")).alias("frame1_id"), name(F.col("t") + 1, F.col("b")).alias("frame2_id"), "overlap_area", "frame1_area", "frame2_area", (o / p).alias("frame1_overlap_frac"), (o / q).alias("frame2_overlap_frac"), (o / (p + q - o)).alias("iou"))


def overlap_links(overlaps: DataFrame, cells: DataFrame, share: float = 0.5, min_area: int = 100, similarity: float = 0.75, min_cell: int = 200) -> DataFrame:
    """(mother, daughter) of cells (cell_id, t, touching_edge).

    Pairs whose overlap is more than ``share`` of either cell are linked.  A cell
    off the edge without a mother, but with daughters, is linked to any it
    overlaps by area, if both are of a size and large.
    """
    sure = overlaps.where(F.greatest("frame1_overlap_frac", "frame2_overlap_frac") > share).select(F.col("frame1_id").alias("mother"), F.col("frame2_id").alias("daughter"))
    orphans = cells.where((F.col("t") > 0) & ~F.col("touching_edge")).select(F.col("cell_id").alias("daughter"))
    orphans = orphans.join(sure, "daughter", "left_anti").join(sure.select(F.col("mother").alias("daughter")).distinct(), "daughter", "left_semi")
    near = (F.col("overlap_area") > min_area) & (F.least("frame1_area", "frame2_area") / F.greatest("frame1_area", "frame2_area") > similarity) & (F.least("frame1_area", "frame2_area") > min_cell)
    rescued = overlaps.where(near).select(F.col("frame1_id").alias("mother"), F.col("frame2_id").alias("daughter")).join(orphans, "daughter", "left_semi").select("mother", "daughter")
    return sure.union(rescued).distinct()


def with_family(cells: DataFrame, links: DataFrame) -> DataFrame:
    """Cells with their mothers and daughters as sorted lists, and their numbers."""
    mothers = links.groupBy(F.col("daughter").alias("cell_id")).agg(F.sort_array(F.collect_set("mother")).alias("mothers"))
    daughters = links.groupBy(F.col("mother").alias("cell_id")).agg(F.sort_array(F.collect_set("daughter")).alias("daughters"))
    none = F.array().cast("array<string>")
    out = cells.join(mothers, "cell_id", "left").join(daughters, "cell_id", "left")
    out = out.withColumns({"mothers": F.coalesce("mothers", none), "daughters": F.coalesce("daughters", none)})
    return out.withColumns({"n_mother": F.size("mothers"), "n_daughter": F.size("daughters")})


def relatives(links: DataFrame, cell: str, generations: int, forward: bool = False) -> DataFrame:
    """(generation, cell_id) of a cell's ancestors, or of its descendants."""
    here, there = ("mother", "daughter") if forward else ("daughter", "mother")
    start = links.where(F.col(here) == cell).select(F.lit(1).alias("generation"), F.col(there).alias("cell_id")).distinct()
    out, front = start, start
    for g in range(2, generations + 1):
        front = front.join(links, front.cell_id == links[here]).select(F.lit(g).alias("generation"), F.col(there).alias("cell_id")).distinct()
        out = out.union(front)
    return out


def forward_exhaustive(links: DataFrame, cell: str, extra: int, most_daughters: int, generations: int = 1000) -> DataFrame:
    """Descendants until ``extra`` generations after the first with ``most_daughters`` cells, or until there are none."""
    out, left = None, None
    front = links.sparkSession.createDataFrame([(cell,)], "cell_id string")
    for g in range(1, generations + 1):
        front = checkpointed(front.join(links, front.cell_id == links.mother).select(F.col("daughter").alias("cell_id")).distinct())
        n = front.count()
        if not n:
            break
        part = front.select(F.lit(g).alias("generation"), "cell_id")
        out = part if out is None else out.union(part)
        if left is None and n >= most_daughters:
            left = extra
        elif left is not None:
            left -= 1
        if left is not None and left <= 0:
            break
    return out if out is not None else links.sparkSession.createDataFrame([], "generation int, cell_id string")


def lineages(cells: DataFrame, links: DataFrame) -> DataFrame:
    """(cell_id, lineage): founders are numbered by time and id, a single daughter keeps its mother's name, several get ``.1``, ``.2``.

    One round for each frame: a daughter of several mothers follows the least.
    """
    # Read once, not in every round; merge hints, since sides that grow with the cells are not for the driver to broadcast.
    first = checkpointed(links.groupBy("daughter").agg(F.min("mother").alias("mother")))
    rank = F.row_number().over(Window.partitionBy("mother").orderBy("daughter"))
    n = F.count("*").over(Window.partitionBy("mother"))
    steps = checkpointed(first.withColumns({"suffix": F.when(n > 1, F.concat(F.lit("."), rank.cast("string"))).otherwise("")})).hint("merge")
    founders = cells.join(first.hint("merge"), cells.cell_id == first.daughter, "left_anti")
    from cytoframe.operators.batching import ranked

    done = checkpointed(ranked(founders.select("t", "cell_id"), "t", "cell_id").select("cell_id", (F.col("i") + 1).cast("string").alias("lineage")))
    out, front = done, done
    while True:
        front = checkpointed(front.join(steps, front.cell_id == steps.mother).select(F.col("daughter").alias("cell_id"), F.concat("lineage", "suffix").alias("lineage")))
        if not front.take(1):
            return out
        out = out.union(front)


LINEAGE_SQL = """
WITH RECURSIVE line(cell_id, lineage) AS (
  SELECT cell_id, lineage FROM founders
  UNION ALL
  SELECT s.daughter, concat(line.lineage, s.suffix) FROM line JOIN steps s ON s.mother = line.cell_id
) SELECT * FROM line
"""


def transition_features(cells: DataFrame, overlaps: DataFrame, vector: str = "features", scale: float = 1.0) -> DataFrame:
    """Pairs of cells in consecutive frames that may be one: overlap, similarity of features and areas, and distance.

    Only pairs whose boxes, grown by their own size, meet are made: a grid of
    cells of the largest side joins them by equality, not each with each.
    """
    from cytoframe.functions import vectors as V

    side = F.greatest(F.col("bbox_max_row") - F.col("bbox_min_row"), F.col("bbox_max_col") - F.col("bbox_min_col"))
    grid = 128
    around = lambda low, high: F.sequence(F.floor((F.col(low) - side) / grid), F.floor((F.col(high) + side) / grid))
    a = cells.withColumn("gy", F.explode(around("bbox_min_row", "bbox_max_row"))).withColumn("gx", F.explode(around("bbox_min_col", "bbox_max_col")))
    b = cells.select((F.col("t") - 1).alias("t"), F.floor(F.col("centroid_row") / grid).alias("gy"), F.floor(F.col("centroid_col") / grid).alias("gx"), F.col("cell_id").alias("b"), F.col(vector).alias("vb"), F.col("area").alias("area_b"), F.col("centroid_row").alias("ry"), F.col("centroid_col").alias("rx"))
    pairs = a.select("t", "gy", "gx", F.col("cell_id").alias("a"), F.col(vector).alias("va"), F.col("area").alias("area_a"), F.col("centroid_row").alias("qy"), F.col("centroid_col").alias("qx")).join(b, ["t", "gy", "gx"])
    distance = F.hypot(F.col("qy") - F.col("ry"), F.col("qx") - F.col("rx"))
    found = overlaps.select(F.col("frame1_id").alias("a"), F.col("frame2_id").alias("b"), "iou", "frame1_overlap_frac", "frame2_overlap_frac")
    out = pairs.join(found, ["a", "b"], "left")
    zero = F.lit(0.0)
    return out.select(
        "t", "a", "b", F.coalesce("iou", zero).alias("iou"), F.coalesce("frame1_overlap_frac", zero).alias("share_a"), F.coalesce("frame2_overlap_frac", zero).alias("share_b"), F.greatest(zero, F.coalesce(V.correlation(F.col("va"), F.col("vb")), zero)).alias("correlation"),
        V.difference(F.col("va"), F.col("vb")).alias("similarity"), F.log(V.distance_probability(distance * scale)).alias("log_distance"), V.norm_ratio(F.col("area_a"), F.col("area_b")).alias("area_ratio"),
    )


def assign(pairs: DataFrame, iou: float = 0.6, share: float = 0.8, similarity: float = 0.8, log_distance: float = -8.0, least_iou: float = 0.1) -> DataFrame:
    """(t, a, b, rule): greedy assignment within each pair of frames.

    First mutual best pairs by IoU; then cells that lie in one another, several
    to one and one to several; then what is left, by similarity and distance,
    each cell once.  Rows of a pair of frames are one group, as many as cells
    have neighbours.
    """

    def run(g: pd.DataFrame) -> pd.DataFrame:
        a, left_names = pd.factorize(g.a, sort=True)
        b, right_names = pd.factorize(g.b, sort=True)
        by_iou = np.lexsort((b, a, -g.similarity.to_numpy(), -g.iou.to_numpy()))
        by_shape = np.lexsort((b, a, -g.log_distance.to_numpy(), -g.similarity.to_numpy()))
        left, right = np.zeros(len(left_names), bool), np.zeros(len(right_names), bool)
        taken, rules = [], []
        # what a rule lets through at all, in its order; whether its left and its right cell have to be free
        steps = [
            ("one", by_iou, g.iou >= iou, True, True),
            ("split", by_iou, (g.share_b >= share) & (g.iou >= least_iou), False, True),
            ("merge", by_iou, (g.share_a >= share) & (g.iou >= least_iou), True, False),
            ("rest", by_shape, (g.similarity >= similarity) & (g.log_distance >= log_distance), True, True),
        ]
        for rule, order, passes, free_left, free_right in steps:
            found = order[passes.to_numpy()[order]]
            found = found[~(free_left & left[a[found]]) & ~(free_right & right[b[found]])]
            for i in found:
                if (free_left and left[a[i]]) or (free_right and right[b[i]]):
                    continue
                left[a[i]] = True
                if rule != "merge":
                    right[b[i]] = True
                taken.append(i)
                rules.append(rule)
        rows = g.iloc[taken]
        # as objects: strings that pandas holds in chunks are no Arrow arrays
        return pd.DataFrame({"t": rows.t.to_numpy(), "a": rows.a.to_numpy(), "b": rows.b.to_numpy(), "rule": rules}, dtype=object)

    return pairs.select("t", "a", "b", "iou", "share_a", "share_b", "similarity", "log_distance").groupBy("t").applyInPandas(run, "t int, a string, b string, rule string")


def spurious_events(cells: DataFrame, window: int = 3) -> DataFrame:
    """Cells whose smoothed number of daughters or mothers says that a split or a merge did not last: (cell_id, kind)."""
    w = Window.partitionBy("track").orderBy("t").rowsBetween(-(window // 2), window // 2)
    smooth = cells.withColumns({"_d": F.avg("n_daughter").over(w), "_m": F.avg("n_mother").over(w)})
    split, merge = (F.col("n_daughter") > 1) & (F.col("_d") < 1.5), (F.col("n_mother") > 1) & (F.col("_m") < 1.5)
    return smooth.where(split | merge).select("cell_id", F.when(split, "merge daughters").otherwise("split mothers").alias("kind"))


def split_cells(images: DataFrame, targets: DataFrame) -> DataFrame:
    """Labels of images with given cells split along the watershed of their parts in another frame.

    ``images`` (t, height, width, labels); ``targets`` (t, label, seeds array<int>):
    seeds are a plane of labels, 0 elsewhere.
    """
    from cytoframe.functions import imaging as I

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                h, w = int(r.height), int(r.width)
                labels = np.asarray(r.labels, np.int32).reshape(h, w).copy()
                for c in r.cuts if r.cuts is not None else []:
                    mask = labels == c["label"]
                    parts = I.watershed(-I.distance_transform(mask), np.asarray(c["seeds"], np.int32).reshape(h, w), mask)
                    for k in np.unique(parts[parts > 0])[1:]:
                        labels[parts == k] = labels.max() + 1
                out.append(labels.ravel().tolist())
            yield batch.assign(labels=out)[["t", "height", "width", "labels"]]

    cuts = targets.groupBy("t").agg(F.collect_list(F.struct("label", "seeds")).alias("cuts"))
    return images.join(cuts, "t", "left").select("t", "height", "width", "labels", "cuts").mapInPandas(run, "t int, height int, width int, labels array<int>")


def track(mask: DataFrame, rounds: int = 3, **how) -> tuple[DataFrame, DataFrame]:
    """(mask, links): link, merge daughters that touch only for a moment, and link again, until nothing changes."""
    links = None
    for _ in range(rounds):
        cells = mask.groupBy("t", "label").agg(F.count("*").alias("area")).withColumns({"cell_id": F.concat_ws("_", F.col("t").cast("string"), F.col("label").cast("string")), "touching_edge": F.lit(False)})
        links = checkpointed(overlap_links(frame_overlaps(mask), cells, **how))
        family = with_family(cells, links)
        brief = family.where("n_daughter > 1").select(F.explode("daughters").alias("cell_id"), F.col("daughters")[0].alias("into"))
        back = with_family(cells, links).where("n_mother > 1").select(F.explode("mothers").alias("cell_id"))
        merges = brief.join(back, "cell_id", "left_semi").where("cell_id <> into")
        if not merges.take(1):
            break
        part = lambda c, i: F.get(F.split(c, "_"), F.lit(i)).cast("int")
        rename = merges.groupBy("cell_id").agg(F.min("into").alias("into")).select(part("cell_id", 0).alias("t"), part("cell_id", 1).alias("label"), part("into", 1).alias("into"))
        mask = checkpointed(mask.join(rename, ["t", "label"], "left").withColumn("label", F.coalesce("into", "label")).drop("into"))
    return mask, links


def drift_series(shifts: DataFrame, keys: tuple[str, ...] = ("position",)) -> DataFrame:
    """Cumulative shifts of frames from shifts between neighbours (keys, t, dy, dx)."""
    w = Window.partitionBy(*keys).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    return shifts.withColumns({"cum_dy": F.sum("dy").over(w), "cum_dx": F.sum("dx").over(w)})


def common_area(series: DataFrame, height: int, width: int, keys: tuple[str, ...] = ("position",)) -> DataFrame:
    """The part of a frame that all shifted frames cover, half open."""
    up, down = F.greatest(F.ceil(F.max("cum_dy")), F.lit(0)), F.least(F.floor(F.min("cum_dy")), F.lit(0))
    left, right = F.greatest(F.ceil(F.max("cum_dx")), F.lit(0)), F.least(F.floor(F.min("cum_dx")), F.lit(0))
    return series.groupBy(*keys).agg(up.alias("r1"), (height + down).alias("r2"), left.alias("c1"), (width + right).alias("c2"))


def cell_name(t: Column, label: Column) -> Column:
    return F.concat_ws("_", t.cast("string"), label.cast("string"))
