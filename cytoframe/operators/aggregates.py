"""Aggregates over tidy tables: summaries, classes, metrics and outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def tidy(cells: DataFrame, key: str, features: list[str]) -> DataFrame:
    """(key, feature, value) of a wide table; NaN is null."""
    wide = cells.select(key, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in features])
    return wide.unpivot(key, features, "feature", "value")


def wide_matrix(long: DataFrame, key: str = "cell_id", most: int = 10_000) -> DataFrame:
    """Features in rows, cells in columns, for export alone: an error above ``most`` cells."""
    ids = [r[0] for r in long.select(key).distinct().orderBy(key).limit(most + 1).collect()]
    if len(ids) > most:
        raise ValueError(f"a matrix of more than {most} columns; keep the tidy table")
    return long.groupBy("feature").pivot(key, ids).agg(F.first("value")).orderBy("feature")


def percentiles(df: DataFrame, keys: list[str], value: str, shares: list[float], name: str = "q") -> DataFrame:
    """(keys, name array<double>): exact percentiles of groups of any size, linear between the closest ranks.

    Equal values are counted first; the counts are sorted by ranges, and each
    range's sum says which ranks it holds.  No task and no buffer holds a group.
    """
    from cytoframe.plans.checkpoints import checkpointed

    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    order = [*keys, "_v"]
    parts = checkpointed(counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    own = Window.partitionBy(*keys)
    sizes = parts.groupBy(*keys, "_part").agg(F.sum("_n").alias("_s"))
    before = F.coalesce(F.sum("_s").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(*keys, "_part", before.alias("_start"), F.sum("_s").over(own).alias("_total"))
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    rows = parts.withColumn("_upto", upto).join(starts, [*keys, "_part"])
    last = F.col("_start") + F.col("_upto") - 1
    first = last - F.col("_n") + 1
    out = []
    for share in shares:
        at = (F.col("_total") - 1) * float(share)
        low, high = F.floor(at), F.ceil(at)
        weight = F.when(low.between(first, last), 1 - (at - low)).otherwise(0.0) + F.when(high.between(first, last), at - low).otherwise(0.0)
        out.append(F.sum(F.when(weight > 0, F.col("_v") * weight).otherwise(0.0)))
    return rows.groupBy(*keys).agg(F.array(*out).alias(name)) if keys else rows.agg(F.array(*out).alias(name))


def feature_summary(long: DataFrame) -> DataFrame:
    """Each feature's mean, sample deviation, limits, quartiles, count and share of missing values."""
    v = F.col("value")
    out = long.groupBy("feature").agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"), F.count(v).alias("n_valid"), F.round(100 * F.avg(v.isNull().cast("int")), 2).alias("pct_missing"))
    out = out.join(percentiles(long, ["feature"], "value", [0.25, 0.5, 0.75], "_q"), "feature", "left")
    return out.select("feature", "mean", "std", "min", "max", *[F.get("_q", i).alias(n) for i, n in enumerate(("q25", "q50", "q75"))], "n_valid", "pct_missing")


def is_numeric(df: DataFrame, column: str) -> bool:
    """Whether any value of a column is a number."""
    return bool(df.where(F.col(column).cast("string").try_cast("double").isNotNull()).take(1))


def _moments(df: DataFrame, features: list[str]) -> DataFrame:
    """One row: mean and population deviation of each feature."""
    return df.agg(*[x for c in features for x in (F.avg(c).alias(f"_m_{c}"), F.stddev_pop(c).alias(f"_s_{c}"))])


def with_zscores(df: DataFrame, *features: str) -> DataFrame:
    """Columns z_<feature>; the one row of moments is broadcast."""
    joined = df.join(F.broadcast(_moments(df, list(features))), how="cross")
    z = {f"z_{c}": F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")) for c in features}
    return joined.withColumns(z).drop(*[f"_{k}_{c}" for k in "ms" for c in features])


def remove_outliers(df: DataFrame, feature: str, cutoff: float = 3.0) -> DataFrame:
    """Rows whose value lies within ``cutoff`` deviations of the mean."""
    return with_zscores(df, feature).where(F.abs(f"z_{feature}") < cutoff).drop(f"z_{feature}")


def remove_outliers_batch(df: DataFrame, cutoffs: dict[str, float]) -> DataFrame:
    """One feature after the other, each with the moments of the rows that are left."""
    for feature, cutoff in cutoffs.items():
        df = remove_outliers(df, feature, cutoff)
    return df


def find_outliers(df: DataFrame, cutoffs: dict[str, float], name: str = "outlier") -> DataFrame:
    """1 for rows above the mean by more than a cutoff in any feature, else 0: one side counts."""
    flags = [F.coalesce((F.col(f"z_{c}") > k).cast("int"), F.lit(0)) for c, k in cutoffs.items()]
    return with_zscores(df, *cutoffs).withColumn(name, F.greatest(*flags, F.lit(0))).drop(*[f"z_{c}" for c in cutoffs])


def min_max_scaled(df: DataFrame, *features: str) -> DataFrame:
    limits = df.agg(*[x for c in features for x in (F.min(c).alias(f"_l_{c}"), F.max(c).alias(f"_h_{c}"))])
    joined = df.join(F.broadcast(limits), how="cross")
    return joined.withColumns({c: F.try_divide(F.col(c) - F.col(f"_l_{c}"), F.col(f"_h_{c}") - F.col(f"_l_{c}")) for c in features}).drop(*[f"_{k}_{c}" for k in "lh" for c in features])


def confusion(pairs: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(target, pred, n) of labelled pixels or objects."""
    return pairs.groupBy(*keys, "target", "pred").agg(F.count("*").alias("n"))


def dice_iou(pairs: DataFrame, classes: list[int], keys: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """(keys, class, dice, iou); both are 1 where neither side has the class."""
    counted = pairs.groupBy(*keys, "pred", "target").agg(F.count("*").alias("n"))
    rows = counted.withColumn("class", F.explode(F.array(*map(F.lit, classes))))
    both = F.sum(F.when((F.col("pred") == F.col("class")) & (F.col("target") == F.col("class")), F.col("n")).otherwise(0))
    p, t = F.sum(F.when(F.col("pred") == F.col("class"), F.col("n")).otherwise(0)), F.sum(F.when(F.col("target") == F.col("class"), F.col("n")).otherwise(0))
    out = rows.groupBy(*keys, "class").agg(both.alias("_b"), p.alias("_p"), t.alias("_t"))
    return out.select(*keys, "class", F.coalesce(F.try_divide(2 * F.col("_b"), F.col("_p") + F.col("_t")), F.lit(1.0)).alias("dice"), F.coalesce(F.try_divide(F.col("_b"), F.col("_p") + F.col("_t") - F.col("_b")), F.lit(1.0)).alias("iou"))


def mean_scores(scores: DataFrame, foreground: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Each class's mean over images, and that over the foreground classes as class -1."""
    by_class = scores.groupBy("class").agg(F.avg("dice").alias("dice"), F.avg("iou").alias("iou"))
    return by_class.union(by_class.where(F.col("class").isin(*foreground)).agg(F.lit(-1).alias("class"), F.avg("dice"), F.avg("iou")))


def object_votes(pairs: DataFrame, keys: tuple[str, ...] = ("image_id",)) -> DataFrame:
    """Each object's class by its pixels inside the target: background if it has more than both others, cell on ties."""
    inside = pairs.where("target > 0")
    n = [F.count_if(F.col("pred") == k) for k in range(3)]
    counted = inside.groupBy(*keys).agg(*[c.alias(f"_n{k}") for k, c in enumerate(n)], F.max("target").alias("target"))
    vote = F.when(F.col("_n0") > F.col("_n1") + F.col("_n2"), 0).when(F.col("_n1") >= F.col("_n2"), 1).otherwise(2)
    return counted.select(*keys, "target", vote.alias("pred"))


def object_metrics(objects: DataFrame) -> DataFrame:
    """Precision, recall, F1 and both rates of the cell class; what was called background does not count against it."""
    tp, fp = F.count_if((F.col("target") == 1) & (F.col("pred") == 1)), F.count_if((F.col("target") == 2) & (F.col("pred") == 1))
    fn, tn = F.count_if((F.col("target") == 1) & (F.col("pred") != 1)), F.count_if((F.col("target") == 2) & (F.col("pred") != 1))
    c = objects.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    p, r = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0)), F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0))
    return c.select("tp", "fp", "fn", "tn", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"), F.coalesce(F.try_divide("tn", F.col("tn") + F.col("fp")), F.lit(0.0)).alias("tnr"), F.coalesce(F.try_divide("fp", F.col("tn") + F.col("fp")), F.lit(0.0)).alias("fpr"))


def class_weights(counts: DataFrame, method: str = "inverse_freq", smooth: float = 1.0, beta: float = 0.9999) -> DataFrame:
    """(class, n, weight) of (class, n): weights that sum to the number of classes."""
    n = F.col("n") + smooth
    raw = {"inverse_freq": 1 / n, "inverse_sqrt_freq": 1 / F.sqrt(n), "effective_num": (1 - beta) / (1 - F.pow(F.lit(beta), n))}[method]
    weighted = counts.withColumn("_w", raw)
    totals = weighted.agg(F.sum("_w").alias("_sum"), F.count("*").alias("_k"))
    return weighted.join(F.broadcast(totals), how="cross").select("class", "n", (F.col("_w") / F.col("_sum") * F.col("_k")).alias("weight"))


def puncta_summary(cells: DataFrame, puncta: DataFrame, total: str = "total_intensity", key: str = "cell_id") -> DataFrame:
    """Each cell's spots: count, sums, extremes and share of its intensity; no spot is a count of 0, the rest null."""
    s = puncta.groupBy(key).agg(F.count("*").alias("punctum_count"), F.sum("peak_intensity").alias("total_punctum_intensity"), F.max("peak_intensity").alias("max_punctum_intensity"), F.avg(F.abs("log")).alias("mean_log"), F.max(F.abs("log")).alias("max_log"))
    out = cells.select(key, total).join(s, key, "left")
    return out.select(key, F.coalesce("punctum_count", F.lit(0)).alias("punctum_count"), "total_punctum_intensity", "max_punctum_intensity", "mean_log", "max_log", (F.col("total_punctum_intensity") / (F.col(total) + 1e-10)).alias("fraction_of_total"))


def axial_positions(puncta: DataFrame, midlines: DataFrame, key: str = "cell_id") -> DataFrame:
    """Spots with the share of the arc length at the nearest point of their cell's midline, and their distance: midlines (key, i, y, x)."""
    from cytoframe.functions.geometry import distance

    w = Window.partitionBy(key).orderBy("i")
    steps = midlines.withColumn("_d", F.coalesce(distance(F.lag("y").over(w), F.lag("x").over(w), F.col("y"), F.col("x")), F.lit(0.0)))
    arc = steps.withColumns({"_s": F.sum("_d").over(w.rowsBetween(Window.unboundedPreceding, 0)), "_t": F.sum("_d").over(Window.partitionBy(key))})
    pairs = puncta.join(arc.select(key, F.col("y").alias("_y"), F.col("x").alias("_x"), F.try_divide("_s", "_t").alias("_f"), F.col("i").alias("_i")), key)
    d = distance(F.col("y_px"), F.col("x_px"), F.col("_y"), F.col("_x"))
    return pairs.groupBy(key, "punctum_id").agg(F.min(F.struct(d.alias("d"), F.col("_i").alias("i"), F.col("_f").alias("f"))).alias("_b")).select(key, "punctum_id", F.col("_b.f").alias("axial_s"), F.col("_b.d").alias("radial_r"))


def length_bins(df: DataFrame, length: str, value: str, bins: int = 5) -> DataFrame:
    """Median of a value in quantile bins of length, bins half open."""
    edges = percentiles(df, [], length, [i / bins for i in range(1, bins)], "_e")
    at = df.join(F.broadcast(edges), how="cross").withColumn("bin", F.size(F.filter("_e", lambda e: e <= F.col(length))))
    return at.groupBy("bin").agg(F.count("*").alias("n"), F.median(value).alias("median"))


def random_forest(training: DataFrame, features: list[str], label: str, trees: int = 100, seed: int = 0, scale: bool = False):
    """A fitted random forest over named features; what is no number counts as 0."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    stages = [VectorAssembler(inputCols=features, outputCol="_raw" if scale else "features")]
    if scale:
        stages.append(StandardScaler(inputCol="_raw", outputCol="features", withMean=True))
    stages.append(RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, seed=seed))
    return Pipeline(stages=stages).fit(finite_features(training, features))


def finite_features(df: DataFrame, features: list[str]) -> DataFrame:
    def clean(c: str):
        v = F.col(c).cast("double")
        return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), 0.0).otherwise(v)

    return df.withColumns({c: clean(c) for c in features})


def forest_predict(model, target: DataFrame, features: list[str], probability: bool = False) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    out = model.transform(finite_features(target, features))
    return out.withColumn("probability", vector_to_array("probability")) if probability else out.drop("probability", "rawPrediction", "features")
