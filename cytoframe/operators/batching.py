"""Batches, shards, skip lists and samples of images."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.functions.identity import basename, stem


def ranked(df: DataFrame, *order: str, name: str = "i") -> DataFrame:
    """Numbers from 0 in an order, without a single task that holds all rows.

    Rows are sorted by ranges; each range's size gives where its numbers start.
    Only one number a range, of as many as there are partitions, is broadcast.
    """
    from cytoframe.plans.checkpoints import checkpointed

    sorted_ = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    sizes = sorted_.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_start")
    within = Window.partitionBy("_part").orderBy("_row")
    return sorted_.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.row_number().over(within) - 1).drop("_part", "_row", "_start")


def round_robin(images: DataFrame, n: int, path: str = "path", skip: DataFrame | None = None) -> DataFrame:
    """(batch, source_path, link_path): image i of the sorted list goes to batch (i mod n) + 1.

    Skipped images keep their numbers, so that the others' batches do not move;
    of equal names in a batch all but the first get a digest of their path.
    """
    if n < 1:
        raise ValueError("batches start at 1")
    dealt = ranked(images.select(F.col(path).alias("source_path")), "source_path").withColumn("batch", F.concat(F.lit("batch"), F.col("i") % n + 1))
    if skip is not None:
        dealt = not_skipped(dealt, skip, "source_path")
    again = F.row_number().over(Window.partitionBy("batch", "name").orderBy("source_path")) > 1
    named = dealt.withColumn("name", basename(F.col("source_path")))
    unique = F.when(again, F.concat(stem(F.col("name")), F.lit("_"), F.substring(F.sha1(F.col("source_path")), 1, 8), F.regexp_extract("name", r"(\.[^.]*)?$", 0))).otherwise(F.col("name"))
    return named.select("batch", "source_path", F.concat("batch", F.lit("/"), unique).alias("link_path"))


def manifest_is_current(manifest: DataFrame, images: DataFrame) -> bool:
    """Whether a manifest lists exactly these images."""
    a, b = manifest.select("source_path").distinct(), images.select("source_path").distinct()
    return not a.exceptAll(b).take(1) and not b.exceptAll(a).take(1)


def not_skipped(images: DataFrame, skip: DataFrame, path: str = "source_path") -> DataFrame:
    """Images whose name, stem and whole path are not in a skip list."""
    keyed = images.select(path, F.explode(F.array_distinct(F.array(basename(F.col(path)), stem(F.col(path)), F.col(path)))).alias("token"))
    skipped = keyed.join(skip.select("token").distinct(), "token", "left_semi").select(path).distinct()
    return images.join(skipped, path, "left_anti")


def parse_shard(spec: str) -> tuple[int, int]:
    """(k, n) of a text "k/n"."""
    m = re.fullmatch(r"\s*(\d+)\s*/\s*(\d+)\s*", spec)
    if not m or not int(m[1]) < int(m[2]):
        raise ValueError(f"not a shard: {spec!r}")
    return int(m[1]), int(m[2])


def stride_shard(df: DataFrame, spec: str, *order: str) -> DataFrame:
    """Every n-th row of an order, from the k-th on."""
    k, n = parse_shard(spec)
    return ranked(df, *order).where(F.col("i") % n == k).drop("i")


def contiguous_chunks(df: DataFrame, n: int, *order: str, name: str = "chunk") -> DataFrame:
    """``n`` runs of an order, equal but for one row, the longer ones first; numbered from 1."""
    total = df.count()
    small, larger = divmod(total, n)
    cut = larger * (small + 1)
    i = F.col("i")
    chunk = F.when(i < cut, F.floor(i / (small + 1))).otherwise(larger + F.floor((i - cut) / max(small, 1))) + 1
    return ranked(df, *order).withColumn(name, chunk.cast("int")).drop("i")


def portable_hash(key: Column, seed: int = 0) -> Column:
    """32 bits of a digest of a key as text: the same number in any engine that knows md5."""
    text = F.concat_ws("/", F.lit(str(seed)), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_split(key: Column, train: int = 80, validation: int = 10) -> Column:
    """train, val or test by a hash of the key, the same in every run."""
    bucket = portable_hash(key) % 100
    return F.when(bucket < train, "train").when(bucket < train + validation, "val").otherwise("test")


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """A reproducible sample of ``n`` rows, by a hash of their keys."""
    return df.orderBy(portable_hash(F.col(key), seed), key).limit(n)


def rank_groups(df: DataFrame, n_groups: int, *order: str, name: str = "group") -> DataFrame:
    """Equal groups of consecutive ranks around the middle; what is left at both ends, and the last row, is in none."""
    total = df.count()
    size = (total - 1) // n_groups if total else 0
    offset = (total - 1 - size * n_groups) // 2 if total else 0
    group = F.floor((F.col("i") - offset) / max(size, 1)).cast("int")
    return ranked(df, *order).where((F.col("i") >= offset) & (F.col("i") < offset + size * n_groups)).withColumn(name, group).drop("i")


def expected_minus_done(expected: DataFrame, done: DataFrame, errors: DataFrame | None = None, logs: DataFrame | None = None, default: str = "no output") -> DataFrame:
    """(batch, image_id, reason) of images without output: the image's own error, else its batch's log, else a default."""
    missing = expected.join(done.select("image_id").distinct(), "image_id", "left_anti")
    reasons = []
    if errors is not None:
        missing = missing.join(errors.groupBy("image_id").agg(F.first("error", ignorenulls=True).alias("_e")), "image_id", "left")
        reasons.append(F.nullif("_e", F.lit("")))
    if logs is not None:
        missing = missing.join(logs.select("batch", F.col("reason").alias("_l")), "batch", "left")
        reasons.append(F.nullif("_l", F.lit("")))
    return missing.select("batch", "image_id", F.coalesce(*reasons, F.lit(default)).alias("reason"))
