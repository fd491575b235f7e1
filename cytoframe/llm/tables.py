"""Small helpers that every text operator shares."""

from __future__ import annotations

import contextlib
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``: the fold of a row."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def hash_share(column: str, seed: int) -> Column:
    """A reproducible number in [0, 1) for each id, for bounded samples of labelled rows."""
    return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(1 << 30)).cast("double") / float(1 << 30)


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``.

    Only a local session that names none, as in tests, has it below Spark's warehouse.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("a cluster's session has to name its shared folder in spark.checkpoint.dir")
    return named or spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints"


_MADE = threading.local()


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def written(df: DataFrame) -> DataFrame:
    """The same rows, from a Parquet table in the shared folder.

    The table may hold texts as they came: it goes when the driver ends, or
    earlier where its maker knows that nothing reads it any more (`tables_made`).
    """
    spark = df.sparkSession
    folder = f"{scratch_folder(spark)}/table-{uuid.uuid4().hex}"
    files, path = _path(spark, folder)
    try:
        df.write.parquet(folder)
    finally:
        if files.exists(path):
            files.deleteOnExit(path)
    for made in getattr(_MADE, "lists", []):
        made.append(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextlib.contextmanager
def tables_made(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the tables that `written` made within it in this thread."""
    made: list[str] = []
    _MADE.lists = [*getattr(_MADE, "lists", []), made]
    try:
        yield
    finally:
        _MADE.lists = [x for x in _MADE.lists if x is not made]
        for folder in made:
            files, path = _path(spark, folder)
            files.delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with files in the shared folder, which survive the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(scratch_folder(spark))
    return df.checkpoint(eager=True)


def spread_join(left: DataFrame, right: DataFrame, key: str, counts: DataFrame | None = None, most_hot: int = 100_000, least: int = 512, most_rows: int = 16) -> DataFrame:
    """All rows of ``left``, with the other columns of ``right`` where its ``key`` is found, and ``matched``.

    Keys of more than ``least`` left rows are hot; where there are more than
    ``most_hot`` such keys, those of twice as many rows, and so on.  The right
    rows of the hot keys that have up to ``most_rows`` of them are broadcast,
    which bounds what is broadcast whatever the size of the tables, and the left
    rows of these keys are dealt over all tasks by a hash of the whole row.
    ``counts`` (key, n) are the sizes of the left groups where they are known.
    """
    others = [c for c in right.columns if c != key]
    if counts is None:
        counts = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > least)
    while (n_hot := counts.where(F.col("n") > least).count()) > most_hot:
        least *= 2
    if not n_hot:
        return left.join(right.withColumn("_found", F.lit(True)), key, "left").select(*left.columns, *others, F.coalesce("_found", F.lit(False)).alias("matched"))
    hot_keys = F.broadcast(checkpointed(counts.where(F.col("n") > least).select(key)))
    of_hot = right.join(hot_keys, key, "left_semi")
    few = of_hot.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") <= most_rows).select(key)
    rows = F.struct(*[F.col(c) for c in others], F.lit(True).alias("_found"))
    lists = checkpointed(of_hot.join(few, key, "left_semi").groupBy(key).agg(F.collect_list(rows).alias("_hot")))
    # The salt of the cold rows is always 0, in a form that the optimiser does not fold: a constant would be no join key.
    cold_salt = F.pmod(F.xxhash64(key), F.lit(1)).alias("_salt")
    marked = left.join(F.broadcast(lists), key, "left").withColumn("_salt", F.when(F.col("_hot").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(1 << 30))))
    joined = marked.join(right.join(F.broadcast(lists.select(key)), key, "left_anti").select(F.col(key), rows.alias("_cold"), cold_salt), [key, "_salt"], "left")
    flat = joined.select(*left.columns, F.explode(F.coalesce("_hot", F.array("_cold"))).alias("_h"))
    return flat.select(*left.columns, *[F.col(f"_h.{c}").alias(c) for c in others], F.coalesce("_h._found", F.lit(False)).alias("matched"))
