"""Readers and writers of the engine's tables: declared schemas, one writer for each export."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytoframe import schemas
from cytoframe.functions.identity import redacted


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_skip_list(spark: SparkSession, path: str) -> DataFrame:
    """(token) of a text file: comments and blank lines do not count, repeats once."""
    token = F.trim(F.regexp_replace("value", "#.*$", ""))
    return spark.read.text(path).select(token.alias("token")).where("token <> ''").distinct()


def append_skip_list(spark: SparkSession, path: str, tokens: DataFrame, comment: str = "") -> list[str]:
    """Append the tokens that a skip list lacks, below a dated comment; gives them."""
    clean = tokens.select(F.trim("token").alias("token")).where("token <> ''").distinct()
    new = clean.join(read_skip_list(spark, path), "token", "left_anti").orderBy("token")
    rows = [r.token for r in new.collect()]  # an operator's own list, typed by hand
    if rows:
        head = spark.range(1).select(F.concat(F.lit(f"# {comment} "), F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")).alias("value"))
        head.union(spark.createDataFrame([(r,) for r in rows], "value string")).coalesce(1).write.mode("append").text(path)
    return rows


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Per-image JSON documents, each with its cells."""
    return spark.read.schema(schemas.METADATA).json(path, multiLine=True)


def flatten_cells(documents: DataFrame) -> DataFrame:
    """One row for each cell of JSON documents: boxes and centroids in columns, reasons in one text, intensities by channel as a map."""
    c = F.col("c")
    metrics = [f.name for f in schemas.CELL["metrics"].dataType if f.name not in ("intensity", "area")]
    return documents.select("image_id", "source_path", F.explode("cells").alias("c")).select(
        "image_id", "source_path", c["label"].alias("label"),
        F.coalesce(c["cell_id"], F.concat_ws("_", "image_id", c["label"].cast("string"))).alias("cell_id"),
        *[c[x].alias(x) for x in ("included", "override", "note", "touching_edge", "is_central", "distance_to_center_px")],
        F.array_join(c["failure_reasons"], "; ").alias("failure_reasons"),
        *[F.get(c["bbox"], i).alias(f"bbox_{x}") for i, x in enumerate(("x1", "y1", "x2", "y2"))],
        *[F.get(c["centroid"], i).alias(f"centroid_{x}") for i, x in enumerate("yx")],
        c["metrics"]["area"].alias("area"), *[c["metrics"][x].alias(x) for x in metrics], c["metrics"]["intensity"].alias("intensity"),
    )


def with_intensity_columns(cells: DataFrame, channels: list[str]) -> DataFrame:
    return cells.select(*[x for x in cells.columns if x != "intensity"], *[F.element_at("intensity", F.lit(ch)).alias(f"intensity_{ch}") for ch in channels])


def cell_table(spark: SparkSession, csv_path: str | None, json_path: str | None, schema: T.StructType | str) -> DataFrame | None:
    """The table of a batch: its CSV if that has rows, else its JSON documents, else none."""
    if csv_path:
        table = read_csv(spark, csv_path, schema)
        if table.take(1):
            return table
    return flatten_cells(read_metadata(spark, json_path)) if json_path else None


def by_label(cells: Column) -> Column:
    """Structs by their label; other fields may be of types without an order."""
    return F.array_sort(cells, lambda a, b: F.when(a["label"] < b["label"], -1).when(a["label"] > b["label"], 1).otherwise(0))


def metadata_documents(cells: DataFrame, image_columns: tuple[str, ...] = ("image_id", "source_path")) -> DataFrame:
    """One document for each image: its counts and its cells, sorted by label."""
    own = [c for c in cells.columns if c not in image_columns]
    return cells.groupBy(*image_columns).agg(F.count("*").alias("n_cells_total"), F.count_if("included").alias("n_cells_filtered"), by_label(F.collect_list(F.struct("label", *[c for c in own if c != "label"]))).alias("cells"))


def first_existing(candidates: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """For each key the candidate path of the lowest rank that exists: candidates (key, rank, path), listing (path)."""
    return candidates.join(listing.select("path").distinct(), "path", "left_semi").groupBy(key).agg(F.min_by("path", "rank").alias("path"))


def image_candidates(images: DataFrame, folder: str, extensions: tuple[str, ...] = (".tif", ".tiff", ".png")) -> DataFrame:
    """(image_id, rank, path): where an image may lie, in the order of preference."""
    names = F.array(F.col("source_path"), F.concat(F.lit(folder + "/"), F.element_at(F.split("source_path", "/"), -1)), *[F.concat(F.lit(folder + "/"), "image_id", F.lit(x)) for x in extensions])
    return images.select("image_id", F.posexplode(names).alias("rank", "path")).where("path is not null")


def annotation_maps(annotations: DataFrame) -> DataFrame:
    """(image_id, notes, overrides) of JSON texts: labels to notes, and to include or exclude alone."""
    parsed = annotations.select("image_id", F.from_json("json", "cell_notes map<string,string>, cell_overrides map<string,string>").alias("j"))
    clean = F.transform_values(F.coalesce("j.cell_overrides", F.create_map().cast("map<string,string>")), lambda _, v: F.lower(F.trim(v)))
    notes = F.map_filter(F.transform_values(F.coalesce("j.cell_notes", F.create_map().cast("map<string,string>")), lambda _, v: F.trim(v)), lambda _, v: v != "")
    return parsed.select("image_id", notes.alias("notes"), F.map_filter(clean, lambda _, v: v.isin("include", "exclude")).alias("overrides"))


def union_shards(shards: list[DataFrame]) -> DataFrame:
    """All shards' rows; columns that some lack are null there."""
    if not shards:
        raise ValueError("there are no shards to merge")
    out = shards[0]
    for s in shards[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def write_by_key(df: DataFrame, path: str, *keys: str) -> None:
    """Parquet in a folder for each key, each key's rows together before they are written."""
    df.repartition(*keys).write.mode("overwrite").partitionBy(*keys).parquet(path)


def well_of(name) -> Any:
    """The well in a file name: its second token from the fifth character on."""
    return F.substring(F.get(F.split(name, "_"), F.lit(1)), 5, 1 << 20)


def run_metadata(config: dict, inputs: list[str], run_hash: str, seed: int | None = None, artifacts: dict | None = None) -> str:
    """A run's record as JSON, without secrets."""
    import platform

    import pyspark

    return json.dumps({"config": redacted(config), "inputs": inputs, "seed": seed, "run_hash": run_hash, "artifacts": artifacts or {}, "versions": {"python": platform.python_version(), "pyspark": pyspark.__version__}}, sort_keys=True, default=str)


def post(url: str, text: str, timeout_s: float = 5.0) -> bool:
    """Send a text to a web hook; a failure of the network is no error of the run."""
    import urllib.error
    import urllib.request

    try:
        request = urllib.request.Request(url, json.dumps({"text": text}).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout_s) as answer:
            return 200 <= answer.status < 300
    except (urllib.error.URLError, OSError, ValueError):
        return False


