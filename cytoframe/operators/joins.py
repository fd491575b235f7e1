"""Joins of cells with crops, classes, masks and tables that exist already, and the cell lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe import schemas
from cytoframe.functions.identity import basename, cell_hash, filename_metadata
from cytoframe.operators.filtering import filter_classified
from cytoframe.operators.labels import apply_registry, with_key


def _renamed(df: DataFrame, other: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c in other.columns and c not in keys})


def join_crops(cells: DataFrame, crops: DataFrame) -> DataFrame:
    """Cells with their crops by image and label; the crop's id counts, its other clashing columns get ``_crop``."""
    left = cells.drop("Cell_ID").withColumn("label", F.col("label").cast("int"))
    right = _renamed(crops.withColumn("label", F.col("label").cast("int")), left, ["image_id", "label"], "_crop")
    return left.join(right, ["image_id", "label"])


def join_classes(cells: DataFrame, classes: DataFrame) -> DataFrame:
    """Cells with their classifier's rows, where there are any; clashing columns get ``_unet``."""
    return cells.join(_renamed(classes, cells, ["Cell_ID"], "_unet"), "Cell_ID", "left")


def finalize(cells: DataFrame, crops: DataFrame, classes: DataFrame | None = None, registry: DataFrame | None = None, threshold: float = 0.5, keep_class: str | None = "cell", how: str = "left") -> DataFrame:
    """Cells that have a crop and pass the classifier, with their labels."""
    out = join_crops(cells, crops)
    if classes is not None:
        out = filter_classified(join_classes(out, classes), threshold, keep_class)
    if registry is not None:
        out = apply_registry(with_key(out, "source_path"), registry, how)
    return out


def passed_crops(mapping: DataFrame, passed: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """Mapping rows of cells that passed and whose crop exists."""
    out = mapping.join(passed.where("filter_passed").select("Cell_ID").distinct(), "Cell_ID", "left_semi")
    return out if listing is None else out.join(listing.select(F.col("path").alias("crop_path")).distinct(), "crop_path", "left_semi")


def masks_with_images(masks: DataFrame, metadata: DataFrame, images: DataFrame, key: str = "image_id") -> DataFrame:
    """Documents that have a mask and an image, by name; a row for each included cell."""
    kept = metadata.withColumn("cells", F.filter("cells", lambda c: c["included"]))
    return kept.join(masks, key).join(images, key).select("*", F.explode("cells").alias("cell")).drop("cells")


def session_cells(metadata: DataFrame, annotations: DataFrame, masks: DataFrame, images: DataFrame, included_only: bool = True, central_only: bool = False) -> DataFrame:
    """Reviewed cells: documents with masks and images, their reviewers' notes, and what they left in.

    Documents are read once: each is cut down to its central cells before it is joined.
    """
    from cytoframe.operators.filtering import apply_annotations, central_label
    from cytoframe.sources.tables import flatten_cells

    if central_only:
        central = central_label(F.col("central_label"), F.col("cells"))
        # As the one element of an array: found once for a document, not once for each of its cells.
        metadata = metadata.withColumn("cells", F.get(F.transform(F.array(central), lambda k: F.filter("cells", lambda c: c["label"] == k)), F.lit(0)))
    ready = metadata.join(masks.select("image_id").distinct(), "image_id", "left_semi").join(images.select("image_id").distinct(), "image_id", "left_semi")
    cells = apply_annotations(flatten_cells(ready), annotations)
    return cells.where("included") if included_only else cells


def merge_existing(existing: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("cell_id",)) -> DataFrame:
    """Rows of two tidy tables; of a cell that both have, the existing rows count."""
    ids = existing.select(*keys).distinct()
    return existing.unionByName(new.join(ids, list(keys), "left_anti"), allowMissingColumns=True)


def duplicates(existing: DataFrame, new: DataFrame, key: str = "cell_id") -> DataFrame:
    return existing.select(key).intersect(new.select(key))


def union_batches(batches: dict[str, DataFrame], sources: DataFrame | None = None) -> DataFrame:
    """All batches' cells with their batch; paths of links become those of their sources."""
    out = None
    for name, table in batches.items():
        named = table.withColumn("batch", F.lit(name))
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    if out is None:
        raise ValueError("there are no batches")
    if sources is not None:
        links = sources.select(F.col("link_path").alias("_link"), F.col("source_path").alias("_source"))
        out = out.join(links, F.col("source_path") == F.col("_link"), "left").withColumn("source_path", F.coalesce("_source", "source_path")).drop("_link", "_source")
    return out


def batch_summary(compiled: DataFrame) -> DataFrame:
    return compiled.groupBy("batch").agg(F.count("*").alias("n_cells"), F.count_if("included").alias("n_included"), F.count_distinct("image_id").alias("n_images"))


def lookup_rows(cells: DataFrame, source: str = "source_path", label: str = "mask_label", bbox: tuple[str, ...] = schemas.BBOX, prefix: str = "sc_") -> DataFrame:
    """Cells as rows of the lookup: identity, place and what the file name tells."""
    digest = cell_hash(F.col(source), F.col(label), [F.col(b) for b in bbox])
    meta = filename_metadata(basename(F.col(source)))
    made = cells.select(
        F.concat(F.lit(prefix), digest).alias("cell_id"), digest.alias("hash"), F.col(source).alias("source_path"), basename(F.col(source)).alias("source_filename"), F.col(label).cast("int").alias("mask_label"),
        *[F.coalesce(F.col(b).try_cast("int"), F.lit(0)).alias(s) for b, s in zip(bbox, schemas.BBOX, strict=True)], meta["plate"].alias("plate"), meta["scene"].alias("scene"), meta["position"].alias("position"), F.current_timestamp().alias("created_at"),
    )
    return made


def add_cells(lookup: DataFrame, cells: DataFrame) -> DataFrame:
    """A lookup with more cells; columns of either are kept."""
    return lookup.unionByName(cells, allowMissingColumns=True)


def find_cell(lookup: DataFrame, cell: str) -> DataFrame:
    """The first row whose id or hash this is."""
    return lookup.where((F.col("cell_id") == cell) | (F.col("hash") == cell)).limit(1)


def has_cell(lookup: DataFrame, cell: str) -> bool:
    return bool(find_cell(lookup, cell).take(1))


def cells_of(lookup: DataFrame, plate: str, scene: str | None = None) -> DataFrame:
    out = lookup.where(F.col("plate") == plate)
    return out if scene is None else out.where(F.col("scene") == scene)


def siblings(files: DataFrame, known: list[str], phase: str = "Phase") -> DataFrame:
    """(dir, base, channel, path): the channels of each image, by its folder and the base of its name.

    A channel that is not known is what follows a phase image's base; masks are
    no channels; of several files of a channel the first by path counts.
    """
    from cytoframe.functions.identity import channel_token, is_channel, stem

    named = files.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("dir"), stem(F.col("path")).alias("stem"))
    parsed = named.withColumn("t", channel_token(F.col("stem"), known, phase)).select("path", "dir", "stem", "t.channel", "t.base")
    bases = parsed.where(F.col("channel") == phase).select("dir", "base").distinct()
    exact = parsed.where(F.col("channel").isNotNull()).join(bases, ["dir", "base"], "left_semi").select("dir", "base", "channel", "path")
    # What stands before the last separator may be a base: an equality, not a prefix test, joins it.
    loose = parsed.where(F.col("channel").isNull()).select("dir", "path", F.regexp_extract("stem", "^(.*)_([^_]+)$", 1).alias("base"), F.regexp_extract("stem", "^(.*)_([^_]+)$", 2).alias("channel"))
    loose = loose.join(bases, ["dir", "base"], "left_semi").where(is_channel(F.col("channel"), phase)).select("dir", "base", "channel", "path")
    return exact.union(loose).groupBy("dir", "base", "channel").agg(F.min("path").alias("path"))


def channel_paths(images: DataFrame, found: DataFrame, wanted: list[str], phase: str = "Phase", available: bool = True) -> DataFrame:
    """(image_id, channel, path, rank): phase, the wanted channels, then all others by name; null where one is missing."""
    order = F.create_map(*[F.lit(x) for i, c in enumerate(dict.fromkeys([phase, *wanted])) for x in (c, i)])
    named = images.join(found, ["dir", "base"])
    listed = images.select("image_id", "dir", "base", F.explode(F.array(*[F.lit(c) for c in dict.fromkeys([phase, *wanted])])).alias("channel"))
    asked = listed.join(found, ["dir", "base", "channel"], "left").select("image_id", "channel", "path")
    rest = named.where(F.element_at(order, F.col("channel")).isNull()).select("image_id", "channel", "path")
    return (asked.union(rest) if available else asked).withColumn("rank", F.coalesce(F.element_at(order, F.col("channel")), F.lit(1 << 20)))


def resolve_channel(*candidates: Column) -> Column:
    """The first path that exists; an error where none does."""
    return F.coalesce(*candidates, F.raise_error(F.lit("no file of this channel was found")).cast("string"))
