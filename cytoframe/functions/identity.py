"""Identity, path and text expressions: every function takes and gives columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECRET_WORDS = ("secret", "password", "token", "api_key")


def basename(path: Column) -> Column:
    return F.substring_index(F.substring_index(path, "/", -1), "\\", -1)


def stem(path: Column) -> Column:
    """The last part of a path without its last extension."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def _digest(parts: list[Column], length: int) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, length)


def _text(*columns: Column) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in columns])


def cell_hash(source_path: Column, label: Column, bbox: list[Column], length: int = 16) -> Column:
    """Identity by file name: the digest of name, label and bounding box."""
    return _digest([basename(source_path), label.cast("string"), _text(*bbox)], length)


def cell_id(source_path: Column, label: Column, bbox: list[Column], prefix: str = "sc_") -> Column:
    return F.concat(F.lit(prefix), cell_hash(source_path, label, bbox))


def ucid(source_path: Column, label: Column, bbox: list[Column], prefix: str = "m2_") -> Column:
    return cell_id(source_path, label, bbox, prefix)


def crop_hash(run_hash: Column, source_path: Column, label: Column, bbox: list[Column]) -> Column:
    """Identity within a segmentation run: the whole path counts, and the run."""
    return _digest([run_hash, source_path, label.cast("string"), _text(*bbox)], 16)


def metadata_hash(image_id: Column, label: Column, row: Column, col: Column) -> Column:
    """Identity where no box is known; centroids round half to even."""
    return _digest([image_id, label.cast("string"), _text(F.bround(row, 0).cast("long"), F.bround(col, 0).cast("long"))], 16)


def apply_ucids(cells: Column, source_path: Column, prefix: str = "m2_") -> Column:
    """An array of cell structs, each with ucid where it has a label and a box of four numbers."""

    def one(c: Column) -> Column:
        box = [F.get(c["bbox"], i) for i in range(4)]
        fit = c["label"].isNotNull() & (F.size(c["bbox"]) == 4) & ~F.exists(c["bbox"], lambda v: v.isNull())
        return c.withField("ucid", F.when(fit, ucid(source_path, c["label"], box, prefix)))

    return F.transform(cells, one)


def ensure_ids(cells: DataFrame, source: str = "source_path", label: str = "label", bbox: tuple[str, ...] = ("bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2")) -> DataFrame:
    """``cells`` with Cell_ID, made from the identity hash where it is missing or empty."""
    made = cell_id(F.col(source), F.col(label), [F.col(b) for b in bbox])
    given = F.nullif("Cell_ID", F.lit("")) if "Cell_ID" in cells.columns else F.lit(None).cast("string")
    return cells.withColumn("Cell_ID", F.coalesce(given, made))


def ensure_provenance(cells: DataFrame, run_hash: str, phase: str = "Phase") -> DataFrame:
    """Fill cell_hash, segmentation_run_hash and source_image where they are null or empty."""

    def filled(name: str, value: Column) -> Column:
        return F.coalesce(F.nullif(name, F.lit("")), value) if name in cells.columns else value

    image = F.nullif("image_id", F.lit("")) if "image_id" in cells.columns else F.lit(None).cast("string")
    source = F.regexp_replace(F.coalesce(image, stem(F.col("source_path"))), f"_{phase}$", "")
    return cells.withColumns(
        {
            "cell_hash": filled("cell_hash", F.concat(F.lit("sha256:"), F.regexp_replace("Cell_ID", "^sc_", ""))),
            "segmentation_run_hash": filled("segmentation_run_hash", F.lit(run_hash)),
            "source_image": filled("source_image", source),
        }
    )


def strip_hash(value: Column) -> Column:
    return F.regexp_replace(value, "^sha256:", "")


def filename_metadata(filename: Column) -> Column:
    """plate, scene and position of a file name, UNK where it does not tell.

    The plate is the token of four digits right after the first one of six; the
    scene is the first ``s`` and digits, the position the first ``m`` and digits.
    """
    name = stem(filename)

    def told(pattern: str) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(name, f"(?:^|_){pattern}", 1), F.lit("")), F.lit("UNK"))

    # The first token of six digits decides, whatever follows it: the group is empty where that is no token of four.
    plate = told(r"[0-9]{6}(?:_(?:([0-9]{4})(?=_|\z))?|\z)")
    return F.struct(plate.alias("plate"), told(r"s([0-9]+)(?:_|\z)").alias("scene"), told(r"m([0-9]+)(?:_|\z)").alias("position"))


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+?^$|" else c for c in text)


def channel_token(name: Column, known: list[str], phase: str | None = "Phase") -> Column:
    """(channel, base) of a stem: the rightmost known channel after ``_`` that a separator or the end follows.

    The longer of two at one place wins.  Without one, a final ``_<phase>`` is
    the channel; without that it is null and the base is the stem.
    """
    found = F.lit(None).cast("struct<channel:string,base:string>")
    if phase:
        suffix = f"_{phase}"
        found = F.when(F.endswith(name, F.lit(suffix)), F.struct(F.lit(phase).alias("channel"), F.substring(name, F.lit(1), F.length(name) - len(suffix)).alias("base")))
    if names := sorted({k for k in known if k}, key=lambda k: (-len(k), k)):
        pattern = rf"(?s)^(.*)_({'|'.join(map(_quoted, names))})(?=[_ .]|$)"
        hit = F.struct(F.regexp_extract(name, pattern, 2).alias("channel"), F.regexp_extract(name, pattern, 1).alias("base"))
        found = F.when(name.rlike(pattern), hit).otherwise(found)
    return F.coalesce(found, F.struct(F.lit(None).cast("string").alias("channel"), name.alias("base")))


def is_channel(name: Column, phase: str = "Phase") -> Column:
    """Whether a token can name a channel: not empty, not phase, no mask."""
    lower = F.lower(F.trim(name))
    return (lower != "") & (lower != phase.lower()) & (lower != "mask") & ~F.endswith(lower, F.lit("_mask"))


def pad_number(value: Column, width: int) -> Column:
    """Zeros before a number up to a width; longer ones stay whole."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def review_status(status: Column) -> Column:
    clean = F.lower(F.trim(status))
    return F.when(clean == "pass", "cell").when(clean == "fail", "no_cell").when(clean == "discarded", "discard").otherwise(clean)


#: Other names of channels, and names by place where none is given.
CHANNEL_ALIASES = {"hada": "AF405", "dapi": "AF405", "af405": "AF405", "bodipy": "Bod493", "bod493": "Bod493", "phase": "Phase"}
CHANNEL_DEFAULTS = ["Phase", "AF405", "Bod493"]


def canonical_channels(names: Column, count: int) -> Column:
    """Exactly ``count`` channel names: aliases resolved, gaps filled by place."""
    alias = F.create_map(*[F.lit(x) for pair in CHANNEL_ALIASES.items() for x in pair])
    defaults = F.array(*[F.lit(x) for x in [*CHANNEL_DEFAULTS, *[f"Channel{i}" for i in range(len(CHANNEL_DEFAULTS), count)]][:count]])
    given = F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda x: F.coalesce(F.element_at(alias, F.lower(F.trim(x))), F.trim(x)))
    return F.transform(defaults, lambda d, i: F.coalesce(F.nullif(F.get(given, i), F.lit("")), d))


def as_bool(value: Column) -> Column:
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin("true", "1", "1.0", "yes", "y"), F.lit(False))


def regex_first(value: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(value, pattern, 1), F.lit(""))


def job_name(name: Column) -> Column:
    return F.substring(F.regexp_replace(name, "[^A-Za-z0-9_.-]+", "_"), 1, 128)


def slug(value: Column, default: str = "run") -> Column:
    return F.coalesce(F.nullif(F.btrim(F.regexp_replace(value, "[^A-Za-z0-9_.-]+", "_"), F.lit("._")), F.lit("")), F.lit(default))


def transient_submit_error(text: Column) -> Column:
    return F.lower(text).rlike("timed out|temporarily unavailable|connection refused|unable to contact|socket|try again")


def stamp(at: Column) -> Column:
    return F.date_format(at, "dd/MM/yyyy HH:mm:ss")


def numbers_in(text: Column, width: int = 6) -> Column:
    """Rows of ``width`` numbers that a text lists one after another."""
    listed = F.regexp_extract_all(text, F.lit(r"[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?"), F.lit(0))

    def rows(values: Column) -> Column:
        n = F.floor(F.size(values) / width).cast("int")
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(values, i * width + 1, width))).otherwise(F.array().cast("array<array<double>>"))

    # As the one element of an array: a variable, read once, where a column would be worked out anew for each row.
    values = F.filter(F.transform(listed, lambda v: v.try_cast("double")), lambda v: v.isNotNull())
    return F.get(F.transform(F.array(values), rows), F.lit(0))


def redacted(config: object) -> object:
    """A nested configuration whose secrets are masked, whatever holds them."""
    if isinstance(config, dict):
        return {k: "<redacted>" if any(w in str(k).lower() for w in SECRET_WORDS) else redacted(v) for k, v in config.items()}
    return [redacted(v) for v in config] if isinstance(config, (list, tuple)) else config


#: A name with one of the words, an equals sign or colon, and what follows: a quoted text or one without spaces.
#: It is looked for where a name starts, not at each of its characters.
_ASSIGNED_SECRET = rf"""((?<![A-Za-z0-9_])[A-Za-z0-9_]*(?i:{"|".join(SECRET_WORDS)})[A-Za-z0-9_]*[ \t]*[=:][ \t]*)("[^"\n]*"|'[^'\n]*'|[^ \t\n\r"']+)"""


def _may_have_secrets(text: Column) -> Column:
    """Whether one of the words occurs at all, which most texts answer without the pattern."""
    lower = F.lower(text)
    return reduce(lambda a, b: a | b, [F.contains(lower, F.lit(w)) for w in SECRET_WORDS])


def redacted_text(text: Column) -> Column:
    """A text in which the values that are assigned to secrets are masked; the names stay."""
    return F.when(_may_have_secrets(text), F.regexp_replace(text, _ASSIGNED_SECRET, "$1<redacted>")).otherwise(text)


def count_secrets(text: Column) -> Column:
    return F.when(_may_have_secrets(text), F.regexp_count(text, F.lit(_ASSIGNED_SECRET))).otherwise(F.when(text.isNotNull(), 0))


def diagnose_log(text: Column) -> Column:
    """Why a job's log says it ended: out of memory, time, its last error line, or null."""
    return F.when(F.lower(text).rlike("oom[- ]?kill|out of memory|memoryerror"), "out of memory").when(F.lower(text).rlike("due to time limit|timelimit"), "time limit").otherwise(F.try_element_at(F.regexp_extract_all(text, F.lit(r"(?m)^([A-Za-z_.]+(?:Error|Exception)\b.*)$"), F.lit(1)), F.lit(-1)))
