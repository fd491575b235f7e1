"""Registry of the engine's queries over the driver's tables, each with its SQL where SQL can say it.

Roles: ``lineitem`` is a cell table (image l_orderkey, label l_linenumber, made
unique by part and supplier), ``part`` a label registry, ``orders`` a list of
images, ``embeddings`` 8 x 8 image patches and 64-point profiles, ``events`` a
time series, ``documents`` and ``labels`` expected and finished work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytoframe import schemas
from cytoframe.functions import geometry as G
from cytoframe.functions import identity as ID
from cytoframe.functions import vectors as V
from cytoframe.operators import aggregates as A
from cytoframe.operators import batching as B
from cytoframe.operators import export as X
from cytoframe.operators import filtering as FL
from cytoframe.operators import joins as J
from cytoframe.operators import labels as L
from cytoframe.operators import pixels as P
from cytoframe.operators import segmentation as S
from cytoframe.operators import tracking as T
from cytoframe.plans import sweep as SW

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- roles -----------------------------------------------------------------

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *KEYS, F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("label"), F.col("l_quantity").alias("area_px"), F.col("l_discount").alias("aspect_ratio"),
        F.col("l_tax").alias("solidity"), (F.col("l_returnflag") != "R").alias("included"), F.col("l_extendedprice").alias("intensity"), "l_returnflag", "l_linestatus",
    )


CELLS_SQL = "cells AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_orderkey AS image_id, l_linenumber AS label, l_quantity AS area_px, l_discount AS aspect_ratio, l_tax AS solidity, l_returnflag <> 'R' AS included, l_extendedprice AS intensity, l_returnflag, l_linestatus FROM lineitem)"


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where("p_size <= 25").select(F.col("p_partkey").cast("string").alias("padmap_id"), F.col("p_brand").alias("padmap_drug"))


REGISTRY_SQL = "registry AS (SELECT CAST(p_partkey AS VARCHAR) AS padmap_id, p_brand AS padmap_drug FROM part WHERE p_size <= 25)"


def patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as pixels of 8 x 8 patches."""
    return P.unfold(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), "embedding"), ("image_id",), "embedding", 8)


PIXELS_SQL = "px AS (SELECT vec_id AS image_id, CAST((i - 1) // 8 AS INTEGER) AS y, CAST((i - 1) % 8 AS INTEGER) AS x, CAST(embedding[i] AS DOUBLE) AS value FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings))"


def halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mask pixels: bright ones, labelled by the half of the patch they lie in."""
    return patch(spark, sf_dir).where("value > 0").select("image_id", (F.floor(F.col("x") / 4) + 1).cast("int").alias("label"), "y", "x", "value")


MASK_SQL = PIXELS_SQL + ", mask AS (SELECT image_id, CAST(x // 4 + 1 AS INTEGER) AS label, y, x, value FROM px WHERE value > 0)"


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("p"))


POINTS_SQL = "pt AS (SELECT vec_id, CAST(i - 1 AS INTEGER) AS i, CAST(embedding[i] AS DOUBLE) AS v FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings))"


def rounded(df: DataFrame, digits: int = 6, **own: int) -> DataFrame:
    """Floats rounded once, each to its own number of digits."""
    return df.select(*[F.round(c, own.get(c, digits)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


# ---- flagship --------------------------------------------------------------


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells through rules, labels and numbering: each label's cells, their mean area and last id."""
    rules = {"area_px": {"min": 5, "max": 45}, "aspect_ratio": {"min": 0.01}, "l_linestatus": "O"}
    passed = FL.keep_passing(cells(spark, sf_dir), rules).withColumn("padmap_id", F.col("l_partkey").cast("string"))
    labelled = L.apply_registry(passed, registry(spark, sf_dir)).withColumn("Cell_ID", F.lit("sc_none"))
    numbered = L.numbered_ids(labelled, "drug", tuple(KEYS))
    n = F.substring_index("Cell_ID", "_", -1).try_cast("long")
    return numbered.groupBy("drug").agg(F.count("*").alias("n_cells"), F.round(F.avg("area_px"), 6).alias("mean_area"), F.coalesce(F.max(n), F.lit(0)).alias("last_number"))


query(f"""
WITH {CELLS_SQL}, {REGISTRY_SQL}, kept AS (
  SELECT *, CAST(l_partkey AS VARCHAR) AS padmap_id FROM cells WHERE included AND area_px BETWEEN 5 AND 45 AND aspect_ratio >= 0.01 AND l_linestatus = 'O'
), named AS (SELECT kept.*, coalesce(padmap_drug, 'UNK') AS drug FROM kept LEFT JOIN registry USING (padmap_id))
SELECT drug, count(*) AS n_cells, round(avg(area_px), 6) AS mean_area, CASE WHEN drug = 'UNK' THEN 0 ELSE count(*) END AS last_number FROM named GROUP BY drug
""")(flagship)


# ---- filters ---------------------------------------------------------------

RULES = {"rules": {"area": {"min": 10, "max": 40}, "aspect_ratio_min": 0.02, "l_linestatus": "O"}}
REASONS_SQL = """concat_ws(';', CASE WHEN NOT included THEN 'segmenter_excluded' END, CASE WHEN area_px < 10 THEN 'area_px:below_min' WHEN area_px > 40 THEN 'area_px:above_max' END,
  CASE WHEN aspect_ratio < 0.02 THEN 'aspect_ratio:below_min' END, CASE WHEN l_linestatus <> 'O' THEN 'l_linestatus:expected_O' END)"""


@query(f"WITH {CELLS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {REASONS_SQL} = '' AS filter_passed, {REASONS_SQL} AS filter_reasons, {REASONS_SQL} = '' AS included FROM cells")
def filter_rules_reasons(spark, sf_dir):
    return FL.filter_cells(cells(spark, sf_dir), RULES).select(*KEYS, "filter_passed", "filter_reasons", "included")


@query(f"WITH {CELLS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM cells WHERE {REASONS_SQL} = ''")
def filter_pushdown(spark, sf_dir):
    return FL.keep_passing(cells(spark, sf_dir), RULES).select(*KEYS)


@query(f"WITH {CELLS_SQL}, f AS (SELECT {REASONS_SQL} = '' AS ok FROM cells) SELECT count(*) AS n_cells, count(*) FILTER (ok) AS n_passed, count(*) FILTER (NOT ok) AS n_failed FROM f")
def filter_summary(spark, sf_dir):
    return FL.filter_summary(FL.filter_cells(cells(spark, sf_dir), RULES))


@query(f"WITH {CELLS_SQL}, f AS (SELECT unnest(string_split({REASONS_SQL}, ';')) AS reason FROM cells WHERE {REASONS_SQL} <> '') SELECT reason, count(*) AS n FROM f GROUP BY reason")
def filter_reason_counts(spark, sf_dir):
    return FL.reason_counts(FL.filter_cells(cells(spark, sf_dir), RULES))


@query(f"""WITH {CELLS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat_ws('|', CASE WHEN l_returnflag = 'A' THEN 'Touching edge' END,
  CASE WHEN area_px <= 10 THEN 'Area too small' WHEN area_px >= 40 THEN 'Area too large' END, CASE WHEN aspect_ratio < 0.01 THEN 'Eccentricity too low' WHEN aspect_ratio > 0.08 THEN 'Eccentricity too high' END,
  CASE WHEN solidity > 0.06 THEN 'Solidity too high' END, CASE WHEN aspect_ratio < 0.03 THEN 'Aspect ratio too low' END) AS reasons FROM cells""")
def primary_filter_bounds(spark, sf_dir):
    c = cells(spark, sf_dir).withColumns({"touching_edge": F.col("l_returnflag") == "A", "area": F.col("area_px"), "eccentricity": F.col("aspect_ratio"), "length_um": F.col("intensity"), "width_um": F.col("intensity")})
    bounds = {"area_min": 10, "area_max": 40, "eccentricity_min": 0.01, "eccentricity_max": 0.08, "solidity_max": 0.06, "aspect_ratio_min": 0.03}
    return FL.primary_filter(c, bounds).select(*KEYS, F.array_join("failure_reasons", "|").alias("reasons"))


@query(f"WITH {CELLS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM cells WHERE area_px BETWEEN 12 AND 30 AND solidity <= 0.05")
def morphology_filter(spark, sf_dir):
    return FL.morphology_filter(cells(spark, sf_dir), area_min=12, area_max=30, solidity_max=0.05).select(*KEYS)


@query(f"WITH {CELLS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM cells WHERE l_returnflag <> 'A' AND l_linestatus = 'F' AND area_px > 10 AND area_px < 20")
def particle_filter(spark, sf_dir):
    c = cells(spark, sf_dir).withColumn("touching_edge", F.col("l_returnflag") == "A")
    return FL.particle_filter(c, {"$l_linestatus": "F", "area_px": (10, 20)}).select(*KEYS)


@query("SELECT doc_id, quality FROM documents JOIN labels USING (doc_id) WHERE coalesce(quality * 0.9 + 0.05, 0) >= 0.5")
def classifier_left_filter(spark, sf_dir):
    classes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("Cell_ID"), "quality", (F.col("quality") * 0.9 + 0.05).alias("p_cell"), F.when(F.col("quality") == 1, "cell").otherwise("non_cell").alias("predicted_class"))
    joined = J.join_classes(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("Cell_ID")), classes)
    return FL.filter_classified(joined, 0.5).select(F.col("Cell_ID").alias("doc_id"), "quality")


@query("""WITH good AS (SELECT o_orderkey FROM orders WHERE CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_totalprice END IS NOT NULL AND o_orderstatus <> 'P')
SELECT count(*) AS n_cells, (SELECT count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM good)) AS n_profiles FROM good""")
def drop_nonfinite_cascade(spark, sf_dir):
    price = F.when(F.col("o_totalprice") < 50000, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    features = table(spark, sf_dir, "orders").select("o_orderkey", price.alias("a"), F.when(F.col("o_orderstatus") == "P", F.lit(float("inf"))).otherwise(F.lit(1.0)).alias("b"))
    kept, (rows,) = FL.drop_nonfinite(features, ["a", "b"], "o_orderkey", table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"))
    return kept.agg(F.count("*").alias("n_cells")).join(rows.agg(F.count("*").alias("n_profiles")), how="cross")


# ---- batches, shards, samples ---------------------------------------------


def images(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("/in/img_"), F.col("o_orderkey"), F.lit(".tif")).alias("path"), "o_orderkey", "o_custkey")


@query("""WITH i AS (SELECT '/in/img_' || o_orderkey || '.tif' AS source_path FROM orders), n AS (SELECT source_path, row_number() OVER (ORDER BY source_path) - 1 AS i FROM i)
SELECT 'batch' || (i % 7 + 1) AS batch, source_path, 'batch' || (i % 7 + 1) || '/' || substr(source_path, 5) AS link_path FROM n""")
def batch_round_robin(spark, sf_dir):
    return B.round_robin(images(spark, sf_dir), 7)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def skip_list_anti(spark, sf_dir):
    skip = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.concat(F.lit("img_"), F.col("c_custkey")).alias("token"))
    return B.not_skipped(images(spark, sf_dir), skip, "path").select("o_orderkey")


@query("SELECT vec_id FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM embeddings) WHERE i % 4 = 1")
def stride_shard(spark, sf_dir):
    return B.stride_shard(table(spark, sf_dir, "embeddings").select("vec_id"), "1/4", "vec_id")


@query("SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) AS INTEGER) AS chunk FROM orders")
def contiguous_chunks(spark, sf_dir):
    return B.contiguous_chunks(table(spark, sf_dir, "orders").select("o_orderkey"), 7, "o_orderkey")


@query("""WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CAST((i - (n - 1 - (n - 1) // 6 * 6) // 2) // ((n - 1) // 6) AS INTEGER) AS "group" FROM n
WHERE i >= (n - 1 - (n - 1) // 6 * 6) // 2 AND i < (n - 1 - (n - 1) // 6 * 6) // 2 + (n - 1) // 6 * 6""")
def rank_groups(spark, sf_dir):
    return B.rank_groups(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 6, "o_totalprice", "o_orderkey").select("o_orderkey", "group")


@query("SELECT doc_id, CASE WHEN h < 80 THEN 'train' WHEN h < 90 THEN 'val' ELSE 'test' END AS split FROM (SELECT doc_id, CAST('0x' || substr(md5('0/' || doc_id), 1, 8) AS BIGINT) % 100 AS h FROM documents)")
def split_hash_bucket(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", B.hash_split(F.col("doc_id")).alias("split"))


@query("SELECT o_orderkey FROM orders ORDER BY CAST('0x' || substr(md5('7/' || o_orderkey), 1, 8) AS BIGINT), o_orderkey LIMIT 100")
def seeded_sample(spark, sf_dir):
    return B.sample_rows(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 100, 7)


@query("SELECT source AS batch, doc_id AS image_id, CASE WHEN n_chars < 200 THEN 'too short' WHEN lang = 'de' THEN 'log: ' || source ELSE 'no output' END AS reason FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)".replace("WHEN lang = 'de' THEN 'log: ' || source ELSE", "WHEN source IN ('src1', 'src2') THEN 'log: ' || source ELSE"))
def expected_minus_done(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("batch"), F.col("doc_id").alias("image_id"), "n_chars")
    logs = d.where(F.col("batch").isin("src1", "src2")).select("batch").distinct().withColumn("reason", F.concat(F.lit("log: "), "batch"))
    errors = d.where("n_chars < 200").select("image_id", F.lit("too short").alias("error"))
    return B.expected_minus_done(d, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("image_id")), errors, logs)


# ---- identity and names ----------------------------------------------------


def named_cells(spark, sf_dir):
    path = F.concat(F.lit("/plates/p_"), F.lpad((F.col("l_orderkey") % 1000000).cast("string"), 6, "0"), F.lit("_"), F.lpad((F.col("l_partkey") % 10000).cast("string"), 4, "0"), F.lit("_s"), F.col("l_linenumber"), F.lit("m2_m"), F.col("l_suppkey"), F.lit("_x.y_Phase.tif"))
    box = [(F.col("l_partkey") % 97).cast("int"), (F.col("l_suppkey") % 89).cast("int"), (F.col("l_partkey") % 97 + 9).cast("int"), (F.col("l_suppkey") % 89 + 7).cast("int")]
    return table(spark, sf_dir, "lineitem").select(*KEYS, path.alias("source_path"), F.col("l_linenumber").alias("mask_label"), *[b.alias(n) for b, n in zip(box, schemas.BBOX, strict=True)])


NAMED_SQL = """named AS (SELECT *, '/plates/' || source_filename AS source_path FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'p_' || lpad(CAST(l_orderkey % 1000000 AS VARCHAR), 6, '0') || '_' || lpad(CAST(l_partkey % 10000 AS VARCHAR), 4, '0')
  || '_s' || l_linenumber || 'm2_m' || l_suppkey || '_x.y_Phase.tif' AS source_filename, l_partkey % 97 AS r1, l_suppkey % 89 AS c1, l_partkey % 97 + 9 AS r2, l_suppkey % 89 + 7 AS c2 FROM lineitem)),
hashed AS (SELECT *, substr(sha256(source_filename || '|' || l_linenumber || '|' || r1 || ',' || c1 || ',' || r2 || ',' || c2), 1, 16) AS h FROM named)"""


@query(f"WITH {NAMED_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'sc_' || h AS cell_id, 'm2_' || h AS ucid, substr(sha256('run1|' || source_path || '|' || l_linenumber || '|' || r1 || ',' || c1 || ',' || r2 || ',' || c2), 1, 16) AS crop_hash FROM hashed")
def cell_hash_ids(spark, sf_dir):
    c = named_cells(spark, sf_dir)
    path, label, box = F.col("source_path"), F.col("mask_label"), [F.col(b) for b in schemas.BBOX]
    return c.select(*KEYS, ID.cell_id(path, label, box).alias("cell_id"), ID.ucid(path, label, box).alias("ucid"), ID.crop_hash(F.lit("run1"), path, label, box).alias("crop_hash"))


@query(f"WITH {NAMED_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, split_part(source_filename, '_', 3) AS plate, 'UNK' AS scene, substr(split_part(source_filename, '_', 5), 2) AS position FROM named")
def filename_tokens(spark, sf_dir):
    told = ID.filename_metadata(F.element_at(F.split("source_path", "/"), -1))
    return named_cells(spark, sf_dir).select(*KEYS, told["plate"].alias("plate"), told["scene"].alias("scene"), told["position"].alias("position"))


CHANNELS = ["AF405", "Cy5", "Cy5DA", "Bod493"]


@query("""WITH s AS (SELECT o_orderkey, 'p_' || o_custkey || CASE o_orderkey % 5 WHEN 0 THEN '_AF405' WHEN 1 THEN '_Cy5_ORG' WHEN 2 THEN '_sCy5DA-01_Phase' WHEN 3 THEN '_Cy5DA raw' ELSE '_other' END AS stem FROM orders),
r AS (SELECT *, regexp_extract(stem, '^(.*)_(AF405|Bod493|Cy5DA|Cy5)($|[_ .].*$)', ['base', 'channel', 'rest']) AS m FROM s)
SELECT o_orderkey, CASE WHEN m.channel <> '' THEN m.channel WHEN stem LIKE '%\\_Phase' ESCAPE '\\' THEN 'Phase' END AS channel, CASE WHEN m.channel <> '' THEN m.base WHEN stem LIKE '%\\_Phase' ESCAPE '\\' THEN left(stem, -6) ELSE stem END AS base FROM r""")
def channel_token(spark, sf_dir):
    k = F.col("o_orderkey") % 5
    tail = F.when(k == 0, "_AF405").when(k == 1, "_Cy5_ORG").when(k == 2, "_sCy5DA-01_Phase").when(k == 3, "_Cy5DA raw").otherwise("_other")
    t = ID.channel_token(F.concat(F.lit("p_"), F.col("o_custkey"), tail), CHANNELS)
    return table(spark, sf_dir, "orders").select("o_orderkey", t["channel"].alias("channel"), t["base"].alias("base"))


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'cell' WHEN 'view' THEN 'no_cell' ELSE lower(trim(event_type)) END AS status FROM events")
def status_normalise(spark, sf_dir):
    raw = F.when(F.col("event_type") == "click", " Pass ").when(F.col("event_type") == "view", "FAIL").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", ID.review_status(raw).alias("status"))


@query("SELECT s_suppkey, lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(4, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') || '_s' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS padmap_id FROM supplier")
def zfill_key(spark, sf_dir):
    return L.with_key(table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_suppkey").alias("plate"), F.col("s_nationkey").alias("scene"))).select("s_suppkey", "padmap_id")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_flatten(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query(f"WITH {NAMED_SQL} SELECT 'sc_' || h AS cell_id, h AS hash, source_path, source_filename, CAST(l_linenumber AS INTEGER) AS mask_label, CAST(r1 AS INTEGER) AS bbox_min_row, CAST(c1 AS INTEGER) AS bbox_min_col, CAST(r2 AS INTEGER) AS bbox_max_row, CAST(c2 AS INTEGER) AS bbox_max_col, split_part(source_filename, '_', 3) AS plate, 'UNK' AS scene, substr(split_part(source_filename, '_', 5), 2) AS position FROM hashed")
def lookup_build(spark, sf_dir):
    return J.lookup_rows(named_cells(spark, sf_dir)).drop("created_at")


@query(f"WITH {NAMED_SQL} SELECT DISTINCT 'sc_' || h AS cell_id, plate, scene FROM (SELECT h, split_part(source_filename, '_', 3) AS plate, 'UNK' AS scene FROM hashed) WHERE plate = '0007'")
def lookup_by_plate(spark, sf_dir):
    return J.cells_of(J.lookup_rows(named_cells(spark, sf_dir)), "0007").select("cell_id", "plate", "scene").distinct()


@query(f"WITH {NAMED_SQL} SELECT source_path, mask_label FROM (SELECT source_path, CAST(l_linenumber AS INTEGER) AS mask_label, h, row_number() OVER (ORDER BY h) AS i FROM hashed) WHERE i = 1")
def lookup_point(spark, sf_dir):
    lookup = J.lookup_rows(named_cells(spark, sf_dir))
    return J.find_cell(lookup, lookup.agg(F.min("hash")).first()[0]).select("source_path", "mask_label")


@query(f"""WITH {NAMED_SQL} SELECT 'sc_' || h AS "Cell_ID", h AS cell_hash, 'r0' AS segmentation_run_hash, replace(source_filename, '.tif', '') AS source_image, CAST(NULL AS VARCHAR) AS predicted_class, 'UNK' AS drug, split_part(source_filename, '_', 3) AS plate FROM hashed""")
def mapping_export(spark, sf_dir):
    c = named_cells(spark, sf_dir).withColumnRenamed("mask_label", "label")
    c = ID.ensure_ids(c, bbox=schemas.BBOX)
    return X.mapping(c, "r0").select("Cell_ID", "cell_hash", "segmentation_run_hash", "source_image", "predicted_class", "drug", "plate")


@query(f"""WITH {NAMED_SQL} SELECT 'sc_' || h AS "Cell_ID", 'sha256:' || h AS cell_hash, 'r1' AS segmentation_run_hash, replace(source_filename, '_Phase.tif', '') AS source_image FROM hashed""")
def provenance_fill(spark, sf_dir):
    c = ID.ensure_ids(named_cells(spark, sf_dir), label="mask_label", bbox=schemas.BBOX)
    return ID.ensure_provenance(c, "r1").select("Cell_ID", "cell_hash", "segmentation_run_hash", "source_image")


# ---- joins and labels ------------------------------------------------------


@query(f"""WITH {CELLS_SQL}, crops AS (SELECT l_orderkey AS image_id, l_linenumber AS label, min(l_partkey) AS crop FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2)
SELECT image_id, CAST(label AS INTEGER) AS label, area_px, 'c' || crop AS "Cell_ID", CAST(1 AS DOUBLE) AS area_px_crop FROM cells JOIN crops USING (image_id, label)""")
def join_crops_inner(spark, sf_dir):
    crops = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'").groupBy(F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("label")).agg(F.concat(F.lit("c"), F.min("l_partkey")).alias("Cell_ID"), F.lit(1.0).alias("area_px"))
    c = cells(spark, sf_dir).select("image_id", "label", "area_px", F.lit("old").alias("Cell_ID"))
    return J.join_crops(c, crops).select("image_id", "label", "area_px", "Cell_ID", "area_px_crop")


def _labelled(spark, sf_dir, how):
    c = cells(spark, sf_dir).select(*KEYS, F.col("l_partkey").cast("string").alias("padmap_id"))
    return L.apply_registry(c, registry(spark, sf_dir), how).select(*KEYS, "padmap_id", "drug")


for _how, _join in (("left", "LEFT"), ("inner", "INNER"), ("outer", "FULL OUTER")):

    def _padmap(spark, sf_dir, how=_how):
        return _labelled(spark, sf_dir, how)

    _padmap.__name__ = f"padmap_{_how}"
    query(f"WITH {CELLS_SQL}, {REGISTRY_SQL}, c AS (SELECT *, CAST(l_partkey AS VARCHAR) AS padmap_id FROM cells) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, padmap_id, coalesce(padmap_drug, 'UNK') AS drug FROM c {_join} JOIN registry USING (padmap_id)")(_padmap)


@query(f"""WITH {REGISTRY_SQL}, c AS (SELECT CAST(l_partkey AS VARCHAR) AS padmap_id FROM lineitem)
SELECT count(*) AS total, count(padmap_drug) AS matched, count(*) - count(padmap_drug) AS unmatched, round(100.0 * count(padmap_drug) / count(*), 2) AS percent, count(DISTINCT padmap_drug) AS drugs,
  count(DISTINCT CASE WHEN padmap_drug IS NULL THEN padmap_id END) AS unmatched_ids FROM c LEFT JOIN registry USING (padmap_id)""")
def padmap_report(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("padmap_id"))
    return L.match_report(c, registry(spark, sf_dir))


@query(f"""WITH {CELLS_SQL}, {REGISTRY_SQL}, c AS (SELECT *, CAST(l_partkey AS VARCHAR) AS padmap_id FROM cells), n AS (SELECT c.*, coalesce(padmap_drug, 'UNK') AS drug FROM c LEFT JOIN registry USING (padmap_id))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN drug = 'UNK' THEN 'hash' ELSE 'sc_' || drug || '_' || row_number() OVER (PARTITION BY drug ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) END AS "Cell_ID" FROM n""")
def assign_drug_ids(spark, sf_dir):
    c = _labelled(spark, sf_dir, "left").withColumn("Cell_ID", F.lit("hash"))
    return L.numbered_ids(c, "drug", tuple(KEYS)).select(*KEYS, "Cell_ID")


@query("SELECT c_custkey AS cell_id, round(CASE WHEN c_nationkey < 15 THEN c_acctbal ELSE -c_acctbal END, 6) AS value FROM customer WHERE c_nationkey < 15 OR c_acctbal > 0")
def merge_existing_wins(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    existing = c.where("c_nationkey < 15").select(F.col("c_custkey").alias("cell_id"), F.col("c_acctbal").alias("value"))
    new = c.where("c_acctbal > 0").select(F.col("c_custkey").alias("cell_id"), (-F.col("c_acctbal")).alias("value"))
    return rounded(J.merge_existing(existing, new))


@query("""SELECT 'b' || l_returnflag AS batch, l_orderkey AS image_id, CASE WHEN l_returnflag = 'A' THEN l_quantity END AS area_px, CASE WHEN l_returnflag = 'N' THEN l_tax END AS extra, count(*) AS n
FROM lineitem GROUP BY ALL""")
def union_batches(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem")
    parts = {"bA": t.where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("image_id"), F.col("l_quantity").alias("area_px")), "bN": t.where("l_returnflag = 'N'").select(F.col("l_orderkey").alias("image_id"), F.col("l_tax").alias("extra")), "bR": t.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("image_id"))}
    return J.union_batches(parts).groupBy("batch", "image_id", "area_px", "extra").agg(F.count("*").alias("n"))


@query("SELECT l_returnflag AS batch, count(*) AS n_cells, count(*) FILTER (l_linestatus = 'O') AS n_included, count(DISTINCT l_orderkey) AS n_images FROM lineitem GROUP BY 1")
def batch_summary(spark, sf_dir):
    return J.batch_summary(table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("batch"), (F.col("l_linestatus") == "O").alias("included"), F.col("l_orderkey").alias("image_id")))


@query("""WITH f AS (SELECT CAST(o_custkey AS VARCHAR) AS base, CASE o_orderkey % 3 WHEN 0 THEN 'Phase' WHEN 1 THEN 'AF405' ELSE 'Odd' END AS channel, '/d/' || o_custkey || '_' || CASE o_orderkey % 3 WHEN 0 THEN 'Phase' WHEN 1 THEN 'AF405' ELSE 'Odd' END || '.tif' AS path FROM orders)
SELECT base, channel, min(path) AS path FROM f WHERE base IN (SELECT base FROM f WHERE channel = 'Phase') GROUP BY 1, 2""")
def sibling_channels(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    files = table(spark, sf_dir, "orders").select(F.concat(F.lit("/d/"), F.col("o_custkey"), F.lit("_"), F.when(k == 0, "Phase").when(k == 1, "AF405").otherwise("Odd"), F.lit(".tif")).alias("path"))
    return J.siblings(files, CHANNELS + ["Phase"]).select("base", "channel", "path")


# ---- aggregates ------------------------------------------------------------

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LONG_SQL = "WITH l AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, CASE WHEN l_returnflag = 'R' AND '{c}' = 'l_tax' THEN NULL ELSE {c} END AS value FROM lineitem" for c in FEATURES) + ") "


@query(_LONG_SQL + """SELECT feature, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.25), 4) AS q25, round(quantile_cont(value, 0.5), 4) AS q50,
round(quantile_cont(value, 0.75), 4) AS q75, count(value) AS n_valid, round(100.0 * (count(*) - count(value)) / count(*), 2) AS pct_missing FROM l GROUP BY feature""")
def feature_summary(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").withColumn("l_tax", F.when(F.col("l_returnflag") == "R", F.lit(float("nan"))).otherwise(F.col("l_tax")))
    return rounded(A.feature_summary(A.tidy(t, "l_orderkey", FEATURES)), 4)


_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("""WITH l AS (SELECT r_name AS cell_id, 'customers' AS feature, CAST(count(*) AS DOUBLE) AS value FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
UNION ALL SELECT r_name, 'nations', CAST(count(*) AS DOUBLE) FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1)
SELECT feature, """ + ", ".join(f"max(CASE WHEN cell_id = '{r}' THEN value END) AS \"{r}\"" for r in _REGIONS) + " FROM l GROUP BY feature")
def wide_matrix(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    count = lambda df, name: df.groupBy(F.col("r_name").alias("cell_id")).agg(F.count("*").cast("double").alias("value")).withColumn("feature", F.lit(name))
    return A.wide_matrix(count(c, "customers").unionByName(count(n, "nations")))


@query("""WITH m AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem, m WHERE abs((l_extendedprice - m) / s) < 1.5""")
def zscore_outliers(spark, sf_dir):
    return A.remove_outliers(table(spark, sf_dir, "lineitem").select(*KEYS, "l_extendedprice"), "l_extendedprice", 1.5).select(*KEYS)


@query("""WITH m AS (SELECT avg(l_extendedprice) AS m1, stddev_pop(l_extendedprice) AS s1, avg(l_quantity) AS m2, stddev_pop(l_quantity) AS s2 FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CASE WHEN (l_extendedprice - m1) / s1 > 1.5 OR (l_quantity - m2) / s2 > 1.6 THEN 1 ELSE 0 END AS INTEGER) AS outlier FROM lineitem, m""")
def outlier_flags(spark, sf_dir):
    return A.find_outliers(table(spark, sf_dir, "lineitem").select(*KEYS, "l_extendedprice", "l_quantity"), {"l_extendedprice": 1.5, "l_quantity": 1.6}).select(*KEYS, "outlier")


@query("SELECT o_orderkey, round((o_totalprice - min(o_totalprice) OVER ()) / (max(o_totalprice) OVER () - min(o_totalprice) OVER ()), 6) AS o_totalprice FROM orders")
def min_max_scaling(spark, sf_dir):
    return rounded(A.min_max_scaled(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice"))


@query("""WITH c AS (SELECT label AS class, count(*) AS n FROM embeddings GROUP BY 1), w AS (SELECT *, 1 / (n + 1.0) AS r FROM c)
SELECT class, n, round(r / sum(r) OVER () * count(*) OVER (), 6) AS weight FROM w""")
def class_weights(spark, sf_dir):
    return rounded(A.class_weights(table(spark, sf_dir, "embeddings").groupBy(F.col("label").alias("class")).agg(F.count("*").alias("n"))))


def _classes(spark, sf_dir):
    """Pixels of neighbouring patches as prediction and target of three classes."""
    p = patch(spark, sf_dir).withColumn("c", F.when(F.col("value") < -0.5, 0).when(F.col("value") < 0.5, 1).otherwise(2))
    pred = p.select((F.col("image_id") + 1).alias("image_id"), "y", "x", F.col("c").alias("pred"))
    return p.select("image_id", "y", "x", F.col("c").alias("target")).join(pred, ["image_id", "y", "x"])


CLASSES_SQL = PIXELS_SQL + ", cl AS (SELECT *, CASE WHEN value < -0.5 THEN 0 WHEN value < 0.5 THEN 1 ELSE 2 END AS c FROM px), pr AS (SELECT a.image_id, a.c AS target, b.c AS pred FROM cl a JOIN cl b ON b.image_id + 1 = a.image_id AND a.y = b.y AND a.x = b.x)"


@query(f"WITH {CLASSES_SQL} SELECT CAST(target AS INTEGER) AS target, CAST(pred AS INTEGER) AS pred, count(*) AS n FROM pr GROUP BY 1, 2")
def confusion_matrix(spark, sf_dir):
    return A.confusion(_classes(spark, sf_dir))


@query(f"""WITH {CLASSES_SQL}, k AS (SELECT image_id, CAST(c AS INTEGER) AS class, count(*) FILTER (pred = c AND target = c) AS b, count(*) FILTER (pred = c) AS p, count(*) FILTER (target = c) AS t FROM pr, (VALUES (0), (1), (2)) v(c) GROUP BY 1, 2)
SELECT image_id, class, round(CASE WHEN p + t = 0 THEN 1 ELSE 2.0 * b / (p + t) END, 6) AS dice, round(CASE WHEN p + t - b = 0 THEN 1 ELSE 1.0 * b / (p + t - b) END, 6) AS iou FROM k""")
def dice_iou(spark, sf_dir):
    return rounded(A.dice_iou(_classes(spark, sf_dir), [0, 1, 2]))


@query(f"""WITH {CLASSES_SQL}, v AS (SELECT image_id, count(*) FILTER (pred = 0) AS n0, count(*) FILTER (pred = 1) AS n1, count(*) FILTER (pred = 2) AS n2, max(target) AS target FROM pr WHERE target > 0 GROUP BY 1),
o AS (SELECT target, CASE WHEN n0 > n1 + n2 THEN 0 WHEN n1 >= n2 THEN 1 ELSE 2 END AS pred FROM v), m AS (SELECT count(*) FILTER (target = 1 AND pred = 1) AS tp, count(*) FILTER (target = 2 AND pred = 1) AS fp, count(*) FILTER (target = 1 AND pred <> 1) AS fn, count(*) FILTER (target = 2 AND pred <> 1) AS tn FROM o)
SELECT *, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(coalesce(tn / nullif(tn + fp, 0), 0), 6) AS tnr, round(coalesce(fp / nullif(tn + fp, 0), 0), 6) AS fpr FROM m""")
def object_metrics(spark, sf_dir):
    return rounded(A.object_metrics(A.object_votes(_classes(spark, sf_dir))))


@query("""WITH e AS (SELECT quantile_cont(o_totalprice, [0.2, 0.4, 0.6, 0.8]) AS e FROM orders), b AS (SELECT CAST((o_totalprice >= e[1])::INT + (o_totalprice >= e[2])::INT + (o_totalprice >= e[3])::INT + (o_totalprice >= e[4])::INT AS INTEGER) AS bin, o_custkey FROM orders, e)
SELECT bin, count(*) AS n, CAST(median(o_custkey) AS DOUBLE) AS median FROM b GROUP BY 1""")
def length_bins(spark, sf_dir):
    return A.length_bins(table(spark, sf_dir, "orders").select("o_totalprice", "o_custkey"), "o_totalprice", "o_custkey")


def _spots(spark, sf_dir):
    return patch(spark, sf_dir).where("value > 0.25").select(F.col("image_id").alias("cell_id"), (F.col("y") * 8 + F.col("x")).alias("punctum_id"), F.col("y").cast("double").alias("y_px"), F.col("x").cast("double").alias("x_px"), F.col("value").alias("peak_intensity"), (-F.col("value") / 2).alias("log"))


@query(f"""WITH {PIXELS_SQL}, t AS (SELECT image_id AS cell_id, sum(abs(value)) AS total FROM px GROUP BY 1), s AS (SELECT image_id AS cell_id, count(*) AS n, sum(value) AS su, max(value) AS mx, avg(abs(value / 2)) AS ml, max(abs(value / 2)) AS xl FROM px WHERE value > 0.25 GROUP BY 1)
SELECT cell_id, coalesce(n, 0) AS punctum_count, round(su, 6) AS total_punctum_intensity, round(mx, 6) AS max_punctum_intensity, round(ml, 6) AS mean_log, round(xl, 6) AS max_log, round(su / (total + 1e-10), 6) AS fraction_of_total FROM t LEFT JOIN s USING (cell_id)""")
def puncta_summary(spark, sf_dir):
    total = patch(spark, sf_dir).groupBy(F.col("image_id").alias("cell_id")).agg(F.sum(F.abs("value")).alias("total_intensity"))
    return rounded(A.puncta_summary(total, _spots(spark, sf_dir)))


@query(f"""WITH {PIXELS_SQL}, l AS (SELECT image_id AS cell_id, y AS i, y AS ly, 3.5 + 0.5 * value AS lx FROM px WHERE x = 0),
d AS (SELECT *, coalesce(sqrt(1 + pow(lx - lag(lx) OVER (PARTITION BY cell_id ORDER BY i), 2)), 0) AS d FROM l), a AS (SELECT *, sum(d) OVER (PARTITION BY cell_id ORDER BY i) / sum(d) OVER (PARTITION BY cell_id) AS f FROM d),
p AS (SELECT image_id AS cell_id, y * 8 + x AS punctum_id, y, x FROM px WHERE value > 0.25), j AS (SELECT p.cell_id, punctum_id, f, sqrt(pow(y - ly, 2) + pow(x - lx, 2)) AS r, i FROM p JOIN a USING (cell_id))
SELECT cell_id, CAST(punctum_id AS INTEGER) AS punctum_id, round(f, 6) AS axial_s, round(r, 6) AS radial_r FROM (SELECT *, row_number() OVER (PARTITION BY cell_id, punctum_id ORDER BY r, i) AS k FROM j) WHERE k = 1""")
def axial_positions(spark, sf_dir):
    line = patch(spark, sf_dir).where("x = 0").select(F.col("image_id").alias("cell_id"), F.col("y").alias("i"), F.col("y").cast("double").alias("y"), (3.5 + 0.5 * F.col("value")).alias("x"))
    return rounded(A.axial_positions(_spots(spark, sf_dir), line))


# ---- pixels ----------------------------------------------------------------


@query(f"""WITH {MASK_SQL}, m AS (SELECT image_id, label, count(*) AS area, avg(y) AS cy, avg(x) AS cx, min(y) AS r1, min(x) AS c1, max(y) + 1 AS r2, max(x) + 1 AS c2, avg(y * y) - avg(y) * avg(y) + 1 / 12 AS a, avg(x * x) - avg(x) * avg(x) + 1 / 12 AS b, avg(y * x) - avg(y) * avg(x) AS c FROM mask GROUP BY 1, 2),
l AS (SELECT *, (a + b) / 2 + sqrt(((a - b) / 2) * ((a - b) / 2) + c * c) AS l1, greatest((a + b) / 2 - sqrt(((a - b) / 2) * ((a - b) / 2) + c * c), 0) AS l2 FROM m)
SELECT image_id, label, area, round(cy, 6) AS centroid_row, round(cx, 6) AS centroid_col, r1 AS bbox_min_row, c1 AS bbox_min_col, r2 AS bbox_max_row, c2 AS bbox_max_col, round(4 * sqrt(l1), 5) AS major_axis, round(4 * sqrt(l2), 5) AS minor_axis,
  round(sqrt(greatest(1 - l2 / l1, 0)), 4) AS eccentricity, round(area / ((r2 - r1) * (c2 - c1)), 6) AS extent, round(sqrt(4 * area / pi()), 6) AS equivalent_diameter FROM l""")
def regionprops_moments(spark, sf_dir):
    p = P.region_properties(halves(spark, sf_dir))
    columns = p.select("image_id", "label", "area", "centroid_row", "centroid_col", *schemas.BBOX, "extent", "equivalent_diameter", "major_axis", "minor_axis", "eccentricity")
    return rounded(columns, major_axis=5, minor_axis=5, eccentricity=4)


@query(f"""WITH {MASK_SQL}, m AS (SELECT *, y - avg(y) OVER w AS v, x - avg(x) OVER w AS u FROM mask WINDOW w AS (PARTITION BY image_id, label)),
n AS (SELECT image_id, label, sum(v * v) / pow(count(*), 2) AS n20, sum(u * u) / pow(count(*), 2) AS n02, sum(u * v) / pow(count(*), 2) AS n11, sum(v * v * v) / pow(count(*), 2.5) AS n30, sum(u * u * u) / pow(count(*), 2.5) AS n03, sum(v * v * u) / pow(count(*), 2.5) AS n21, sum(v * u * u) / pow(count(*), 2.5) AS n12 FROM m GROUP BY 1, 2)
SELECT image_id, label, round(n20 + n02, 6) AS hu_moment_0, round(pow(n20 - n02, 2) + 4 * n11 * n11, 6) AS hu_moment_1, round(pow(n30 - 3 * n12, 2) + pow(3 * n21 - n03, 2), 6) AS hu_moment_2, round(pow(n30 + n12, 2) + pow(n21 + n03, 2), 6) AS hu_moment_3 FROM n""")
def hu_moments(spark, sf_dir):
    return rounded(P.hu_moments(halves(spark, sf_dir)).select("image_id", "label", *[f"hu_moment_{i}" for i in range(4)]))


@query(f"""WITH {MASK_SQL}, c AS (SELECT *, avg(value) OVER w AS m, count(*) OVER w AS n FROM mask WINDOW w AS (PARTITION BY image_id, label)),
s AS (SELECT image_id, label, avg(value) AS mean, stddev_pop(value) AS std, var_pop(value) AS var, min(value) AS min, max(value) AS max, quantile_cont(value, [0.05, 0.25, 0.5, 0.75, 0.95]) AS q, count(*) AS n, avg(pow(value - m, 3)) AS m3, avg(pow(value - m, 4)) AS m4 FROM c GROUP BY 1, 2)
SELECT image_id, label, round(mean, 5) AS mean, round(q[3], 5) AS median, round(std, 5) AS std, round(var, 5) AS var, round(min, 5) AS min, round(max, 5) AS max, round(max - min, 5) AS range, round(q[2], 5) AS q1, round(q[4], 5) AS q3, round(q[4] - q[2], 5) AS iqr, round(q[1], 5) AS p5, round(q[5], 5) AS p95,
  round(std / abs(mean), 5) AS cv, round(CASE WHEN n >= 4 THEN m3 / pow(var, 1.5) END, 5) AS skewness, round(CASE WHEN n >= 4 THEN m4 / (var * var) - 3 END, 5) AS kurtosis FROM s""")
def intensity_panel(spark, sf_dir):
    return rounded(P.intensity_stats(halves(spark, sf_dir), ("image_id", "label")), 5)


@query(f"""WITH {MASK_SQL}, l AS (SELECT image_id, label, min(value) AS lo, max(value) AS hi, count(*) AS n FROM mask GROUP BY 1, 2),
b AS (SELECT m.image_id, m.label, CASE WHEN lo = hi THEN 1.0 ELSE hi - lo END / 64 AS w, n, least(floor((value - CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END) / (CASE WHEN lo = hi THEN 1.0 ELSE hi - lo END / 64)), 63) AS bin FROM mask m JOIN l USING (image_id, label)),
k AS (SELECT image_id, label, w, n, bin, count(*) AS k FROM b GROUP BY ALL)
SELECT image_id, label, round(-sum(k / n / w * log2(k / n / w + 1e-10)), 4) AS entropy FROM k GROUP BY 1, 2""")
def entropy_density(spark, sf_dir):
    return rounded(P.entropy(halves(spark, sf_dir), ("image_id", "label")), 4)


@query(f"WITH {PIXELS_SQL} SELECT image_id, y, x FROM px WHERE value > -0.5 AND value < 0.25")
def threshold_fixed(spark, sf_dir):
    return P.range_mask(patch(spark, sf_dir), -0.5, 0.25).select("image_id", "y", "x")


@query()
def threshold_isodata(spark, sf_dir):
    p = patch(spark, sf_dir)
    return P.threshold_mask(p, P.isodata_thresholds(p)).select("image_id", "y", "x")


@query(f"""WITH {PIXELS_SQL}, o AS (SELECT unnest(range(-1, 2)) AS d), n AS (SELECT p.image_id, p.y, p.x, q.value FROM px p, o a, o b, px q WHERE q.image_id = p.image_id
  AND q.y = CASE WHEN p.y + a.d < 0 THEN -(p.y + a.d) WHEN p.y + a.d > 7 THEN 14 - (p.y + a.d) ELSE p.y + a.d END AND q.x = CASE WHEN p.x + b.d < 0 THEN -(p.x + b.d) WHEN p.x + b.d > 7 THEN 14 - (p.x + b.d) ELSE p.x + b.d END)
SELECT image_id, y, x, round(avg(value), 5) AS local_mean, round(stddev_pop(value), 4) AS local_std FROM n GROUP BY 1, 2, 3""")
def box_statistics(spark, sf_dir):
    b = P.box_stats(patch(spark, sf_dir), 8, 8, 3)
    return b.select("image_id", "y", "x", F.round("local_mean", 5).alias("local_mean"), F.round("local_std", 4).alias("local_std"))


@query(f"""WITH {PIXELS_SQL}, o AS (SELECT unnest(range(-1, 2)) AS d), n AS (SELECT p.image_id, p.y, p.x, p.value AS v, q.value FROM px p, o a, o b, px q WHERE q.image_id = p.image_id
  AND q.y = CASE WHEN p.y + a.d < 0 THEN -(p.y + a.d) WHEN p.y + a.d > 7 THEN 14 - (p.y + a.d) ELSE p.y + a.d END AND q.x = CASE WHEN p.x + b.d < 0 THEN -(p.x + b.d) WHEN p.x + b.d > 7 THEN 14 - (p.x + b.d) ELSE p.x + b.d END),
s AS (SELECT image_id, y, x, v, avg(value) AS m, stddev_pop(value) AS d FROM n GROUP BY 1, 2, 3, 4), r AS (SELECT image_id, (max(value) - min(value)) / 2 AS r FROM px GROUP BY 1)
SELECT image_id, y, x FROM s JOIN r USING (image_id) WHERE v < m * (1 + 0.2 * (d / r - 1))""")
def threshold_sauvola(spark, sf_dir):
    return P.sauvola_mask(patch(spark, sf_dir), 8, 8, 3).select("image_id", "y", "x")


_DISK = "disk AS (SELECT a AS dy, b AS dx FROM (SELECT unnest(range(-{r}, {r} + 1)) AS a), (SELECT unnest(range(-{r}, {r} + 1)) AS b) WHERE a * a + b * b <= {r} * {r})"


@query(f"""WITH {MASK_SQL}, {_DISK.format(r=2)}, d2 AS (SELECT DISTINCT image_id, label, y + dy AS y, x + dx AS x FROM mask, disk WHERE y + dy BETWEEN 0 AND 7 AND x + dx BETWEEN 0 AND 7),
d1 AS (SELECT DISTINCT image_id, label, y + dy AS y, x + dx AS x FROM mask, disk WHERE dy * dy + dx * dx <= 1), r AS (SELECT * FROM d2 EXCEPT SELECT * FROM d1)
SELECT r.image_id, r.label, round(avg(value), 5) AS bg_mean, round(median(value), 5) AS bg_median, round(stddev_pop(value), 5) AS bg_std FROM r JOIN px USING (image_id, y, x) GROUP BY 1, 2""")
def background_ring(spark, sf_dir):
    ring = P.background_ring(halves(spark, sf_dir).drop("value"), 2, 1, height=8, width=8)
    return rounded(P.background_stats(ring, patch(spark, sf_dir)), 5)


@query(f"""WITH {MASK_SQL}, {_DISK.format(r=1)}, c AS (SELECT m.image_id, m.label, m.y, m.x FROM mask m, disk JOIN mask n ON n.image_id = m.image_id AND n.label = m.label AND n.y = m.y + dy AND n.x = m.x + dx GROUP BY ALL HAVING count(*) = 5),
z AS (SELECT m.*, c.y IS NOT NULL AS core FROM mask m LEFT JOIN c USING (image_id, label, y, x))
SELECT image_id, label, round(avg(value) FILTER (NOT core), 5) AS shell_mean, round(avg(value) FILTER (core), 5) AS core_mean, round(avg(value) FILTER (NOT core) / (avg(value) FILTER (core) + 1e-10), 5) AS shell_core_ratio FROM z GROUP BY 1, 2""".replace("FROM mask m, disk JOIN mask n ON n.image_id = m.image_id AND n.label = m.label AND n.y = m.y + dy AND n.x = m.x + dx", "FROM mask m, disk, mask n WHERE n.image_id = m.image_id AND n.label = m.label AND n.y = m.y + dy AND n.x = m.x + dx"))
def shell_core(spark, sf_dir):
    return rounded(P.shell_core_stats(P.shell_core(halves(spark, sf_dir).drop("value"), 1), patch(spark, sf_dir)), 5)


@query(f"""WITH {MASK_SQL}, a AS (SELECT image_id AS t, label, count(*) AS n FROM mask GROUP BY 1, 2), s AS (SELECT m.image_id AS t, m.label AS a, n.label AS b, count(*) AS o FROM mask m JOIN mask n ON n.image_id = m.image_id + 1 AND n.y = m.y AND n.x = m.x GROUP BY ALL)
SELECT s.t || '_' || a AS frame1_id, (s.t + 1) || '_' || b AS frame2_id, o AS overlap_area, p.n AS frame1_area, q.n AS frame2_area, round(o / p.n, 6) AS frame1_overlap_frac, round(o / q.n, 6) AS frame2_overlap_frac, round(o / (p.n + q.n - o), 6) AS iou
FROM s JOIN a p ON p.t = s.t AND p.label = s.a JOIN a q ON q.t = s.t + 1 AND q.label = s.b""")
def overlap_iou(spark, sf_dir):
    return rounded(T.frame_overlaps(halves(spark, sf_dir).select(F.col("image_id").alias("t"), "label", "y", "x")))


def _frames(spark, sf_dir):
    mask = halves(spark, sf_dir).select(F.col("image_id").alias("t"), "label", "y", "x")
    cell = F.concat_ws("_", F.col("t").cast("string"), F.col("label").cast("string"))
    return mask, mask.groupBy("t", "label").agg(F.count("*").alias("area"), (F.min("y") == 0).alias("touching_edge")).withColumn("cell_id", cell)


@query(f"""WITH {MASK_SQL}, a AS (SELECT image_id AS t, label, count(*) AS n, min(y) = 0 AS edge FROM mask GROUP BY 1, 2), s AS (SELECT m.image_id AS t, m.label AS a, n.label AS b, count(*) AS o FROM mask m JOIN mask n ON n.image_id = m.image_id + 1 AND n.y = m.y AND n.x = m.x GROUP BY ALL),
f AS (SELECT s.t || '_' || a AS mother, (s.t + 1) || '_' || b AS daughter, o, p.n AS n1, q.n AS n2, q.edge FROM s JOIN a p ON p.t = s.t AND p.label = s.a JOIN a q ON q.t = s.t + 1 AND q.label = s.b), sure AS (SELECT mother, daughter FROM f WHERE greatest(o / n1, o / n2) > 0.6),
r AS (SELECT mother, daughter FROM f WHERE NOT edge AND o > 4 AND least(n1, n2) / greatest(n1, n2) > 0.5 AND least(n1, n2) > 8 AND daughter NOT IN (SELECT daughter FROM sure) AND daughter IN (SELECT mother FROM sure))
SELECT * FROM sure UNION SELECT * FROM r""")
def overlap_links(spark, sf_dir):
    mask, found = _frames(spark, sf_dir)
    return T.overlap_links(T.frame_overlaps(mask), found, 0.6, 4, 0.5, 8)


@query()
def greedy_assignment(spark, sf_dir):
    mask, _ = _frames(spark, sf_dir)
    shape = P.region_properties(mask, ("t", "label")).withColumn("cell_id", T.cell_name(F.col("t"), F.col("label")))
    shape = shape.withColumns({"features": F.array("major_axis", "minor_axis", F.col("area").cast("double")), "area": F.col("area").cast("double")})
    return T.assign(T.transition_features(shape, T.frame_overlaps(mask)))


@query("""WITH RECURSIVE steps AS (SELECT p_partkey AS d, p_partkey // 3 AS m, CASE WHEN count(*) OVER w > 1 THEN '.' || row_number() OVER (PARTITION BY p_partkey // 3 ORDER BY CAST(p_partkey AS VARCHAR)) ELSE '' END AS s FROM part WHERE p_partkey // 3 IN (SELECT p_partkey FROM part) AND p_partkey // 3 <> p_partkey WINDOW w AS (PARTITION BY p_partkey // 3)),
f AS (SELECT p_partkey AS d, row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) AS n FROM part WHERE p_partkey NOT IN (SELECT d FROM steps)),
line(d, l) AS (SELECT d, CAST(n AS VARCHAR) FROM f UNION ALL SELECT steps.d, line.l || steps.s FROM line JOIN steps ON steps.m = line.d) SELECT CAST(d AS VARCHAR) AS cell_id, l AS lineage FROM line""")
def lineage_names(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.floor(F.col("p_partkey") / 3).alias("m"))
    links = p.where("m <> p_partkey").join(p.select(F.col("p_partkey").alias("m")).hint("merge"), "m", "left_semi").select(F.col("m").cast("string").alias("mother"), F.col("p_partkey").cast("string").alias("daughter"))
    return T.lineages(p.select(F.lit(0).alias("t"), F.col("p_partkey").cast("string").alias("cell_id")), links)


@query("""WITH RECURSIVE a(generation, cell_id) AS (SELECT 1, max(p_partkey) // 2 FROM part UNION ALL SELECT generation + 1, cell_id // 2 FROM a WHERE generation < 5 AND cell_id // 2 > 0) SELECT CAST(generation AS INTEGER) AS generation, CAST(cell_id AS VARCHAR) AS cell_id FROM a""")
def lineage_ancestors(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    links = p.where("p_partkey > 1").select(F.floor(F.col("p_partkey") / 2).cast("string").alias("mother"), F.col("p_partkey").cast("string").alias("daughter")).where("mother <> '0'")
    return T.relatives(links, str(p.agg(F.max("p_partkey")).first()[0]), 5)


@query(f"""WITH {MASK_SQL}, r AS (SELECT DISTINCT image_id, label FROM mask WHERE y BETWEEN 2 AND 4 AND x BETWEEN 2 AND 4), c AS (SELECT image_id, label, count(*) AS area, sqrt(pow(avg(y) - 3.5, 2) + pow(avg(x) - 3.5, 2)) AS d FROM mask GROUP BY 1, 2),
k AS (SELECT c.image_id, c.label, d, row_number() OVER (PARTITION BY c.image_id ORDER BY d, area DESC, c.label) AS k FROM c JOIN r USING (image_id, label))
SELECT c.image_id, c.label, coalesce(k = 1, false) AS is_central, round(k.d, 5) AS distance_to_center_px FROM c LEFT JOIN k USING (image_id, label)""")
def central_selection(spark, sf_dir):
    mask = halves(spark, sf_dir)
    found = P.central_selection(mask, P.region_properties(mask), 8, 8, 1)
    return found.select("image_id", "label", "is_central", F.round("distance_to_center_px", 5).alias("distance_to_center_px"))


@query(f"""WITH {PIXELS_SQL}, m AS (SELECT image_id, avg(value) FILTER (value > 0.3) AS own, avg(value) FILTER (abs(y - 4) <= 2 AND abs(x - 4) <= 2) AS mid FROM px GROUP BY 1)
SELECT image_id, 'p' AS channel, round(coalesce(own, mid), 5) AS mean FROM m""")
def roi_or_centre_means(spark, sf_dir):
    p = patch(spark, sf_dir)
    return rounded(P.roi_or_centre_means(p.withColumn("channel", F.lit("p")), p.where("value > 0.3"), 8, 8), 5)


@query(f"WITH {PIXELS_SQL} SELECT image_id, CAST(y // 2 AS INTEGER) AS y, CAST(x // 2 AS INTEGER) AS x, min(value) AS value FROM px GROUP BY ALL")
def block_minimum(spark, sf_dir):
    return P.block_minimum(patch(spark, sf_dir), 2)


@query(f"WITH {PIXELS_SQL} SELECT image_id, y, x, round(value, 6) AS value FROM px")
def tile_round_trip(spark, sf_dir):
    return rounded(P.untile(P.tiles(patch(spark, sf_dir), 8, 8, 5, 1)))


@query(f"WITH {PIXELS_SQL} SELECT image_id, CAST(y - 1 AS INTEGER) AS y, CAST(x - 1 AS INTEGER) AS x, value FROM px WHERE y BETWEEN 1 AND 6 AND x BETWEEN 1 AND 6")
def crop_edges(spark, sf_dir):
    return P.crop_edges(patch(spark, sf_dir), 8, 8, 0.125)


@query(f"""WITH {MASK_SQL}, {_DISK.format(r=1)} SELECT m.image_id, m.y, m.x, round(m.value, 6) AS value, round(min(p.value), 6) AS min, round(max(p.value), 6) AS max, round(stddev_pop(p.value), 5) AS std, round(avg(p.value), 5) AS mean
FROM mask m, disk, px p WHERE p.image_id = m.image_id AND p.y = m.y + dy AND p.x = m.x + dx GROUP BY ALL""")
def local_statistics(spark, sf_dir):
    return rounded(P.local_stats(patch(spark, sf_dir), halves(spark, sf_dir)), std=5, mean=5)


@query(f"WITH {MASK_SQL}, {_DISK.format(r=1)} SELECT DISTINCT m.image_id, m.label, n.label AS neighbour FROM mask m, disk, mask n WHERE n.image_id = m.image_id AND n.y = m.y + dy AND n.x = m.x + dx AND n.label <> m.label")
def region_neighbours(spark, sf_dir):
    return P.neighbours(halves(spark, sf_dir), 1)


@query(f"WITH {MASK_SQL} SELECT m.image_id, m.y, m.x, count(n.y) AS n FROM mask m LEFT JOIN mask n ON n.image_id = m.image_id AND abs(n.y - m.y) <= 1 AND abs(n.x - m.x) <= 1 AND (n.y <> m.y OR n.x <> m.x) GROUP BY 1, 2, 3")
def neighbour_counts(spark, sf_dir):
    return P.neighbour_counts(halves(spark, sf_dir).select("image_id", "y", "x"))


# ---- profiles --------------------------------------------------------------


@query(f"WITH {POINTS_SQL}, f AS (SELECT vec_id, avg(v) FILTER (i < 32) < avg(v) AS flipped FROM pt GROUP BY 1) SELECT vec_id, flipped, CAST(CASE WHEN flipped THEN 63 - i ELSE i END AS INTEGER) AS i, v FROM pt JOIN f USING (vec_id)")
def profile_reorient(spark, sf_dir):
    r = profiles(spark, sf_dir).select("vec_id", V.reorient(F.col("p")).alias("r"))
    return r.select("vec_id", "r.flipped", F.posexplode("r.profile").alias("i", "v"))


@query(f"""WITH {POINTS_SQL}, d AS (SELECT *, abs(v - lag(v) OVER (PARTITION BY vec_id ORDER BY i)) AS d FROM pt)
SELECT vec_id, round(avg(v), 5) AS midline_mean, round(max(v), 6) AS midline_max, round(avg(d), 5) AS midline_gradient_mean, round(max(d), 6) AS midline_gradient_max, round(arg_max(i, v) / 63, 6) AS midline_peak_position, round(max(v), 6) AS midline_peak_value FROM d GROUP BY 1""")
def profile_scalars(spark, sf_dir):
    return rounded(profiles(spark, sf_dir).select("vec_id", V.profile_summary(F.col("p")).alias("s")).select("vec_id", "s.*"), midline_mean=5, midline_gradient_mean=5)


@query(f"""WITH {POINTS_SQL}, g AS (SELECT *, abs(CASE WHEN i = 0 THEN lead(v) OVER w - v WHEN i = 63 THEN v - lag(v) OVER w ELSE (lead(v) OVER w - lag(v) OVER w) / 2 END) AS g FROM pt WINDOW w AS (PARTITION BY vec_id ORDER BY i))
SELECT vec_id, round(avg(v), 5) AS mean, round(stddev_pop(v), 5) AS std, round(min(v), 5) AS min, round(max(v), 5) AS max, round(max(v) - min(v), 5) AS range, round(avg(g), 5) AS gradient_mean, round(max(g), 5) AS gradient_max,
  round(avg(v) FILTER (i < 32) - avg(v) FILTER (i >= 32), 5) AS polar_diff, round(arg_max(i, v) / 64, 5) AS peak_position, round(max(v), 5) AS peak_value FROM g GROUP BY 1""")
def profile_gradient(spark, sf_dir):
    return rounded(profiles(spark, sf_dir).select("vec_id", V.profile_features(F.col("p")).alias("s")).select("vec_id", "s.*").drop("polar_ratio"), 5)


@query(f"""WITH {POINTS_SQL}, m AS (SELECT vec_id, avg(abs(v)) FILTER (i < 6) AS a, avg(abs(v)) FILTER (i >= 58) AS b, avg(abs(v)) FILTER (i >= 29 AND i < 35) AS c FROM pt GROUP BY 1), f AS (SELECT *, abs(a - b) / (a + b + 1e-10) AS s, c / (0.5 * (a + b) + 1e-10) AS e FROM m)
SELECT vec_id, round(a, 5) AS "poleA", round(b, 5) AS "poleB", round(c, 5) AS center, round(s, 5) AS polar_asym, round(e, 5) AS center_enrichment, CAST(CASE WHEN e >= 1.5 THEN 3 WHEN s >= 0.3 THEN 1 ELSE 2 END AS INTEGER) AS state FROM f""")
def hada_features_state(spark, sf_dir):
    p = profiles(spark, sf_dir).select("vec_id", V.pole_features(F.transform("p", F.abs)).alias("f")).select("vec_id", "f.*")
    return rounded(p.withColumn("state", V.pole_state(F.col("polar_asym"), F.col("center_enrichment"))), 5)


@query(f"""WITH {POINTS_SQL}, f AS (SELECT vec_id, avg(v) FILTER (i < 32) < avg(v) AS f FROM pt GROUP BY 1), o AS (SELECT pt.vec_id, CASE WHEN f THEN 63 - i ELSE i END AS i, v FROM pt JOIN f USING (vec_id)),
g AS (SELECT vec_id, k, (k - 8) * 63 / 15.0 AS pos FROM (SELECT DISTINCT vec_id FROM pt), (SELECT unnest(range(0, 32)) AS k)),
j AS (SELECT g.vec_id, k, CASE WHEN k < 8 OR k >= 24 THEN 0 ELSE a.v + (b.v - a.v) * (pos - floor(pos)) END AS v FROM g LEFT JOIN o a ON a.vec_id = g.vec_id AND a.i = floor(pos) LEFT JOIN o b ON b.vec_id = g.vec_id AND b.i = least(floor(pos) + 1, 63))
SELECT vec_id, CAST(k AS INTEGER) AS k, round(v, 5) AS v FROM j""")
def demograph_resample(spark, sf_dir):
    d = profiles(spark, sf_dir).select("vec_id", V.demograph_row(F.col("p"), F.lit(4.0), 32, 8.0).alias("d"))
    return d.select("vec_id", F.posexplode("d.row").alias("k", "v")).withColumn("v", F.round("v", 5))


@query(f"WITH {POINTS_SQL}, d AS (SELECT *, v - lag(v) OVER (PARTITION BY vec_id ORDER BY i) AS d FROM pt) SELECT vec_id, round(sum(sqrt(1 + d * d)) * 0.5, 5) AS length FROM d GROUP BY 1")
def polyline_length(spark, sf_dir):
    xs = F.transform("p", lambda _, i: i.cast("double"))
    return rounded(profiles(spark, sf_dir).select("vec_id", G.polyline_length(xs, F.col("p"), 0.5).alias("length")), 5)


@query(f"""WITH {POINTS_SQL}, a AS (SELECT vec_id, i, atan2(v - lag(v, 2) OVER w, 2.0) AS a, atan2(lead(v, 2) OVER w - v, 2.0) AS b FROM pt WINDOW w AS (PARTITION BY vec_id ORDER BY i))
SELECT vec_id, CAST(i - 2 AS INTEGER) AS k, round(degrees(b - a), 4) AS angle FROM a WHERE i BETWEEN 2 AND 61""")
def bend_angle(spark, sf_dir):
    xs = F.transform("p", lambda _, i: i.cast("double"))
    out = profiles(spark, sf_dir).select("vec_id", F.posexplode(G.bend_angles(xs, F.col("p"), 2)).alias("k", "angle"))
    return out.withColumn("angle", F.round("angle", 4))


@query(f"""WITH {POINTS_SQL}, q AS (SELECT vec_id, quantile_cont(v, 0.05) AS l, quantile_cont(v, 0.95) AS h FROM pt GROUP BY 1) SELECT vec_id, i, round(greatest(0, least((v - l) / (h - l), 1)), 5) AS v FROM pt JOIN q USING (vec_id)""")
def percentile_stretch(spark, sf_dir):
    n = profiles(spark, sf_dir).select("vec_id", F.posexplode(V.percentile_normalize(F.col("p"), 5, 95)).alias("i", "v"))
    return n.withColumn("v", F.round("v", 5))


@query(f"""WITH {POINTS_SQL}, j AS (SELECT a.vec_id, a.v AS x, b.v AS y FROM pt a JOIN pt b ON b.vec_id = a.vec_id + 1 AND b.i = a.i) SELECT vec_id, round(corr(x, y), 5) AS correlation, round(greatest(0, 1 - avg(coalesce(abs(abs(x) - abs(y)) / nullif((abs(x) + abs(y)) / 2, 0), 0))), 5) AS similarity FROM j GROUP BY 1""")
def pairwise_similarity(spark, sf_dir):
    p = profiles(spark, sf_dir)
    pairs = p.join(p.select((F.col("vec_id") - 1).alias("vec_id"), F.col("p").alias("q")), "vec_id")
    return rounded(pairs.select("vec_id", V.correlation(F.col("p"), F.col("q")).alias("correlation"), V.difference(F.transform("p", F.abs), F.transform("q", F.abs)).alias("similarity")), 5)


# ---- geometry --------------------------------------------------------------


@query("""WITH b AS (SELECT *, l_partkey % 97 AS r1, l_suppkey % 89 AS c1, l_partkey % 97 + 9 + l_linenumber AS r2, l_suppkey % 89 + 7 AS c2 FROM lineitem), s AS (SELECT *, greatest(20, r2 - r1 + 12, c2 - c1 + 12) AS side FROM b)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round_even((r1 + r2) / 2, 0) - side // 2 AS INTEGER) AS y0, CAST(round_even((r1 + r2) / 2, 0) - side // 2 + side AS INTEGER) AS y1,
  CAST(round_even((c1 + c2) / 2, 0) - side // 2 AS INTEGER) AS x0, CAST(round_even((c1 + c2) / 2, 0) - side // 2 + side AS INTEGER) AS x1 FROM s""")
def crop_window_geometry(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem")
    r1, c1 = (F.col("l_partkey") % 97).cast("int"), (F.col("l_suppkey") % 89).cast("int")
    w = G.crop_window(r1, c1, r1 + 9 + F.col("l_linenumber"), c1 + 7, F.lit(None).cast("double"), F.lit(None).cast("double"), 20, 6)
    return t.select(*KEYS, w.alias("w")).select(*KEYS, *[F.col(f"w.{k}").cast("int").alias(k) for k in ("y0", "y1", "x0", "x1")])


@query("""WITH b AS (SELECT *, l_partkey % 97 AS r1, l_suppkey % 89 AS c1, l_partkey % 97 + 9 AS r2, l_suppkey % 89 + 7 AS c2 FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, greatest(0, r1 - 10) AS r1, greatest(0, c1 - 10) AS c1, least(99, r2 + 10) AS r2, least(99, c2 + 10) AS c2, least(r1, c1, 100 - r2 - 1, 100 - c2 - 1) <= 5 AS touching FROM b""")
def padded_box(spark, sf_dir):
    r1, c1 = F.col("l_partkey") % 97, F.col("l_suppkey") % 89
    return table(spark, sf_dir, "lineitem").select(*KEYS, G.padded_box(F.lit(100), F.lit(100), r1, c1, r1 + 9, c1 + 7, 10).alias("b")).select(*KEYS, "b.*")


# ---- sweeps and monitoring -------------------------------------------------


@query("SELECT a AS area_min, b AS area_max, c AS l_returnflag, (SELECT count(*) FROM lineitem WHERE l_returnflag = c AND l_quantity BETWEEN a AND b) AS n_cells FROM (VALUES (1), (10), (20)) x(a), (VALUES (30), (50)) y(b), (VALUES ('A'), ('N'), ('X')) z(c)")
def grid_sweep(spark, sf_dir):
    """Every combination of bounds and flags, with the cells that it finds."""
    grid = SW.grid(spark, {"area_min": [1, 10, 20], "area_max": [30, 50], "l_returnflag": ["A", "N", "X"]})
    sizes = cells(spark, sf_dir).groupBy("l_returnflag", "area_px").agg(F.count("*").alias("n"))
    hit = grid.join(sizes.withColumnRenamed("l_returnflag", "flag"), (F.col("l_returnflag") == F.col("flag")) & F.col("area_px").between(F.col("area_min"), F.col("area_max")), "left")
    return hit.groupBy("area_min", "area_max", "l_returnflag").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_cells"))


@query("SELECT a AS area_min, b AS area_max, (SELECT count(*) FROM lineitem) AS n_cells, (SELECT count(*) FROM lineitem WHERE l_quantity BETWEEN a AND b) AS n_passed FROM (VALUES (1), (10), (20)) x(a), (VALUES (30), (50)) y(b)")
def filter_sweep(spark, sf_dir):
    grid = SW.grid(spark, {"area_min": [1, 10, 20], "area_max": [30, 50]})
    return SW.filter_sweep(cells(spark, sf_dir), grid).join(grid, "config_id").drop("config_id")


@query("""WITH g AS (SELECT user_id, ts AS until, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS since FROM events) SELECT user_id, epoch_us(since) AS since_us, epoch_us(until) AS until_us, round((epoch_us(until) - epoch_us(since)) / 1e6, 3) AS seconds
FROM g WHERE epoch_us(until) - epoch_us(since) > 3600000000""")
def stall_detector(spark, sf_dir):
    from cytoframe.streaming.monitor import gaps

    g = gaps(table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts")), "user_id", "ts", 3600.0)
    return g.select("user_id", F.unix_micros("since").alias("since_us"), F.unix_micros("until").alias("until_us"), F.round("seconds", 3).alias("seconds"))


# ---- image kernels ---------------------------------------------------------


def planes(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("string").alias("image_id"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.transform("embedding", lambda v: v.cast("double")).alias("pixels"))


@query("""WITH RECURSIVE m AS (SELECT CAST(vec_id AS VARCHAR) AS image_id, i - 1 AS p, (i - 1) // 8 AS y, (i - 1) % 8 AS x FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings) WHERE embedding[i] > 0.3),
e AS (SELECT a.image_id, a.p, b.p AS q FROM m a JOIN m b ON a.image_id = b.image_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1), r(image_id, p, q) AS (SELECT image_id, p, p FROM m UNION SELECT r.image_id, r.p, e.q FROM r JOIN e ON e.image_id = r.image_id AND e.p = r.q),
c AS (SELECT image_id, p, min(q) AS root FROM r GROUP BY 1, 2) SELECT image_id, CAST(dense_rank() OVER (PARTITION BY image_id ORDER BY root) AS INTEGER) AS label, count(*) AS area FROM c GROUP BY image_id, root""")
def label_components(spark, sf_dir):
    p = planes(spark, sf_dir).withColumn("labels", F.transform("pixels", lambda v: (v > 0.3).cast("int"))).drop("pixels")
    return P.unfold_masks(S.label_components(p)).groupBy("image_id", "label").agg(F.count("*").alias("area"))


@query()
def segment_planes(spark, sf_dir):
    return P.unfold_masks(S.label_planes(planes(spark, sf_dir), 1, 2, 2)).groupBy("image_id", "label").agg(F.count("*").alias("area"))


@query()
def drift_shifts(spark, sf_dir):
    p = planes(spark, sf_dir).withColumn("channel", F.lit("Phase"))
    rolled = p.withColumns({"channel": F.lit("AF405"), "pixels": F.concat(F.slice("pixels", 9, 56), F.slice("pixels", 1, 8))})
    return S.drift_shifts(p.union(rolled.select(p.columns))).withColumns({"dy": F.round("dy", 2), "dx": F.round("dx", 2)})


@query()
def rolling_ball(spark, sf_dir):
    return S.subtract_background(planes(spark, sf_dir), "rolling_ball", radius=3)


@query()
def cell_features(spark, sf_dir):
    p = planes(spark, sf_dir)
    big = p.repartition("image_id").select("image_id", "height", "width", F.transform("pixels", lambda v: (v > 0).cast("int")).alias("labels"), F.create_map(F.lit("Phase"), F.col("pixels"), F.lit("AF405"), F.transform("pixels", F.abs)).alias("planes"))
    f = S.extract_features(big)
    return S.feature_table(f, ["Phase", "AF405"]).select("image_id", "label", "area_px", "perimeter_px", "solidity", "intensity_AF405_mean", "AF405_mean_bgsub", "width_q3_px", "AF405_state_code")


from cytoframe import catalog_networks, catalog_tables  # noqa: E402, F401  their queries register themselves
