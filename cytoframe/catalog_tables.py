"""More registered queries: the tabular spine, identities, labels, exports, geometry and curves, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cytoframe import schemas
from cytoframe.catalog import CELLS_SQL, KEYS, PIXELS_SQL, POINTS_SQL, REGISTRY_SQL, cells, patch, profiles, query, registry, rounded, table
from cytoframe.functions import geometry as G
from cytoframe.functions import identity as ID
from cytoframe.functions import vectors as V
from cytoframe.operators import aggregates as A
from cytoframe.operators import density as D
from cytoframe.operators import export as X
from cytoframe.operators import filtering as FL
from cytoframe.operators import joins as J
from cytoframe.operators import labels as L
from cytoframe.operators import tracking as T
from cytoframe.plans import rules as R
from cytoframe.sources import tables as TB

# ---- identity and text -----------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, substr(sha256(l_orderkey || '|' || l_linenumber || '|' || CAST(round_even(l_partkey / 2, 0) AS BIGINT) || ',' || CAST(round_even(l_suppkey / 2, 0) AS BIGINT)), 1, 16) AS h FROM lineitem")
def metadata_hash_ids(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem")
    return c.select(*KEYS, ID.metadata_hash(F.col("l_orderkey").cast("string"), F.col("l_linenumber"), F.col("l_partkey") / 2, F.col("l_suppkey") / 2).alias("h"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'm2_' || substr(sha256('img_' || l_orderkey || '.tif|' || l_linenumber || '|1,2,' || l_partkey || ',' || l_suppkey), 1, 16) END AS ucid FROM lineitem")
def ucid_of_metadata(spark, sf_dir):
    """Cells within documents get their identity; boxes of three numbers have none."""
    box = F.array(F.lit(1).cast("long"), F.lit(2).cast("long"), "l_partkey", "l_suppkey")
    one = F.struct(F.col("l_linenumber").alias("label"), F.when(F.col("l_linenumber") % 3 == 0, F.slice(box, 1, 3)).otherwise(box).alias("bbox"))
    named = ID.apply_ucids(F.array(one), F.concat(F.lit("/in/img_"), "l_orderkey", F.lit(".tif")))
    return table(spark, sf_dir, "lineitem").select(*KEYS, F.get(named, F.lit(0))["ucid"].alias("ucid"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'AF405' WHEN 1 THEN 'Bod493' WHEN 2 THEN 'Phase' ELSE 'GFP' END || '|AF405|' || CASE WHEN o_orderkey % 2 = 0 THEN 'Cy5' ELSE 'Bod493' END || '|Channel3' AS channels FROM orders")
def channel_names(spark, sf_dir):
    first = F.when(F.col("o_orderkey") % 4 == 0, " HADA").when(F.col("o_orderkey") % 4 == 1, "bodipy ").when(F.col("o_orderkey") % 4 == 2, "").otherwise("GFP")
    given = F.array(first, F.lit("dapi"), F.when(F.col("o_orderkey") % 2 == 0, "Cy5"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(ID.canonical_channels(given, 4), "|").alias("channels"))


@query("""SELECT p_partkey, substr(regexp_replace(p_name || ' (' || p_type || ')', '[^A-Za-z0-9_.-]+', '_', 'g'), 1, 128) AS job, CASE WHEN p_partkey % 5 = 0 THEN 'run' ELSE trim(regexp_replace('..' || p_type || '/', '[^A-Za-z0-9_.-]+', '_', 'g'), '._') END AS slug,
  CASE p_partkey % 4 WHEN 0 THEN true WHEN 1 THEN true ELSE false END AS transient, CASE p_partkey % 4 WHEN 0 THEN 'time limit' WHEN 1 THEN NULL WHEN 2 THEN 'out of memory' ELSE 'ValueError: part ' || p_partkey END AS diagnosis FROM part""")
def names_and_logs(spark, sf_dir):
    """File-safe names, submit errors worth another try, and what a log says ended a job."""
    k = F.col("p_partkey") % 4
    log = F.when(k == 0, "step\nCANCELLED DUE TO TIME LIMIT; connection refused").when(k == 1, "sbatch: Socket timed out").when(k == 2, "slurmstepd: oom-kill event").otherwise(F.concat(F.lit("Traceback\nKeyError: x\nValueError: part "), "p_partkey", F.lit("\nbye")))
    dirty = F.when(F.col("p_partkey") % 5 == 0, "._/ ").otherwise(F.concat(F.lit(".."), "p_type", F.lit("/")))
    return table(spark, sf_dir, "part").select("p_partkey", ID.job_name(F.concat("p_name", F.lit(" ("), "p_type", F.lit(")"))).alias("job"), ID.slug(dirty).alias("slug"), ID.transient_submit_error(log).alias("transient"), ID.diagnose_log(log).alias("diagnosis"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber // 2 AS n_rows, CASE WHEN l_linenumber >= 2 THEN l_partkey + 0.5 END AS first_number, 'x' || l_suppkey AS well FROM lineitem")
def listed_numbers(spark, sf_dir):
    """Rows of six numbers in a text, three at a time, and the well in a file name."""
    text = F.concat(F.col("l_partkey").cast("string"), F.lit(".5, -1e2 ;"), F.repeat(F.lit(" 7 x +8 9e0"), F.col("l_linenumber") - 1), F.lit(" 10"))
    found = ID.numbers_in(text, 6)
    return table(spark, sf_dir, "lineitem").select(*KEYS, F.size(found).alias("n_rows"), F.get(F.get(found, F.lit(0)), F.lit(0)).alias("first_number"), TB.well_of(F.concat(F.lit("a_wellx"), "l_suppkey", F.lit("_b.tif"))).alias("well"))


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE o_totalprice END AS value, CASE o_orderkey % 5 WHEN 0 THEN 'unavailable' WHEN 1 THEN 'invalid' WHEN 2 THEN 'invalid' WHEN 3 THEN 'invalid' ELSE 'ok' END AS status FROM orders")
def finite_numbers(spark, sf_dir):
    k = F.col("o_orderkey") % 5
    text = F.when(k == 1, "NaN").when(k == 2, "-Infinity").when(k == 3, "twelve").when(k == 4, F.col("o_totalprice").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", R.number(text).alias("n")).select("o_orderkey", "n.value", "n.status")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber = 7 THEN 'area unavailable' WHEN l_quantity < 10 THEN 'area too low' WHEN l_quantity > 40 THEN 'area too high' END AS inclusive,
  CASE WHEN l_quantity <= 10 THEN 'area small' WHEN l_quantity >= 40 THEN 'area large' END AS exclusive, greatest(10, least(l_quantity, 40)) AS clamped FROM lineitem""")
def value_ranges(spark, sf_dir):
    q = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(*KEYS, R.bounds("area", F.when(F.col("l_linenumber") != 7, q), 10, 40).alias("inclusive"), R.bounds("area", q, 10, 40, True, ("small", "large")).alias("exclusive"), V.clamp(q, 10.0, 40.0).alias("clamped"))


# ---- rules -----------------------------------------------------------------

_SPELLINGS = [("nested", {"area_px": {"min": 8, "max": 18}, "aspect_ratio": {"min": 0.02}}), ("flat", {"area_min": 8, "area_max": 18, "aspect_ratio_min": 0.02}), ("mixed", {"rules": {"area": {"min": 8}, "area_max": 18, "aspect_ratio": {"min": 0.02}}})]


@query(f"WITH {CELLS_SQL}, s AS (SELECT unnest(['nested', 'flat', 'mixed']) AS spelling) SELECT spelling, count(*) FILTER (included AND area_px BETWEEN 18.0 AND 40.5 AND aspect_ratio >= 0.02) AS n_passed, count(*) FILTER (area_px < 18.0) AS n_below, count(*) FILTER (area_px > 40.5) AS n_above FROM cells, s GROUP BY 1")
def rule_spellings_scaled(spark, sf_dir):
    """Three ways to write one rule, at another pixel size: areas grow with the square of the scale."""
    out = None
    for name, rules in _SPELLINGS:
        f = FL.filter_cells(cells(spark, sf_dir), rules, scale=1.5)
        has = lambda reason: F.count_if(F.contains("filter_reasons", F.lit(reason)))
        row = f.agg(F.count_if("filter_passed").alias("n_passed"), has("area_px:below_min").alias("n_below"), has("area_px:above_max").alias("n_above")).select(F.lit(name).alias("spelling"), "*")
        out = row if out is None else out.union(row)
    return out


@query("SELECT doc_id, CASE WHEN quality IS NULL THEN false ELSE quality * 0.9 + 0.05 >= 0.5 END AS filter_passed FROM documents LEFT JOIN (SELECT doc_id, quality FROM labels) USING (doc_id)")
def classifier_flag(spark, sf_dir):
    classes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("Cell_ID"), (F.col("quality") * 0.9 + 0.05).alias("p_cell"), F.when(F.col("quality") == 1, "cell").otherwise("non_cell").alias("predicted_class"))
    joined = J.join_classes(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("Cell_ID")), classes)
    return FL.with_filter_passed(joined, 0.5).select(F.col("Cell_ID").alias("doc_id"), F.coalesce("filter_passed", F.lit(False)).alias("filter_passed"))


# ---- documents of cells ----------------------------------------------------


def _documents(spark, sf_dir):
    """JSON documents of images with their cells, as a run writes them."""
    metrics = F.struct(F.col("l_quantity").alias("area"), F.col("l_discount").alias("aspect_ratio"), F.create_map(F.lit("Phase"), F.col("l_extendedprice")).alias("intensity"))
    reasons = F.when(F.col("l_returnflag") == "R", F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>"))
    cell = F.struct(F.col("l_linenumber").alias("label"), F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("c"), "l_partkey")).alias("cell_id"), (F.col("l_returnflag") != "R").alias("included"), reasons.alias("failure_reasons"), F.array("l_partkey", "l_suppkey").alias("bbox"), F.array("l_tax", "l_discount").alias("centroid"), metrics.alias("metrics"), (F.col("l_linenumber") == 2).alias("is_central"))
    docs = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("image_id")).agg(F.collect_list(cell).alias("cells"))
    text = F.to_json(F.struct("image_id", F.concat(F.lit("/in/"), "image_id").alias("source_path"), F.when(F.col("image_id").cast("long") % 3 == 0, 1).alias("central_label"), "cells"))
    # The id beside the text, as in a file's name: joins by it need no document to be read, nor to be shuffled again.
    return docs.select("image_id", F.from_json(text, schemas.METADATA).alias("d")).select("image_id", "d.source_path", "d.central_label", "d.cells")


_FLAT_SQL = "flat AS (SELECT CAST(l_orderkey AS VARCHAR) AS image_id, l_linenumber AS label, CASE WHEN l_partkey % 2 = 0 THEN 'c' || l_partkey ELSE l_orderkey || '_' || l_linenumber END AS cell_id, l_returnflag <> 'R' AS included, CASE WHEN l_returnflag = 'R' THEN 'a; b' ELSE '' END AS failure_reasons, CAST(l_partkey AS INTEGER) AS bbox_x1, CAST(l_suppkey AS INTEGER) AS bbox_y1, l_tax AS centroid_y, l_discount AS centroid_x, l_quantity AS area, l_extendedprice AS intensity_Phase, l_linenumber = 2 AS is_central FROM lineitem)"


@query(f"WITH {_FLAT_SQL} SELECT * EXCLUDE (is_central), CAST(NULL AS INTEGER) AS bbox_x2, CAST(NULL AS DOUBLE) AS length_um FROM flat")
def flatten_metadata(spark, sf_dir):
    flat = TB.with_intensity_columns(TB.flatten_cells(_documents(spark, sf_dir)), ["Phase"])
    return flat.select("image_id", "label", "cell_id", "included", "failure_reasons", "bbox_x1", "bbox_y1", "bbox_x2", "centroid_y", "centroid_x", "area", "length_um", "intensity_Phase")


@query(f"WITH {_FLAT_SQL} SELECT image_id, count(*) AS n_cells_total, count(*) FILTER (included) AS n_cells_filtered, string_agg(CAST(label AS VARCHAR), ',' ORDER BY label) AS labels FROM flat GROUP BY 1")
def metadata_documents(spark, sf_dir):
    docs = TB.metadata_documents(TB.flatten_cells(_documents(spark, sf_dir)).select("image_id", "source_path", "label", "included", "area"))
    return docs.select("image_id", "n_cells_total", "n_cells_filtered", F.array_join(F.transform("cells", lambda c: c["label"].cast("string")), ",").alias("labels"))


def _annotations(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0")
    text = F.lit('{"cell_notes": {"1": " seen ", "2": " "}, "cell_overrides": {"1": " Include", "2": "EXCLUDE ", "3": "maybe"}}')
    return TB.annotation_maps(o.select(F.col("o_orderkey").cast("string").alias("image_id"), text.alias("json")))


@query(f"WITH {_FLAT_SQL} SELECT image_id, label, cell_id, CASE WHEN a AND label = 1 THEN 'include' WHEN a AND label = 2 THEN 'exclude' END AS override, CASE WHEN a AND label = 1 THEN 'seen' END AS note, CASE WHEN a AND label = 1 THEN true WHEN a AND label = 2 THEN false ELSE included END AS included FROM (SELECT *, image_id IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 2 = 0) AS a FROM flat)")
def annotated_cells(spark, sf_dir):
    return FL.apply_annotations(TB.flatten_cells(_documents(spark, sf_dir)), _annotations(spark, sf_dir)).select("image_id", "label", "cell_id", "override", "note", "included")


@query(f"""WITH {_FLAT_SQL}, f AS (SELECT *, CAST(image_id AS BIGINT) AS k FROM flat), l AS (SELECT image_id, CASE WHEN k % 3 = 0 THEN 1 ELSE max(CASE WHEN is_central THEN label END) END AS central FROM f GROUP BY image_id, k)
SELECT image_id, label, cell_id FROM f JOIN l USING (image_id) WHERE label = central AND k % 5 <> 0 AND k IN (SELECT o_orderkey FROM orders) AND CASE WHEN k % 2 = 0 AND label = 1 THEN true WHEN k % 2 = 0 AND label = 2 THEN false ELSE included END""")
def session_cells(spark, sf_dir):
    """Reviewed cells with a mask and an image, the central one of each."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("image_id"))
    return J.session_cells(_documents(spark, sf_dir), _annotations(spark, sf_dir), ids.where("cast(image_id as long) % 5 <> 0"), ids, True, True).select("image_id", "label", "cell_id")


@query(f"WITH {_FLAT_SQL} SELECT image_id, count(*) AS n FROM flat WHERE included AND CAST(image_id AS BIGINT) % 4 <> 0 AND CAST(image_id AS BIGINT) % 7 <> 0 GROUP BY 1")
def masked_images(spark, sf_dir):
    d = _documents(spark, sf_dir)
    ids = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("image_id")).distinct()
    return J.masks_with_images(ids.where("cast(image_id as long) % 4 <> 0"), d, ids.where("cast(image_id as long) % 7 <> 0")).groupBy("image_id").agg(F.count("*").alias("n"))


@query("""WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS image_id, o_orderkey AS k FROM orders) SELECT image_id, CASE WHEN k % 3 = 0 THEN '/in/' || image_id || '.tif' WHEN k % 3 = 1 THEN '/masks/' || image_id || '.tif' ELSE '/masks/' || image_id || '.png' END AS path FROM o WHERE k % 11 <> 0""")
def resolved_images(spark, sf_dir):
    """The first place where an image lies: where its record says, beside the others, by its name."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("image_id"), (F.col("o_orderkey") % 3).alias("k"), (F.col("o_orderkey") % 11).alias("lost"))
    images = o.select("image_id", F.concat(F.lit("/in/"), "image_id", F.lit(".tif")).alias("source_path"))
    there = o.where("lost <> 0").select(F.explode(F.when(F.col("k") == 0, F.array(F.concat(F.lit("/in/"), "image_id", F.lit(".tif")), F.concat(F.lit("/masks/"), "image_id", F.lit(".png")))).when(F.col("k") == 1, F.array(F.concat(F.lit("/masks/"), "image_id", F.lit(".tif")))).otherwise(F.array(F.concat(F.lit("/masks/"), "image_id", F.lit(".png"))))).alias("path"))
    return TB.first_existing(TB.image_candidates(images, "/masks"), there, "image_id").select("image_id", "path")


# ---- joins, labels and exports ---------------------------------------------


@query(f"""WITH {CELLS_SQL}, crops AS (SELECT l_orderkey AS image_id, l_linenumber AS label, min(l_partkey) AS p FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2)
SELECT c.l_orderkey, c.l_linenumber, c.l_partkey, c.l_suppkey, 'c' || crops.p AS "Cell_ID", coalesce(CASE WHEN c.l_linenumber = 1 THEN s_name END, 'UNK') AS drug FROM cells c JOIN crops USING (image_id, label) JOIN part ON part.p_partkey = crops.p LEFT JOIN supplier ON s_suppkey = c.l_suppkey WHERE p_size > 20""")
def finalize_cells(spark, sf_dir):
    """Cells with a crop that pass the classifier, with their labels by the key in their paths."""
    crops = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'").groupBy(F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("label")).agg(F.concat(F.lit("c"), F.min("l_partkey")).alias("Cell_ID"))
    part = table(spark, sf_dir, "part")
    classes = part.select(F.concat(F.lit("c"), "p_partkey").alias("Cell_ID"), F.when(F.col("p_size") > 20, "cell").otherwise("non_cell").alias("predicted_class"), F.when(F.col("p_size") > 20, 0.9).otherwise(0.1).alias("p_cell"))
    path = F.concat(F.lit("/in/"), ID.pad_number(F.col("l_suppkey"), 4), F.lit("_s0"), F.col("l_linenumber") % 10, F.lit(".tif"))
    c = cells(spark, sf_dir).select(*KEYS, "image_id", "label", F.lit("old").alias("Cell_ID"), path.alias("source_path"))
    labels = table(spark, sf_dir, "supplier").select(F.concat(ID.pad_number(F.col("s_suppkey"), 4), F.lit("_s01")).alias("padmap_id"), F.col("s_name").alias("padmap_drug"))
    return J.finalize(c, crops, classes, labels).select(*KEYS, "Cell_ID", "drug")


@query(f"""WITH {REGISTRY_SQL}, s AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS "Cell_ID", l_tax AS value, l_partkey, l_linestatus FROM lineitem)
SELECT s."Cell_ID", s.value, coalesce(padmap_drug, 'UNK') AS drug FROM s c JOIN s ON s."Cell_ID" = c."Cell_ID" LEFT JOIN registry ON padmap_id = CAST(c.l_partkey AS VARCHAR) WHERE c.l_linestatus = 'O'""")
def propagated_labels(spark, sf_dir):
    """A sibling table takes new labels; rows of cells that went go."""
    key = F.concat_ws("-", *KEYS).alias("Cell_ID")
    c = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'").select(key, F.col("l_partkey").cast("string").alias("padmap_id"))
    siblings = table(spark, sf_dir, "lineitem").select(key, F.col("l_tax").alias("value"), F.lit("old").alias("drug"))
    return L.propagate(L.apply_registry(c, registry(spark, sf_dir)), siblings, columns=("drug",))


@query("SELECT s_suppkey AS id, s_acctbal AS value, CAST(NULL AS VARCHAR) AS segment FROM supplier UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment FROM customer UNION ALL SELECT p_partkey, NULL, p_type FROM part")
def shard_union(spark, sf_dir):
    return TB.union_shards([table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("value")), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value"), F.col("c_mktsegment").alias("segment")), table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("segment"))])


def _exported(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem")
    return c.select(F.concat_ws("-", *KEYS).alias("Cell_ID"), F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("label"), F.col("l_quantity").alias("area_px"), F.when(F.col("l_returnflag") == "R", F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("solidity"), F.when(F.col("l_linestatus") == "O", F.lit("")).otherwise(F.col("l_returnflag")).alias("drug"), (F.col("l_linestatus") == "O").alias("filter_passed"))


_ID_SQL = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"


@query(f"SELECT {_ID_SQL} AS \"Cell_ID\", l_orderkey AS image_id, l_linenumber AS label, l_linestatus = 'O' AS filter_passed, l_quantity AS area_px, CAST(NULL AS VARCHAR) AS predicted_class, CAST(NULL AS VARCHAR) AS filter_reasons FROM lineitem")
def diagnostics_export(spark, sf_dir):
    return X.diagnostics(_exported(spark, sf_dir)).select("Cell_ID", "image_id", "label", "filter_passed", "area_px", "predicted_class", "filter_reasons")


@query(f"SELECT {_ID_SQL} AS \"Cell_ID\", CASE WHEN l_linestatus = 'O' THEN 'UNK' ELSE l_returnflag END AS drug, 'UNK' AS \"GroupLabels_Strict\" FROM lineitem")
def metadata_export(spark, sf_dir):
    return X.metadata(_exported(spark, sf_dir))


@query(f"SELECT {_ID_SQL} AS cell_id, 'area_px' AS feature, l_quantity AS value FROM lineitem UNION ALL SELECT {_ID_SQL}, 'solidity', l_tax FROM lineitem WHERE l_returnflag <> 'R'")
def features_export(spark, sf_dir):
    long = X.features_long(_exported(spark, sf_dir), ["area_px", "solidity", "not_there"])
    return long.where("value is not null and not isnan(value)").select("cell_id", "feature", "value")


@query(f"SELECT {_ID_SQL} AS cell_id, l_quantity AS value FROM lineitem WHERE {_ID_SQL} IN (SELECT {_ID_SQL} FROM lineitem WHERE l_linestatus = 'O')")
def kept_matrix(spark, sf_dir):
    e = _exported(spark, sf_dir)
    return X.kept_columns(X.features_long(e, ["area_px"]).select("cell_id", "value"), e.where("filter_passed"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS \"Cell_ID\", 'metadata' AS only_in FROM part WHERE p_partkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'mapping' FROM customer WHERE c_custkey NOT IN (SELECT p_partkey FROM part)")
def id_differences(spark, sf_dir):
    return X.id_differences(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("Cell_ID")), table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("Cell_ID")))


@query("SELECT o_orderkey AS \"Cell_ID\", '/crops/' || o_orderkey || '.tif' AS crop_path FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 <> 0")
def passed_crops(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    path = F.concat(F.lit("/crops/"), "o_orderkey", F.lit(".tif"))
    return J.passed_crops(o.select(F.col("o_orderkey").alias("Cell_ID"), path.alias("crop_path")), o.select(F.col("o_orderkey").alias("Cell_ID"), (F.col("o_orderstatus") == "F").alias("filter_passed")), o.where("o_orderkey % 3 <> 0").select(path.alias("path"))).select("Cell_ID", "crop_path")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS cell_id, s_name AS plate, CAST(NULL AS VARCHAR) AS drug FROM supplier UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, c_mktsegment FROM customer")
def lookup_extended(spark, sf_dir):
    return J.add_cells(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("cell_id"), F.col("s_name").alias("plate")), table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("cell_id"), F.col("c_mktsegment").alias("drug")))


@query("""WITH f AS (SELECT o_custkey AS base, o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'Phase' WHEN 1 THEN 'AF405' ELSE 'GFP' END AS channel FROM orders), p AS (SELECT base, channel, min('/d/' || base || '_' || channel || '_' || o_orderkey) AS path FROM f GROUP BY 1, 2),
i AS (SELECT DISTINCT base FROM f), w AS (SELECT base, c.channel, c.rank FROM i, (VALUES ('Phase', 0), ('AF405', 1), ('Bod493', 2)) c(channel, rank))
SELECT CAST(base AS VARCHAR) AS image_id, channel, path, CAST(rank AS INTEGER) AS rank FROM w LEFT JOIN p USING (base, channel) UNION ALL SELECT CAST(base AS VARCHAR), channel, path, 1048576 FROM p WHERE channel = 'GFP'""")
def channel_paths(spark, sf_dir):
    """For each image its phase, the channels that were asked for, null where one is missing, and all others."""
    k = F.col("o_orderkey") % 3
    f = table(spark, sf_dir, "orders").select(F.lit("/d").alias("dir"), F.col("o_custkey").cast("string").alias("base"), F.when(k == 0, "Phase").when(k == 1, "AF405").otherwise("GFP").alias("channel"), "o_orderkey")
    found = f.groupBy("dir", "base", "channel").agg(F.min(F.concat(F.lit("/d/"), "base", F.lit("_"), "channel", F.lit("_"), "o_orderkey")).alias("path"))
    images = f.select("dir", "base", F.col("base").alias("image_id")).distinct()
    return J.channel_paths(images, found, ["AF405", "Bod493"]).withColumn("rank", F.col("rank").cast("int"))


@query("""WITH m1 AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s FROM lineitem), a AS (SELECT lineitem.* FROM lineitem, m1 WHERE abs((l_extendedprice - m) / s) < 1.5),
m2 AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM a) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM a, m2 WHERE abs((l_quantity - m) / s) < 1.2""")
def outliers_in_turn(spark, sf_dir):
    return A.remove_outliers_batch(table(spark, sf_dir, "lineitem"), {"l_extendedprice": 1.5, "l_quantity": 1.2}).select(*KEYS)


def _tree(spark, sf_dir):
    return table(spark, sf_dir, "part").where("p_partkey > 1").select(F.floor(F.col("p_partkey") / 2).cast("string").alias("mother"), F.col("p_partkey").cast("string").alias("daughter"))


@query("WITH RECURSIVE d(generation, id) AS (SELECT 1, p_partkey FROM part WHERE p_partkey > 1 AND p_partkey // 2 = 1 UNION ALL SELECT generation + 1, p_partkey FROM d JOIN part ON p_partkey // 2 = id WHERE p_partkey > 1 AND generation < 5) SELECT CAST(generation AS INTEGER) AS generation, CAST(id AS VARCHAR) AS cell_id FROM d")
def lineage_descendants(spark, sf_dir):
    return T.relatives(_tree(spark, sf_dir), "1", 5, True)


@query("WITH RECURSIVE d(generation, id) AS (SELECT 1, p_partkey FROM part WHERE p_partkey > 1 AND p_partkey // 2 = 1 UNION ALL SELECT generation + 1, p_partkey FROM d JOIN part ON p_partkey // 2 = id WHERE p_partkey > 1 AND generation < 4) SELECT CAST(generation AS INTEGER) AS generation, CAST(id AS VARCHAR) AS cell_id FROM d")
def lineage_exhaustive(spark, sf_dir):
    """Descendants until two generations after the first of four cells."""
    return T.forward_exhaustive(_tree(spark, sf_dir), "1", 2, 4)


# ---- geometry and curves ---------------------------------------------------


@query("""WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey % 97 AS x1, l_suppkey % 89 AS y1, l_partkey % 53 + 100 AS x2, l_suppkey % 47 + 3 AS y2, l_quantity AS x3, l_linenumber * 7.0 AS y3, l_quantity + 5 AS x4, l_linenumber * 9.0 + 60 AS y4 FROM lineitem),
d AS (SELECT *, (x1 - x2) * (y3 - y4) - (y1 - y2) * (x3 - x4) AS det, x1 * y2 - y1 * x2 AS a, x3 * y4 - y3 * x4 AS b, ((x2 - x1) * (x4 - x3) + (y2 - y1) * (y4 - y3)) / (sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) * sqrt((x4 - x3) ** 2 + (y4 - y3) ** 2)) AS cosine FROM c)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2), 4) AS distance, CAST(sign((x2 - x1) * (y3 - y1) - (y2 - y1) * (x3 - x1)) AS INTEGER) AS side, CASE WHEN det <> 0 THEN round((a * (x3 - x4) - (x1 - x2) * b) / det, 3) END AS meet_x, CASE WHEN det <> 0 THEN round((a * (y3 - y4) - (y1 - y2) * b) / det, 3) END AS meet_y, round(acos(cosine), 4) AS angle FROM d""")
def line_geometry(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem")
    d = lambda x: x.cast("double")
    x1, y1, x2, y2 = d(F.col("l_partkey") % 97), d(F.col("l_suppkey") % 89), d(F.col("l_partkey") % 53 + 100), d(F.col("l_suppkey") % 47 + 3)
    x3, y3, x4, y4 = F.col("l_quantity"), d(F.col("l_linenumber") * 7), F.col("l_quantity") + 5, d(F.col("l_linenumber") * 9 + 60)
    met = G.intersect_lines(x1, y1, x2, y2, x3, y3, x4, y4)
    return c.select(*KEYS, F.round(G.distance(x1, y1, x2, y2), 4).alias("distance"), G.orientation_sign(x1, y1, x2, y2, x3, y3).cast("int").alias("side"), F.round(met["x"], 3).alias("meet_x"), F.round(met["y"], 3).alias("meet_y"), F.round(G.angle_between(x2 - x1, y2 - y1, x4 - x3, y4 - y3), 4).alias("angle"))


@query(f"""WITH {POINTS_SQL}, s AS (SELECT *, v - lag(v) OVER w AS d, lead(v) OVER w - v AS e FROM pt WINDOW w AS (PARTITION BY vec_id ORDER BY i)), n AS (SELECT vec_id, i, CASE WHEN i = 0 THEN e ELSE d END AS d FROM s)
SELECT vec_id, greatest(1, round(sum(CASE WHEN i > 0 THEN sqrt(1 + d * d) ELSE 0 END) / any_value(chord), 3)) AS sinuosity, round(sum(-d / sqrt(1 + d * d)), 4) AS normal_x, round(sum(1 / sqrt(1 + d * d)), 4) AS normal_y FROM n JOIN (SELECT vec_id, sqrt(63 * 63 + (max(v) FILTER (i = 63) - max(v) FILTER (i = 0)) ** 2) AS chord FROM pt GROUP BY 1) USING (vec_id) GROUP BY vec_id""")
def curve_geometry(spark, sf_dir):
    p = profiles(spark, sf_dir).withColumn("x", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: i.cast("double")))
    normals = G.unit_normals(F.col("x"), F.col("p"))
    total = lambda c: F.round(F.aggregate(F.transform(normals, lambda n: n[c]), F.lit(0.0), lambda a, b: a + b), 4)
    return p.select("vec_id", G.sinuosity(F.col("x"), F.col("p")).alias("sinuosity"), total("x").alias("normal_x"), total("y").alias("normal_y"))


@query(f"""WITH {POINTS_SQL}, b AS (SELECT vec_id, i, CAST(v > 0 AS INTEGER) AS v FROM pt), s AS (SELECT vec_id, i, lead(v) OVER w + v AS after, lag(v) OVER w + lag(v, 2) OVER w AS before FROM b WINDOW w AS (PARTITION BY vec_id ORDER BY i)) SELECT vec_id, CAST(min(i) FILTER (after - before = 2) AS INTEGER) AS turn FROM s GROUP BY 1""")
def turn_points(spark, sf_dir):
    steps = F.transform("p", lambda v: (v > 0).cast("double"))
    return profiles(spark, sf_dir).select("vec_id", V.find_turn_point(steps).alias("turn"))


@query(f"""WITH {POINTS_SQL}, t AS (SELECT vec_id, quantile_cont(v, 0.99) AS t, min(v) AS lo, max(v) AS hi FROM pt GROUP BY 1), g AS (SELECT vec_id, greatest(t - v, 0) AS inv, (v - lo) / (hi - lo) AS unit FROM pt JOIN t USING (vec_id)),
m AS (SELECT vec_id, max(inv) AS top FROM g GROUP BY 1) SELECT vec_id, round(sum(inv / top), 4) AS inverted, round(sum(sqrt(unit)), 4) AS gamma FROM g JOIN m USING (vec_id) GROUP BY 1""")
def brightness(spark, sf_dir):
    """The inverted stretch, and the gamma stretch by its sum before it is cut to levels."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    unit = F.transform(V.adjust_gamma(F.col("p"), 0.5, 1e9), lambda x: x / 1e9)
    return profiles(spark, sf_dir).select("vec_id", F.round(total(V.invert_normalize(F.col("p"))), 4).alias("inverted"), F.round(total(unit), 4).alias("gamma"))


@query(f"""WITH {POINTS_SQL}, q AS (SELECT vec_id, quantile_cont(v, 0.005) AS l, quantile_cont(v, 0.995) AS h FROM pt GROUP BY 1), n AS (SELECT vec_id, i, greatest(0, least(1, (v - l) / (h - l))) AS x FROM pt JOIN q USING (vec_id)), m AS (SELECT vec_id, avg(x) FILTER (i % 2 = 0) AS m FROM n GROUP BY 1)
SELECT vec_id, round(sum(x ** (ln(0.3) / ln(m))), 3) AS total FROM n JOIN m USING (vec_id) GROUP BY 1""")
def background_gamma(spark, sf_dir):
    mask = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: i % 2)
    return profiles(spark, sf_dir).select("vec_id", F.round(F.aggregate(V.normalize_to_background(F.col("p"), mask), F.lit(0.0), lambda s, x: s + x), 3).alias("total"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(least(l_quantity, l_linenumber * 8.0) / greatest(l_quantity, l_linenumber * 8.0), 6) AS ratio, round(exp(-1 * pow(l_quantity * 0.1, 2) / 4) / sqrt(4 * pi()), 6) AS probability, round(CASE WHEN l_tax = 0.04 THEN 0 ELSE sign(l_tax - 0.04) * log10(abs(l_tax - 0.04)) END, 4) AS log_hu,
  round(CASE WHEN l_quantity - 2 * l_linenumber + l_tax = 0 THEN 0 ELSE 0.5 * (l_quantity - l_tax) / (l_quantity - 2 * l_linenumber + l_tax) END, 4) AS vertex FROM lineitem""")
def pair_numbers(spark, sf_dir):
    """Ratios of sizes, the chance of a distance, logarithms of signed moments, and parabolas' vertices."""
    q, n, tax = F.col("l_quantity"), F.col("l_linenumber").cast("double"), F.col("l_tax")
    return rounded(table(spark, sf_dir, "lineitem").select(*KEYS, V.norm_ratio(q, n * 8).alias("ratio"), V.distance_probability(q * 0.1).alias("probability"), V.log_hu(tax - 0.04).alias("log_hu"), V.parabola_offset(q, n, tax).alias("vertex")), log_hu=4, vertex=4)


@query("SELECT o_orderkey, '0.065' AS pixel, CAST(o_custkey AS VARCHAR) AS slices, CAST(NULL AS VARCHAR) AS missing FROM orders")
def imagej_description(spark, sf_dir):
    f = G.imagej_fields(F.concat(F.lit("ImageJ=1.53\nspacing = 0.065\n slices = "), "o_custkey", F.lit("\nnote = a = b")))
    return table(spark, sf_dir, "orders").select("o_orderkey", f["spacing"].alias("pixel"), f["slices"].alias("slices"), f["none"].alias("missing"))


# ---- densities -------------------------------------------------------------


@query(f"""WITH {PIXELS_SQL}, l AS (SELECT image_id, max(value) AS len FROM px GROUP BY 1), e AS (SELECT quantile_cont(len, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS e FROM l),
c AS (SELECT image_id, len(list_filter(e, lambda v: v <= l.len)) - 1 AS k FROM l, e WHERE l.len < e[6]), s AS (SELECT k, value AS w, x / 7 AS x, y / 7 AS y FROM px JOIN c USING (image_id) WHERE value > 0.25),
m AS (SELECT k, count(*) AS n, sum(w) AS s, sum(w * w) AS s2, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my, sum(w * x * x) AS sxx, sum(w * y * y) AS syy, sum(w * x * y) AS sxy FROM s GROUP BY 1),
v AS (SELECT k, n, (sxx / s - mx * mx) * f AS cxx, (syy / s - my * my) * f AS cyy, (sxy / s - mx * my) * f AS cxy FROM (SELECT *, pow(s * s / s2, -1 / 3) / (1 - s2 / (s * s)) AS f FROM m WHERE n > 2)),
g AS (SELECT r, c FROM range(13) t(r), range(8) u(c)), z AS (SELECT k, n, r, g.c, sum(w * exp(-0.5 * (cyy * pow(g.c / 7 - x, 2) + cxx * pow(r / 12 - y, 2) - 2 * cxy * (g.c / 7 - x) * (r / 12 - y)) / (cxx * cyy - cxy * cxy))) AS z FROM s JOIN v USING (k), g GROUP BY ALL)
SELECT CAST(k AS INTEGER) AS length_class, n AS n_spots, CAST(r AS INTEGER) AS grid_row, CAST(c AS INTEGER) AS grid_column, round(z / max(z) OVER (PARTITION BY k), 6) AS density FROM z""")
def spot_density(spark, sf_dir):
    px = patch(spark, sf_dir)
    classes = D.length_classes(px.groupBy(F.col("image_id").alias("cell_id")).agg(F.max("value").alias("length")))
    spots = px.where("value > 0.25").select(F.col("image_id").alias("cell_id"), (F.col("x") / 7).alias("x"), (F.col("y") / 7).alias("y"), F.col("value").alias("peak_intensity"))
    return rounded(D.spot_density(spots, classes, across=8, along=13))
