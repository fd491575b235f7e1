import datetime as dt
import hashlib
import json
import os
import subprocess
import sys

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from jobs import archive_logs, common, publish_cells

CELLS = common.load_config(None, "publish_cells.json", publish_cells.REQUIRED)
LOGS = common.load_config(None, "archive_logs.json", archive_logs.REQUIRED)
SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


# ---- cells -----------------------------------------------------------------


def write_cells(spark, folder, orders=None):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    (o if orders is None else o.where(orders)).write.mode("overwrite").parquet(f"{folder}/orders")
    line = spark.read.parquet(f"{SF}/lineitem.parquet").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey", "left_outer")
    kept = line if orders is None else line.where(F.expr(orders))
    kept.drop("o_orderdate").write.mode("overwrite").parquet(f"{folder}/lineitem")


def publish(spark, folder, out):
    return publish_cells.run(spark, f"{folder}/lineitem", f"{folder}/orders", f"{SF}/part.parquet", out, CELLS)


def test_cells_grow_and_runs_repeat(spark, tmp_path):
    some, out, whole = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "whole")
    write_cells(spark, some, "o_orderdate < '1997-01-01'")
    publish(spark, some, out)
    early = rows(publish_cells.read_output(spark, out))
    assert publish(spark, some, out)["cells"] == len(early) and rows(publish_cells.read_output(spark, out)) == early
    write_cells(spark, some, "o_orderdate >= '1997-01-01'")  # the later months alone: the others stay
    publish(spark, some, out)
    both = rows(publish_cells.read_output(spark, out))
    write_cells(spark, some)
    publish(spark, some, whole)
    publish(spark, some, out)
    assert set(early) < set(both) and rows(publish_cells.read_output(spark, whole)) == both == rows(publish_cells.read_output(spark, out))
    assert {d for d in os.listdir(out) if d.startswith("month=")} == {f"month={r.month}" for r in publish_cells.read_output(spark, out).select("month").distinct().collect()}


def test_published_cell_by_cell(spark):
    cells = spark.createDataFrame(
        [("1", 1, 0, 0, 5, 5, 20.0, 0.05, 0.99, 7.0, True, "d"), ("1", 2, 0, 0, 5, 5, 17.9, 0.01, 0.5, 7.0, True, "x"), ("2", 1, 0, 0, 5, 5, 45.1, 0.05, 0.99, None, False, None), ("9", 1, 0, 0, 5, 5, None, float("nan"), 0.99, 7.0, True, "d"), ("9", 1, 0, 0, 5, 5, None, float("nan"), 0.99, 7.0, True, "d")],
        "image_id string, label int, bbox_min_row long, bbox_min_col long, bbox_max_row long, bbox_max_col long, area_px double, aspect_ratio double, solidity double, intensity double, included boolean, padmap_id string",
    )
    images = spark.createDataFrame([("1", "/a/b.tif", dt.datetime(2026, 3, 5)), ("1", "/a/c.tif", dt.datetime(2026, 4, 5)), ("2", "/a/d.tif", None)], "image_id string, source_path string, acquired timestamp")
    registry = spark.createDataFrame([("d", "drug"), ("d", "later"), ("x", None)], "padmap_id string, padmap_drug string")
    got = publish_cells.published(cells, images, registry, CELLS).orderBy("image_id", "label").collect()
    assert [r.filter_reasons for r in got] == ["", "area_px:below_min;aspect_ratio:below_min;solidity:below_min", "segmenter_excluded;area_px:above_max", "area_px:not_finite;aspect_ratio:not_finite", "area_px:not_finite;aspect_ratio:not_finite"]
    assert [(r.drug, r.month, r.filter_passed) for r in got] == [("drug", "2026-03", True), ("UNK", "2026-03", False), ("UNK", "unknown", False), ("drug", "unknown", False), ("drug", "unknown", False)]
    assert got[0].cell_id == "sc_" + hashlib.sha256(b"b.tif|1|0,0,5,5").hexdigest()[:16] and got[3].cell_id == got[4].cell_id == "sc_" + hashlib.sha256(b"9|1|0,0,5,5").hexdigest()[:16]


def test_cells_are_shuffled_as_narrow_as_they_are_read(spark):
    cells, images, registry = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("lineitem", "orders", "part"))
    named = [common.selected(t, CELLS[n]) for t, n in ((cells, "cells"), (images, "images"), (registry, "registry"))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        late = publish_cells.published(cells, *named[1:], CELLS, CELLS["cells"])
        plan = late._jdf.queryExecution().executedPlan().toString()
        assert rows(late) == rows(publish_cells.published(*named, CELLS))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    # The reasons and boxes are made above the last shuffle alone, which is that of the months.
    assert "below_min" not in plan[plan.index("REBALANCE") :] and "below_min" in plan[: plan.index("REBALANCE")]
    assert "bbox_min_row" not in plan[plan.index("REBALANCE") :]


def test_no_cells(spark, tmp_path):
    write_cells(spark, str(tmp_path / "in"), "false")
    counts = publish(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert counts == {"cells": 0, "passed": 0, "unlabelled": 0, "without_month": 0} and publish_cells.read_output(spark, str(tmp_path / "out")).count() == 0


# ---- logs ------------------------------------------------------------------


def add_logs(spark, folder, part, data):
    spark.createDataFrame(data, "doc_id long, text string, source string").coalesce(1).write.parquet(f"{folder}/part={part}")


def archive(spark, folder, out):
    return archive_logs.run(spark, f"{folder}/part=*", f"{out}/logs", f"{out}/checkpoint", LOGS)


def test_logs_are_taken_once_as_they_come(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    read = lambda: archive_logs.read_output(spark, f"{folder}/part=*", f"{out}/logs", LOGS)
    add_logs(spark, folder, 1, [(1, "step\nCANCELLED DUE TO TIME LIMIT", "007"), (2, None, "a"), (3, "", None)])
    assert archive(spark, folder, out) == {"batches": 1, "rows": 3}
    first = rows(read())
    assert archive(spark, folder, out) == {"batches": 0, "rows": 0} and rows(read()) == first
    add_logs(spark, folder, 2, [(1, "step\nCANCELLED DUE TO TIME LIMIT", "007"), (4, "my_token = \"ab cd\" ok\nAPI_KEY:x1 Password='p q'\nno secret here\nValueError: bad\nend", "a b"), (5, "x " * 300_000 + "slurmstepd: oom-kill", "")])
    assert archive(spark, folder, out) == {"batches": 1, "rows": 3}
    got = {}
    for r in read().collect():
        got.setdefault(r.log_id, []).append(r)
    assert len(got[1]) == 2 and set(first) < set(rows(read()))  # the log that came again stays, the earlier rows too
    assert (got[1][0].job, got[1][0].outcome, got[2][0].outcome, got[3][0].job, got[3][0].n_lines) == ("007", "time limit", "empty", "none", 0)
    assert got[4][0].clean_text == "my_token = <redacted> ok\nAPI_KEY:<redacted> Password=<redacted>\nno secret here\nValueError: bad\nend"
    assert (got[4][0].n_secrets, got[4][0].outcome, got[4][0].n_lines, got[5][0].outcome, got[5][0].job) == (3, "ValueError: bad", 5, "out of memory", "none")


def test_growing_copies_give_what_one_run_gives(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    folder, out, at_once = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "once")
    for k in range(3):
        docs.where(f"doc_id % 3 = {k}").write.parquet(f"{folder}/part={k}")
        archive(spark, folder, out)
    archive(spark, folder, at_once)
    a, b = (rows(archive_logs.read_output(spark, f"{folder}/part=*", f"{o}/logs", LOGS)) for o in (out, at_once))
    assert a == b and len(a) == docs.count()


def test_a_run_that_failed_goes_on(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    add_logs(spark, folder, 1, [(1, "fine", "a")])
    archive(spark, folder, out)
    add_logs(spark, folder, 2, [(2, "later", "a")])
    broken = LOGS | {"logs": LOGS["logs"] | {"text": "CASE WHEN doc_id = 2 THEN raise_error('disk') ELSE text END"}}
    with pytest.raises(StreamingQueryException):
        archive_logs.run(spark, f"{folder}/part=*", f"{out}/logs", f"{out}/checkpoint", broken)
    archive(spark, folder, out)
    assert sorted(r.log_id for r in archive_logs.read_output(spark, f"{folder}/part=*", f"{out}/logs", LOGS).collect()) == [1, 2]


# ---- settings and command line ---------------------------------------------


def test_settings_are_checked(tmp_path):
    file = tmp_path / "c.json"
    for wrong in ([], {"rules": {}}, CELLS | {"pixels": 1}):
        file.write_text(json.dumps(wrong))
        with pytest.raises(ValueError, match="c.json"):
            common.load_config(str(file), "publish_cells.json", publish_cells.REQUIRED)
    file.write_text(json.dumps({"logs": {"log_id": "id", "job": "'j'", "text": "t"}}))
    assert common.load_config(str(file), "archive_logs.json", archive_logs.REQUIRED)["files_per_batch"] == LOGS["files_per_batch"]


def test_command_lines(spark, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for args in (
        ["jobs.publish_cells", "--cells", f"{SF}/lineitem.parquet", "--images", f"{SF}/orders.parquet", "--registry", f"{SF}/part.parquet", "--output", str(tmp_path / "cells")],
        ["jobs.archive_logs", "--logs", f"{SF}/documents.parque[t]", "--output", str(tmp_path / "logs"), "--checkpoint", str(tmp_path / "checkpoint")],
    ):
        done = subprocess.run([sys.executable, "-m", *args], cwd=root, capture_output=True, text=True, timeout=300, check=False)
        assert done.returncode == 0 and "wrote {" in done.stderr, done.stderr[-2000:]
    assert publish_cells.read_output(spark, str(tmp_path / "cells")).count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert spark.read.parquet(str(tmp_path / "logs")).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


@pytest.mark.parametrize("name", ["job1_publish_cells", "job2_archive_logs"])
def test_registered_jobs_agree_with_sql(spark, name):
    import duckdb

    from jobs import queries

    con = duckdb.connect()
    for t in ("lineitem", "orders", "part", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.queries()[name](spark, SF).toPandas(), con.execute(queries.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    a, b = (x[columns].astype(str).sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert a.equals(b)
