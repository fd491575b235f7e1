import datetime as dt

from pyspark.sql import functions as F

from cytoframe.streaming import monitor as M


def test_monitor_state():
    state = {"a": {"last_count": 3, "warned": False}}
    assert M.state_from_json(M.state_to_json(state)) == state
    assert M.state_from_json("no json") == {} and M.state_from_json("[1]") == {} and M.state_from_json('{"a": 1}') == {}


def _write(spark, folder, k, rows):
    spark.createDataFrame([(n, dt.datetime(2026, 1, 1) + dt.timedelta(seconds=s)) for n, s in rows], "name string, ts timestamp").coalesce(1).write.parquet(f"{folder}/{k}")


def test_stalls_and_resumptions(spark, tmp_path):
    src = str(tmp_path / "in")
    for k, rows in enumerate([[("a", 0), ("b", 0)], [("b", 100)], [("b", 500)], [("a", 600), ("b", 700)], [("b", 1200)]]):
        _write(spark, src, k, rows)
    stream = spark.readStream.schema("name string, ts timestamp").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(src)
    q = M.stalls(stream, timeout_s=300).writeStream.format("memory").queryName("stalls").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    events = {(r.name, r.event) for r in spark.table("stalls").collect()}
    assert ("a", "stalled") in events and ("a", "resumed") in events


def test_arrivals(spark, tmp_path):
    src = str(tmp_path / "in")
    _write(spark, src, 0, [("a", 1), ("a", 2), ("b", 70)])
    stream = spark.readStream.schema("name string, ts timestamp").option("recursiveFileLookup", "true").parquet(src)
    q = M.arrivals(stream.withColumnRenamed("name", "batch")).writeStream.format("memory").queryName("arrivals").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.batch, r.n) for r in spark.table("arrivals").collect()} == {("a", 2), ("b", 1)}


def test_gaps(spark):
    e = spark.createDataFrame([("u", dt.datetime(2026, 1, 1, 0, 0, s)) for s in (0, 10, 50)], "k string, ts timestamp")
    assert [r.seconds for r in M.gaps(e, "k", "ts", 20).collect()] == [40.0]
    assert M.gaps(e.where(F.lit(False)), "k", "ts").count() == 0
