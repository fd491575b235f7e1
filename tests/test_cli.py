from cytoframe import cli, schemas


def test_plan(tmp_path, capsys):
    f = tmp_path / "run.yaml"
    f.write_text("inputs: {n_batches: 2}\nfilter: {enabled: false}\n")
    assert cli.main(["plan", "--config", str(f)]) == 0
    assert capsys.readouterr().out.split() == ["setup", "segment:1", "segment:2", "compile", "final", "metadata"]


def test_labels_and_merge(spark, tmp_path):
    (tmp_path / "meta.csv").write_text("Cell_ID,plate,scene\na,101,1\nb,102,2\n")
    (tmp_path / "reg.csv").write_text("id,drug\n0101_s01,INH\n")
    assert cli.main(["labels", "--metadata", str(tmp_path / "meta.csv"), "--registry", str(tmp_path / "reg.csv"), "--output", str(tmp_path / "out")]) == 0
    got = {r.Cell_ID: r.drug for r in spark.read.csv(str(tmp_path / "out"), header=True).collect()}
    assert got == {"a": "INH", "b": "UNK"}
    for name, value in (("old", 1.0), ("new", 2.0)):
        spark.createDataFrame([("a", "f", value), (name, "f", value)], schemas.FEATURES_LONG).write.parquet(f"{tmp_path}/{name}")
    assert cli.main(["merge", "--existing", f"{tmp_path}/old", "--new", f"{tmp_path}/new", "--output", f"{tmp_path}/all"]) == 0
    assert {(r.cell_id, r.value) for r in spark.read.parquet(f"{tmp_path}/all").collect()} == {("a", 1.0), ("old", 1.0), ("new", 2.0)}
    assert cli.main(["summary", "--features", f"{tmp_path}/all"]) == 0
