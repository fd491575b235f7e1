from pyspark.sql import functions as F

import corpus_pipeline
from cytoframe.llm import decontamination, language, packing, privacy, similarity

SF = "/root/testdata/sf0.001"


def test_run_is_its_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "PII", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    kept = {r.doc_id for r in language.identify_documents(docs).where("lang_pred <> 'und' and score >= 0.4").collect()}
    one = docs.where(docs.doc_id.isin(list(kept)))
    classes = {r.doc_id: r.class_id for r in similarity.join(one).collect()}
    kept = {d for d, c in classes.items() if d == c}
    dirty = {r.doc_id for r in decontamination.report(docs, bench).where("contaminated").collect()}
    kept -= dirty
    clean = privacy.anonymise(docs.where(docs.doc_id.isin(list(kept))))
    want = {r.doc_id: r.doc_tokens for r in packing.pack(clean).collect()}
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert dict(zip(got.doc_id, got.doc_tokens, strict=True)) == want
    assert (got.groupby("doc_id").length.sum() == got.groupby("doc_id").doc_tokens.first()).all()


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "123", None, "s", 3), (4, "the cat and the dog went over the hill with mail to a@b.com", "en", "s", 9), (4, "the cat and the dog went over the hill with mail to a@b.com", "en", "s", 9), (5, "the dog " * 9000, "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit("extra") for c in ("score", "lang_pred", "class_id", "hits", "scanned", "c0", "_words", "entity", "start")})
    for table in (docs, docs.limit(0)):
        at = table
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, at, SF)
            if name != "packing":
                assert out.columns == docs.columns
            out.count()
            at = out if name != "packing" else at


def test_tables_on_the_way_go(spark):
    import os

    import pytest
    from pyspark.sql import functions as F

    from cytoframe.llm import privacy
    from cytoframe.llm.tables import scratch_folder, tables_made, written

    left = lambda: {d for d in (os.listdir(scratch_folder(spark)) if os.path.isdir(scratch_folder(spark)) else []) if d.startswith("table-")}
    before = left()
    docs = spark.createDataFrame([(1, "mail john.doe@example.com now"), (2, "clean")], "doc_id long, text string")
    with tables_made(spark):
        outer = written(docs)
        with tables_made(spark):
            texts = sorted(r.text for r in privacy.anonymise(docs, "key").collect())
            assert len(left() - before) == 2
        assert outer.count() == 2 and len(left() - before) == 1
    assert left() == before and texts[0] == "clean" and "john.doe" not in texts[1]
    with pytest.raises(ZeroDivisionError), tables_made(spark):
        written(docs)
        raise ZeroDivisionError
    with pytest.raises(Exception, match="no text"):
        written(docs.withColumn("text", F.raise_error(F.lit("no text"))))
    assert left() <= before | left() and all(not os.path.exists(f"{scratch_folder(spark)}/{d}/_SUCCESS") for d in left() - before)
