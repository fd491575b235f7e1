import numpy as np
import pytest

from cytoframe.llm import learners as M
from cytoframe.llm import quality as Q
from cytoframe.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def auc(y, s):
    order = np.argsort(np.argsort(s))
    pos = y == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_trees_learn_interactions_and_isotonic_is_monotone():
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    m = M.BoostedTrees().fit(x[:2000], y[:2000])
    assert auc(y[2000:], m.raw(x[2000:])) > 0.97
    c = M.Isotonic().fit(m.raw(x[2000:]), y[2000:])
    p = c(np.linspace(-9, 9, 50))
    assert (np.diff(p) >= 0).all() and p.min() >= 0 and p.max() <= 1
    assert auc(y, M.Logistic().fit(np.c_[x, x[:, 0] * x[:, 1]], y).raw(np.c_[x, x[:, 0] * x[:, 1]])) > 0.8


def test_toxicity_features():
    lexicon = {"idiot": 2.0, "scum": 1.0}
    f = T.featurise("You idiot, YOU 1d10t! and 1di0t or id*ot", lexicon)
    assert len(f) == T.N_FEATURES and f[1] == 1 and f[9] == 1 and f[7] > 0
    assert T.featurise("", lexicon)[1:5] == [0.0, 0.0, 0, 0.0]
    assert T.featurise("x" * 500_000, lexicon)[1] == 0


def test_toxicity_features_have_one_definition_at_every_length():
    for text in ("ПРИВЕТ ВСЕМ ", "ΓΕΙΑ ΣΟΥ ", "ŻÓŁĆ ŁĄKA ", "ǅ 𝐀𝐁 Ⅷ Ab "):
        capitals = sum(map(str.isupper, text)) / len(text)
        assert capitals > 0.1 and all(abs(T.featurise(text * k, {})[11] - capitals) < 1e-12 for k in (1, 10, 500))
    assert T.featurise("you and your dog", {})[10] == T.featurise("you and your dog", {"dog": 1.0})[10] == 0.5


def test_toxicity_on_held_out_rows(spark):
    d, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    r = T.score_documents(d, labels).join(labels, "doc_id").toPandas()
    h = r[r.held_out]
    assert auc(h.toxic.to_numpy(), h.score.to_numpy()) > 0.85 and ((h.score >= 0.5).astype(int) == h.predicted).all() and r.score.between(0, 1).all()


def test_toxicity_edges(spark):
    d = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "hello you", 5), (3, "hello you", 5), (None, "x", 5)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0)], "doc_id long, toxic int, quality int")
    for l in (labels, labels.limit(0)):
        r = T.score_documents(d, l).collect()
        assert len(r) == 5 and all(0 <= x.score <= 1 for x in r)
    assert T.score_documents(d.limit(0), labels).count() == 0


def test_quality_on_labelled_rows(spark):
    d, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    train = labels.where("doc_id % 3 <> 0")
    r = Q.score_documents(d, train).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    assert auc(r.quality.to_numpy(), r.score.to_numpy()) > 0.9 and (r.kept == (r.quality == 1)).mean() > 0.9


def test_views_teach_each_other():
    r = np.random.default_rng(4)
    z = r.integers(0, 2, 3000)
    t, m = z[:, None] * 3 + r.normal(size=(3000, 2)), z[:, None] * 3 + r.normal(size=(3000, 2))
    y = np.where(np.arange(3000) < 120, z, -1).astype(float)
    g = np.zeros((3000, Q.N_GRAMS // 8), np.uint8)
    model = Q.co_train(t, g, m, y, np.arange(3000) % 4)
    score, a, b = model.score(t, g, m)
    alone = Q.co_train(t, g, m, y, np.arange(3000) % 4, rounds=0)
    assert auc(z, score) > max(auc(z, a), auc(z, b)) - 0.002 and auc(z, score) > 0.97
    assert sum(model.exchanged) > 300 and alone.exchanged == () and auc(z, score) >= auc(z, alone.score(t, g, m)[0]) - 0.002


def test_words_are_part_of_the_text_view():
    import pyarrow as pa

    texts = ["good fine text here " * (k % 5 + 1) for k in range(60)] + ["evil spam text here " * (k % 5 + 1) for k in range(60)]
    batch = pa.RecordBatch.from_pydict({"text": [*texts, None, "", "GOOD text"]})
    g = Q.gram_view(batch, "text")
    assert g.shape == (123, 512) and not g[120].any() and not g[121].any()
    bits = np.unpackbits(g, axis=1).sum(axis=1)
    assert bits[0] == 7 and bits[1] == 8 and bits[122] == 3  # 4 words, 3 pairs, and the pair across a repetition
    y = np.repeat([1.0, 0.0], 60)
    w = Q.gram_weights(g[:120], y, np.ones(120))
    assert (Q.gram_score(g[:60], w) > 0.2).all() and (Q.gram_score(g[60:120], w) < -0.2).all() and Q.gram_score(g[122:], w)[0] > 0


def test_labelled_rows_that_repeat_count_once(spark):
    d = spark.createDataFrame([(i % 40, f"text {i % 40} " * 3, "en", "s", 5) for i in range(400)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    a, b = Q.score_documents(d, labels).distinct(), Q.score_documents(d.dropDuplicates(["doc_id"]), labels)
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}
    a, b = T.score_documents(d, labels).distinct(), T.score_documents(d.dropDuplicates(["doc_id"]), labels)
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}


@pytest.mark.parametrize("kinds", ["both", "one", "none"])
def test_quality_edges(spark, kinds):
    d = spark.createDataFrame([(i, None if i == 1 else "text " * i, "en" if i % 2 else None, None if i == 3 else "s", None if i == 4 else i, "x") for i in range(30)] + [(2, "again", "en", "s", 1, "x")], "doc_id long, text string, lang string, source string, n_chars long, score string")
    labels = spark.createDataFrame([(i, i % 2 if kinds == "both" else 1) for i in range(20)], "doc_id long, quality int")
    r = Q.score_documents(d, labels.limit(0) if kinds == "none" else labels).collect()
    assert len(r) == 31 and all(0 <= x.score <= 1 for x in r)
    assert Q.score_documents(d.limit(0), labels).count() == 0
