import math
import re
from collections import Counter

from pyspark.sql import functions as F

from cytoframe.llm import rules as R

TEXTS = [None, "", "one", "a b c a b c", "a b c d a b c", "x x x x", "L1 a\nL1 a\n\n \t\nL1 a\nb", "#*$%&|<> ##", "é b\x0bc\x0cd\re", "w " * 5000, "THE CAPS AND the rest", "a b\na b c"]


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text), len(lines) - len(set(lines)), len(covered)


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "en" if i % 2 else None, "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_words string")


def test_base_counts(spark):
    for r in R.base(docs(spark)).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(TEXTS[r.doc_id])


def test_colliding_windows_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(R, "POSITION_BITS", 62)  # two bits of hash are left: nearly all windows collide
    texts = [t for t in TEXTS if t and len(t) < 100]
    for r in R.base(docs(spark, texts)).collect():
        assert r.n_repeat_words == brute(texts[r.doc_id])[4]


def test_binomial_tail(spark):
    rows = [(0, 100), (3, 100), (1, 0), (50, 60), (2, 1000), (200_000, 20_000_000)]
    got = spark.createDataFrame(rows, "k long, n long").select(R.binomial_tail(F.col("k"), F.col("n"), 0.02).alias("p")).collect()
    for (k, n), r in zip(rows[:5], got, strict=False):
        want = 1.0 if n == 0 or k >= n * 0.02 else sum(math.comb(n, i) * 0.02**i * 0.98 ** (n - i) for i in range(k + 1))
        assert abs(r.p - want) < 1e-9
    assert got[5].p < 1e-12


def test_verdicts(spark):
    good = " ".join(f"word{i % 97}x{i}" for i in range(120))
    bad = " ".join(f"wo{i}## ##{i}##" for i in range(120))
    rows = [(i, good + f" {i}" if i % 4 else bad + f" {i}", "en") for i in range(1600)] + [(9000, None, "en"), (9001, "short", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(1600)] * 2 + [(None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in R.judge(d, labels).collect()}
    assert len(got) == len(rows) and all(got[i].kept == (i % 4 > 0) for i in range(1600))
    assert got[9000].base_failed and not got[9000].kept and got[9001].base_failed
    nothing = R.judge(d, labels.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in nothing)
    assert R.judge(d.limit(0), labels).count() == 0


def test_false_rejection_is_limited(spark):
    """Good and bad documents that no cutoff can tell apart: next to none of the good ones go."""
    d = spark.createDataFrame([(i, " ".join(f"w{j}" + "#" * ((i * 7 + j) % (2 + i % 5) == 0) for j in range(60)), "en") for i in range(2000)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(2000)], "doc_id long, quality int")
    got = R.judge(d, labels).join(labels, "doc_id").where("quality = 1 and not base_failed")
    assert got.where("not kept").count() <= 0.08 * got.count()
