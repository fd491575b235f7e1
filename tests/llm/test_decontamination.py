import hashlib
import re

from cytoframe.llm import decontamination as D


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=lambda r: (r[0] is None, r))


LONG = " ".join(f"w{i}" for i in range(25))
ITEMS = [(1, LONG), (2, "short one here"), (10, "Short, ONE here!"), (3, None), (4, "..."), (5, "solo"), (6, LONG), (6, LONG), (7, "é ü " + LONG[:30])]
DOCS = [(1, "x y " + LONG.upper() + " z"), (2, "w3 w4 w5 w6 w7 w8 w9 w10 w11"), (3, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (4, None), (5, ""), (6, "a short one here b solo c short one here"), (6, "a short one here b solo c short one here"), (7, "clean " * 30000), (None, "solo"), (8, "É ü w0 w1 w2 w3 w4 w5 w6 w7"), (9, "é ü w0 w1 w2 w3 w4 w5 w6 w7")]


def frames(spark, docs=DOCS, items=ITEMS):
    return spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n_words int"), spark.createDataFrame([(i, t, "e") for i, t in items], "item_id long, text string, window string")


def test_report(spark, monkeypatch):
    docs, items = frames(spark)
    for limit in (1 << 20, 2):
        monkeypatch.setattr(D, "MOST_SLOTS", limit)  # a bitmap that all windows fit, and one that is full
        got = sorted((tuple(r) for r in D.report(docs, items).collect()), key=lambda r: (r[0] is None, r))
        assert got == brute(DOCS, ITEMS)


def test_filter_and_empty_tables(spark):
    docs, items = frames(spark)
    clean = [d for d, *_, hit in brute(DOCS, ITEMS) if not hit]
    kept = D.keep_clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(clean)
    assert D.keep_clean(docs, items.limit(0)).count() == len(DOCS)
    assert D.report(docs.limit(0), items).count() == 0 and D.report(docs, items.limit(0)).where("contaminated").count() == 0


def test_a_large_benchmark_makes_no_large_plan(spark):
    from pyspark.sql import functions as F

    items = spark.range(20_000).select(F.col("id").alias("item_id"), F.concat_ws(" ", *[F.concat(F.lit(f"q{k}x"), F.col("id")) for k in range(20)]).alias("text"))
    docs = spark.createDataFrame([(1, "a b " + " ".join(f"q{k}x777" for k in range(3, 14)) + " c"), (2, "clean text " * 50), (3, " ".join(f"q{k}x19999" for k in range(9)))], "doc_id long, text string")
    windows = D.windows_of(items)
    assert windows.count() == 220_000
    scanned = D.with_candidates(docs, windows)
    assert len(scanned._jdf.queryExecution().toString()) < 200_000
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in D.report(docs, items).collect()}
    assert got == {1: (14, 11, 1), 2: (100, 0, 0), 3: (9, 0, 0)}
    assert [r.doc_id for r in D.keep_clean(docs, items).orderBy("doc_id").collect()] == [2, 3]
    assert {r.doc_id: r.n for r in scanned.select("doc_id", F.size("scanned.hits").alias("n")).collect()} == {1: 2, 2: 0, 3: 0}


def test_hot_windows(spark):
    passage = " ".join(f"p{k}" for k in range(12))
    docs = spark.range(3000).selectExpr("id as doc_id", f"concat('x', id, ' {passage} y', id) as text")
    items = spark.createDataFrame([(i, passage) for i in range(40)] + [(100, "x5 p0 p1 p2 p3 p4 p5 p6 p7 p8")], "item_id long, text string")
    got = {(r.n_hit, r.n_items): r.n for r in D.report(docs, items).groupBy("n_hit", "n_items").count().withColumnRenamed("count", "n").collect()}
    assert got == {(12, 40): 2999, (13, 41): 1}
