import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cytoframe.llm import similarity as S
from cytoframe.llm.arrow_text import text_slices


def shingles(text, width=5):
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d if d is not None else -1, least.get(root(i), -1) if sets[i] else (d if d is not None else -1), links[i]) for i, (d, _) in enumerate(rows))


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    rows, n = [], 0
    for _ in range(25):
        base = [word() for _ in range(r.randint(3, 120))]
        for _ in range(r.choice([1, 1, 2, 6])):
            text = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3])):
                text[r.randrange(len(text))] = word()
            rows.append((n, " ".join(text)))
            n += 1
    hub = [word() for _ in range(60)]
    for _ in range(40):
        text = list(hub)
        text[r.randrange(60)] = word()
        rows.append((n, " ".join(text)))
        n += 1
    return [*rows, (n, None), (n + 1, ""), (n + 2, "..."), (n + 3, "one two"), (n + 4, "One, two!"), (n + 5, "x " * 30000), (0, rows[0][1])]


@pytest.mark.parametrize("how", [{}, {"leaf": 4, "block": 8, "depths": 3}])
def test_links_and_classes_are_those_of_all_pairs(spark, how):
    rows = corpus(1)
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, class_id string").repartition(3)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.class_id if r.class_id is not None else -1, r.n_links) for r in S.join(docs, **how).collect())
    assert got == brute(rows)


def test_tables_without_pairs(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.join(empty).count() == 0 and S.keep_one(empty).count() == 0
    one = spark.createDataFrame([(5, "a b c d e f g"), (None, "q w e r t y u")], "doc_id long, text string")
    assert {(r.doc_id, r.n_links) for r in S.join(one.where("doc_id = 5")).collect()} == {(5, 0)}
    assert S.keep_one(one).count() == 2


def test_one_of_each_class_stays(spark):
    rows = corpus(2)[:-1]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = {c for _, c, _ in brute(rows)}
    assert {r.doc_id for r in S.keep_one(docs).collect()} == classes


def test_components_of_a_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)], "a long, b long")
    got = {r.id: r.label for r in S.components(e).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_shingles_are_sets_of_words():
    texts = ["A b c d e f", "a  B, c d-e f", "a b", "", "é b c d e f g é b c d e f g"]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    (_, _, data, offsets), = text_slices(batch, "text")
    hashes, owners = S.shingle_sets(data, offsets, 5)
    ids, sizes = S.set_ids(hashes, owners, len(texts))
    assert ids[0] == ids[1] and len(set(ids)) == 4 and [int(n) for n in sizes] == [len(shingles(t)) for t in texts]


def test_target_recall():
    assert S.survival(0.8, 1) == pytest.approx(0.84) and S.survival(0.8, 2) < S.survival(0.8, 1)


def test_recall_where_pairs_meet_at_the_last_depth_only(spark):
    # 40 shingles of 50 are shared: a similarity of 0.8 each; leaves of one set send every pair through all depths
    rows = []
    for pair in range(15_000):
        words = [f"w{pair}x{i}" for i in range(49)]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join([*words[:44], *(f"v{pair}x{i}" for i in range(5))]))]
    assert all(len(a & b) == 0.8 * len(a | b) for a, b in [(shingles(rows[i][1]), shingles(rows[i + 1][1])) for i in range(0, 200, 2)])
    found = S.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), leaf=1).where("doc_id % 2 = 1 and class_id <> doc_id").count()
    assert found >= 15_000 - 5  # 1.5 are expected to be missed at a recall of 0.9999


def test_plan_counts_what_runs_share():
    runs, least, recall = S.plan(0.8, 0.9999, 3)
    assert runs >= math.log(1e-4) / math.log(1 - S.survival(0.8, 3)) and 0.9999 <= recall < 1
    assert sum(S.binomial(S.COORDINATES, 0.8)[:least]) <= 1e-5
    r, pairs = np.random.default_rng(3), 40_000
    equal = r.random((pairs, S.RUN_COORDINATES)) < 0.8
    a = r.integers(0, 1 << 32, equal.shape, np.uint32)
    b = np.where(equal, a, r.integers(0, 1 << 32, equal.shape, np.uint32))
    here = [(np.full(pairs, S.roots(1)[0]), np.arange(pairs))] * 2
    for _ in range(3):
        here = [(n, at[rows]) for (nodes, at), own in zip(here, (a, b), strict=True) for n, rows in [S.children(nodes, own[at], 0.8)]]
    met = np.intersect1d(here[0][0], here[1][0])
    met = len(set(here[0][1][np.isin(here[0][0], met)]))
    assert abs(1 - met / pairs - S.missed_by_run(0.8, 3, bool(S.chosen(S.roots(1), 0.8)[2][0]))) < 0.015


def test_one_row_of_each_class_stays_whatever_the_ids(spark):
    r = random.Random(5)
    text = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(60))
    twice, shared, clean, orphan, near = (text() for _ in range(5))
    rows = [(7, twice, "a"), (7, twice, "b"), (7, twice, "c"), (8, twice + "!", "d")]  # repeated rows, and a copy
    rows += [(1, shared, "e"), (2, shared, "f"), (2, clean, "g")]  # an id with a copy and with a text of its own
    rows += [(None, orphan, "h"), (None, orphan, "i"), (None, orphan.upper(), "j"), (None, near, "k"), (3, near + " end", "l")]
    rows += [(4, None, "m"), (4, None, "n"), (5, "...", "o")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, _KEY0 string").repartition(3)
        got = S.keep_one(docs)
        assert got.columns == docs.columns
        kept = sorted(x._KEY0 for x in got.collect())
        assert [len([k for k in kept if k in g]) for g in ("abc", "d", "e", "f", "g", "hij", "k", "l", "mn", "o")] == [1, 0, 1, 0, 1, 1, 0, 1, 2, 1]
    links = sorted((x.doc_id or -1, x.class_id or -1, x.n_links) for x in S.join(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect())
    assert links == brute([r[:2] for r in rows])


def test_sets_of_rows_without_id_are_compared(spark):
    base = [f"w{i}" for i in range(80)]
    rows = [(None, " ".join(base)), (None, " ".join([*base, "end"])), (None, "one two three four five six seven")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.n_links for r in S.join(docs).collect()) == [0, 1, 1]
    assert S.keep_one(docs).count() == 2


def test_links_and_classes_of_whole_tables(spark):
    """Recall on all documents of sf0.01 against every pair that shares a shingle."""
    import re
    from collections import Counter, defaultdict

    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {}
    for r in d.select("doc_id", "text").collect():
        w = re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", "".join(c.lower() if c.isascii() else c for c in r.text or ""))
        if w:
            sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    places = defaultdict(list)
    for k, v in sets.items():
        for x in v:
            places[x].append(k)
    links, parent = Counter(), {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, v in sets.items():
        common = Counter(o for x in v for o in places[x] if o > k)
        for o, n in common.items():
            if n >= 0.8 * (len(v) + len(sets[o]) - n) - 1e-9:
                links[k] += 1
                links[o] += 1
                a, b = sorted((root(k), root(o)))
                parent[b] = a
    got = {r.doc_id: r for r in S.join(d).collect()}
    assert len(got) == d.count() and sum(links.values()) > 100
    assert all(got[k].n_links == links[k] and got[k].class_id == root(k) for k in sets)
