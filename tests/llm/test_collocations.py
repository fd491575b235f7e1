import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cytoframe.llm import collocations as C

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least, most, percent=80):
    """The contract's words, sentence by sentence, over Python tuples."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for m in range(1, 5):
                f.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    of_lang = {}
    frequent = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    for (lang, p), a in frequent.items():
        score, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        inside = any(100 * b >= percent * a for (x, q), b in frequent.items() if x == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
        if not inside:
            of_lang.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, rank, phrase.decode(), -a, left, right, n[lang], -s) for lang, found in of_lang.items() for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:most], 1))


def corpus(seed, n, words):
    r = random.Random(seed)
    ends = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!", "-"]
    langs = ["en", "fr", None, "a", "a\tb", "a%09", "und", "a\x01", ""]
    return [(r.choice(langs[: 1 + seed % len(langs)] if seed else langs), None if r.random() < 0.05 else "".join(r.choice(words) + r.choice(ends) for _ in range(r.randint(0, 40)))) for _ in range(n)]


def named(lang):
    """As `mine` names languages: without tabs."""
    return ("und" if lang is None else lang).replace("%", "%25").replace("\t", "%09")


WORDS = ["a", "A", "b", "the", "The", "of", "a\x01", "a\x00b", "\x00", "é", "É", "漢字", "x-y", "\U0001f600", "ab", "\x1f", ""]


@pytest.mark.parametrize(("seed", "n_ranges"), [(0, 1), (0, 9), (1, 3), (5, 40), (2, 7)])
def test_equals_brute_force(spark, seed, n_ranges):
    rows = corpus(seed, 250, WORDS)
    rows += rows[:20]
    docs = spark.createDataFrame([(*x, 1, "s") for x in rows], "lang string, text string, a int, phrase string").repartition(5)
    got = sorted(map(tuple, C.mine(docs, least=4, most=60, n_ranges=n_ranges).collect()))
    assert got == brute(rows, 4, 60)


def test_one_word_and_one_passage_in_a_third_of_all_rows(spark):
    r = random.Random(4)
    rows = [("en", "hot " * 50) for _ in range(60)] + [("en", "the same passage of many words here") for _ in range(60)]
    rows += [("en", " ".join(r.choice(["hot", "x", "y", "z"]) for _ in range(30))) for _ in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, C.mine(docs, least=30, n_ranges=6).collect())) == brute(rows, 30, 2000)


def test_empty_null_and_long(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert C.mine(none).count() == 0
    assert C.mine(spark.createDataFrame([(None, None), ("en", ""), ("en", " .,")], "lang string, text string")).count() == 0
    text = "one two three four five. " * 100_000
    got = list(map(tuple, C.mine(spark.createDataFrame([(None, text)], "lang string, text string")).collect()))
    assert got == [("und", 1, "one two three four", 100_000, 100_000, 100_000, 500_000, 1_000_000), ("und", 2, "two three four five", 100_000, 100_000, 100_000, 500_000, 1_000_000)]


def test_scores_beyond_64_bits(spark):
    a = 3 * 10**13
    got = spark.sql(f"SELECT CAST((CAST({a}L AS DECIMAL(31, 0)) * 2000000) DIV (CAST({a + 7}L AS DECIMAL(20, 0)) + {a + 12}L) AS LONG) AS s").first().s
    assert got == 2000000 * a // (2 * a + 19)


def test_shards_of_any_size_give_the_same_counts(monkeypatch):
    rows = corpus(7, 200, WORDS)
    batch = pa.RecordBatch.from_arrays([pa.array([named(x) for x, _ in rows]), pa.array([t for _, t in rows])], names=["lang", "text"])

    def counted(batches):
        total = Counter()
        for keys, counts in C._shards(iter(batches), None):
            found = keys.to_pylist()
            assert found == sorted(found) and len(set(found)) == len(found)
            total.update(dict(zip(found, counts.tolist(), strict=True)))
        return total

    whole = counted([batch])
    monkeypatch.setattr(C, "SHARD_WORDS", 50)
    assert counted([batch.slice(i, 3) for i in range(0, len(rows), 3)]) == whole


def test_runs_cut_by_ranges_are_merged_whole(monkeypatch):
    rows = corpus(0, 300, WORDS)
    monkeypatch.setattr(C, "SHARD_WORDS", 200)
    monkeypatch.setattr(C, "MERGE_ROWS", 100)
    batches = [pa.RecordBatch.from_arrays([pa.array([named(x) for x, _ in rows[i : i + 10]]), pa.array([t for _, t in rows[i : i + 10]])], names=["lang", "text"]) for i in range(0, 300, 10)]
    shards = list(C._shards(iter(batches), None))
    total = Counter()
    for keys, counts in shards:
        total.update(dict(zip(keys.to_pylist(), counts.tolist(), strict=True)))
    ordered = sorted(total)
    bounds = pa.array(ordered[7::13], pa.large_binary())
    runs = {}
    for keys, counts in shards:
        for r, run in C.cut_runs(keys, counts, bounds):
            runs.setdefault(r, []).append(run)
    seen = {}
    for r in sorted(runs):
        keys, counts = C.merged(iter(runs[r]), 1)
        first = bounds[r - 1].as_py() if r else None
        for lang, words, depth, a, n, lefts in C.walked(keys, counts, first):
            key = lang.encode() + b"\t" + words
            assert key not in seen and a == total[key] and n == total[lang.encode() + b"\t"]
            path = words.split(b"\0")
            assert depth == len(path) and lefts == [total[lang.encode() + b"\t" + b"\0".join(path[:k])] for k in range(1, depth)]
            seen[key] = a
    assert seen == {k: v for k, v in total.items() if not k.endswith(b"\t")}


def test_pairs_of_the_bitmap_are_those_of_the_texts(spark):
    texts = ["alpha beta gamma. Beta gamma, x\x00y z"] * 5
    docs = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    bounds = C.range_bounds(docs, 3)
    short = C.merge_runs(C.shard_runs(docs, bounds), len(bounds) + 1, 5)
    bits = np.frombuffer(C.frequent_pairs(short), np.uint8)
    data = texts[0].encode()
    words = C.Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    joined = [a == b for a, b in itertools.pairwise(words.pieces)]
    places = C.pair_places(C.lang_hashes(["en"]), words.hashes[:-1], words.hashes[1:])
    assert [bool(bits[p >> 3] >> (p & 7) & 1) for p in places] == joined
    assert int(np.unpackbits(bits).sum()) == len({int(p) for p, j in zip(places, joined, strict=True) if j})
