import zlib

import numpy as np
import pytest

from cytoframe.llm import packing

TEXTS = [(1, "hello world"), (2, None), (3, ""), (4, "a b " * 3000), (5, "<|endoftext|> x</s>"), (6, "Ünïcødé 漢字 \U0001f600 ퟿" * 40), (4, "again the same id"), (7, "  \n\t " * 50), (8, "z" * 5000)]


def test_pieces_hold_every_id_once(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    docs = spark.createDataFrame([(i, x, "extra") for i, x in TEXTS], "doc_id long, text string, start string")
    got = packing.pack(docs.coalesce(1)).toPandas()
    ids = {}
    for i, x in TEXTS:
        ids.setdefault(i, []).append(np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4"))
    for (doc, n), g in got.groupby(["doc_id", "doc_tokens"]):
        whole = next(a for a in ids[doc] if len(a) == n)
        g = g.sort_values("start")
        assert (g.start.to_numpy() == np.concatenate([[0], np.cumsum(g.length)[:-1]])).all() and g.length.sum() == n
        assert all(zlib.crc32(whole[s : s + k]) == c for s, k, c in zip(g.start, g.length, g.ids_crc32, strict=True))
    assert got.length.sum() == sum(len(a) for v in ids.values() for a in v)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset.to_numpy() == np.concatenate([[0], np.cumsum(g.length)[:-1]])).all()
        total = g.length.sum()
        assert total == 1024 or total & (total - 1) == 0


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_best_fill_is_the_best(seed):
    r = np.random.default_rng(seed)
    counts = {int(k): int(r.integers(1, 4)) for k in r.integers(1, 40, 6)}
    capacity = int(r.integers(5, 120))
    sums = {0}
    for k, n in counts.items():
        sums = {s + k * i for s in sums for i in range(n + 1)}
    used = packing.best_fill(counts, sorted(counts, reverse=True), capacity)
    assert all(0 < used[k] <= counts[k] for k in used)
    assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= capacity)


def test_blocks_bound_what_is_held():
    p = packing.Packer(1024, 0, 4096)
    for i in range(200):
        p.add(i, np.full(600, i, "<u4"))
        assert p.held < 4096 + 600
    p.pack(True)
    total = {}
    for s, n in zip(p.rows[5], p.rows[2], strict=True):
        total[s] = total.get(s, 0) + n
    assert sum(total.values()) == 200 * 600 and all(n == 1024 or n & (n - 1) == 0 for n in total.values())


def test_ids_of_all_kinds_of_characters_and_runs():
    import random

    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    t = Tokenizer.from_file(path)
    r = random.Random(3)
    kinds = ["a", "Z", "é", "漢", "я", "1", "½", "Ⅷ", "!", "-", "'", "'s", "'ll", " ", "\n", "\t", "\r\n", "\u00a0", "\u2003", "\u3000", "\u0085", "\u200b", "\u0301", "\U0001f600", "\x00", "\x1c", "<|endoftext|>", "ى", "\ufeff", "\ue000"]
    texts = ["".join(r.choice(kinds) * r.choice([1, 1, 2, 3, 7]) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(chr(r.choice([r.randrange(0x250), r.randrange(0x3000), r.randrange(0xE000, 0x20000)])) for _ in range(30)) for _ in range(1000)]
    n = 12_000
    texts += [f"x{c * n}{end}" for c in " \nza1!漢" for end in ("", "y", " y", "\n")] + [" " * n, ("\n" * (n // 2) + " ") * 3 + "x", " \n" * n + "é", "ab 1!" * n]
    for x in texts:
        assert packing.encode(path, x).tolist() == t.encode(x, add_special_tokens=False).ids, x[:50]


def test_runs_of_millions(spark):
    n = 5_000_000
    texts = [" " * n, "\n" * n + "x", "z" * n, "1!" * (n // 2), "x" + "\t" * n]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert packing.has_long_run(texts[0]) and packing.has_long_run(texts[3]) and not packing.has_long_run("ab " * n)
    got = {r.doc_id: (r.n, r.m) for r in packing.pack(docs).groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).toDF("doc_id", "n", "m").collect()}
    assert len(got) == 5 and all(a == b > 1 for a, b in got.values()) and got[0][0] == n + 1
