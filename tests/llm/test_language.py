import math

import numpy as np
import pyarrow as pa

from cytoframe.llm import language as L
from cytoframe.llm.arrow_text import text_slices

EN = "the cat and the dog went over the hill with that other one "
FR = "le chat et le chien sont dans la maison avec une autre bête "


def brute(train: dict[str, str], text: str) -> dict[str, float]:
    """Escape method C, one byte after the other."""
    out = {}
    for language, learned in train.items():
        counts: dict[bytes, dict[int, int]] = {}
        data = b"\n" * L.ORDER + learned.encode()
        for i in range(L.ORDER, len(data)):
            for k in range(L.ORDER + 1):
                counts.setdefault(data[i - k : i], {}).setdefault(data[i], 0)
                counts[data[i - k : i]][data[i]] += 1
        bits = 0.0
        data = b"\n" * L.ORDER + text.encode()
        for i in range(L.ORDER, len(data)):
            for k in range(L.ORDER, -1, -1):
                seen = counts.get(data[i - k : i])
                if not seen:
                    continue
                total = sum(seen.values()) + len(seen)
                if data[i] in seen:
                    bits -= math.log2(seen[data[i]] / total)
                    break
                bits -= math.log2(len(seen) / total)
            else:
                bits += 8
        out[language] = bits
    return out


def counted(text: str):
    batch = pa.RecordBatch.from_pydict({"text": [text]})
    (_, _, data, offsets), = text_slices(batch, "text")
    return np.unique(L.grams(L.padded(data, offsets)[0]), return_counts=True)


def test_code_lengths_are_exact():
    train = {"en": EN * 2, "fr": FR * 2}
    model = L.build({k: counted(v) for k, v in train.items()})
    texts = ["the other hill", "", "une bête zzz!", "éé", "q"]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    (_, _, data, offsets), = text_slices(batch, "text")
    out, starts = L.padded(data, offsets)
    bits = model.bits(out, starts, np.diff(offsets))
    for text, row in zip(texts, bits, strict=True):
        want = brute(train, text)
        np.testing.assert_allclose(row, [want[x] for x in model.languages], rtol=1e-5, atol=1e-4)


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_predictions_and_rejections(spark):
    rows = [(i, (EN if i % 2 else FR) * 3, "en" if i % 2 else "fr", "s", 1) for i in range(80)]
    rows += [(100, None, "en", "s", 0), (101, "", None, "s", 0), (102, "123 --- 99", "en", "s", 0), (104, "½ ² Ⅷ ① ٣", "en", "s", 0), (103, "the DOG and THE cat " * 20000, None, "s", 1), (7, "le chat", "fr", None, 1), (None, "the dog", "en", "s", 1)]
    got = {(r.doc_id, r.lang_pred, r.held_out) for r in L.identify_documents(docs(spark, rows)).collect()}
    pred = {d: p for d, p, _ in got if d != 7}
    assert all(pred[i] == ("en" if i % 2 else "fr") for i in range(80) if i != 7)
    assert pred[100] == pred[101] == pred[102] == pred[104] == "und" and pred[103] == "en" and pred[None] == "en"
    assert {h for _, _, h in got} == {True, False}
    kept = L.keep_identified(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"] and kept.count() == len(rows) - 4


def test_nothing_learned(spark):
    assert [r.lang_pred for r in L.identify_documents(docs(spark, [(1, "abc", None, "s", 1)])).collect()] == ["und"]
    assert L.identify_documents(docs(spark, [])).count() == 0


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    r = L.identify_documents(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(x.lang == x.lang_pred for x in r) >= 0.97 * len(r)


def test_many_languages_stay_small():
    import random

    texts = {}
    for j in range(200):
        r = random.Random(j)
        words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzéüñß") for _ in range(r.randint(2, 9))) for _ in range(200)]
        texts[f"l{j:03}"] = " ".join(r.choice(words) for _ in range(8_000))
    grams = {k: counted(v) for k, v in texts.items()}
    model = L.build(grams)
    assert 20_000_000 < model.nbytes() < 90_000_000  # not pruned
    some = {k: texts[k][:3000] for k in ("l000", "l077", "l199")}
    wanted = brute({k: texts[k] for k in some}, some["l077"][:300])
    batch = pa.RecordBatch.from_pydict({"text": [some["l077"][:300], some["l199"]]})
    (_, _, data, offsets), = text_slices(batch, "text")
    bits = model.bits(*L.padded(data, offsets), np.diff(offsets))
    assert bits.argmin(axis=1).tolist() == [77, 199]
    np.testing.assert_allclose(bits[0][[0, 77, 199]], [wanted[k] for k in some], rtol=1e-4)
    small = L.build(grams, most_bytes=10_000_000)
    assert small.nbytes() <= 10_500_000 and small.bits(*L.padded(data, offsets), np.diff(offsets)).argmin(axis=1).tolist() == [77, 199]


def test_languages_of_long_texts_alone_are_learned(spark):
    rows = [(i, EN * 4000, "en", "s", 1) for i in range(4)] + [(i + 10, FR * 3, "fr", "s", 1) for i in range(20)]
    got = {r.doc_id: r.lang_pred for r in L.identify_documents(docs(spark, rows)).collect()}
    assert all(p == ("en" if d < 10 else "fr") for d, p in got.items())
