"""Toxicity scores: boosted trees over dense features of whole texts, calibrated by isotonic regression."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.arrow_text import parts
from cytoframe.llm.learners import BoostedTrees, Isotonic
from cytoframe.llm.tables import checkpointed, id_remainder

_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"(?<![^\W_])[^\W\d_]+[0-9@$!*]+[^\W_]+[0-9@$!*\w]*")
_UNMASK = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_SECOND = {"you", "your", "yours", "yourself", "u", "ur", "tu", "te", "toi", "ton", "ta", "vous", "votre", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "usted", "ti", "tus"}
#: Insults that count before anything is learned.
INSULTS = {"idiot", "idiots", "moron", "morons", "stupid", "scum", "trash", "loser", "losers", "pathetic", "worthless", "disgusting", "clown", "clowns", "dumb", "garbage", "fool", "imbecile", "cretin", "filth", "vermin", "idiota", "idiotas", "estúpido", "imbécil", "basura", "asqueroso", "crétin", "débile", "ordure", "connard", "dummkopf", "trottel", "abschaum", "widerlich", "blödmann"}
N_FEATURES = 17
#: All characters up to U+FFFF of which str.isupper holds, one table for re; and the characters above.
_CAPITAL = re.compile("[" + "".join(c for c in map(chr, range(0x10000)) if c.isupper()) + "]")
_ABOVE = re.compile("[\U00010000-\U0010ffff]")


def unmasked(word: str, lexicon: dict[str, float]) -> float:
    """The weight of the word that a masked one stands for, the greatest that fits its stars; 0 if none does."""
    plain = word.lower().translate(_UNMASK)
    if plain in lexicon or "*" not in plain or len(plain) > max(map(len, lexicon), default=0):
        return lexicon.get(plain, 0.0)
    return max((v for k, v in lexicon.items() if len(k) == len(plain) and all(p in ("*", c) for p, c in zip(plain, k, strict=True))), default=0.0)


def featurise(text: str, lexicon: dict[str, float]) -> list[float]:
    """Dense features of one whole text; all zero but for the constants where it has no words."""
    words = _WORD.findall(text.lower())
    n = max(len(words), 1)
    hits = [lexicon[w] for w in words if w in lexicon]
    near = 0
    second = sum(map(_SECOND.__contains__, words))
    if hits and second:
        marks = [i for i, w in enumerate(words) if w in _SECOND]
        places = np.array([i for i, w in enumerate(words) if w in lexicon])
        at = np.searchsorted(marks, places)
        m = np.array([-99, *marks, 10**9])
        near = int((np.minimum(places - m[at], m[at + 1] - places) <= 5).sum())
    seen: dict[str, int] = {}
    for m in _MASKED.finditer(text):
        seen[m[0]] = seen.get(m[0], 0) + 1
    found = sum(seen.values())
    masked = sum(times * unmasked(word, lexicon) for word, times in seen.items())
    chars = max(len(text), 1)
    capitals = len(_CAPITAL.findall(text)) + sum(map(str.isupper, _ABOVE.findall(text)))
    return [
        np.log1p(len(words)),
        float(len(hits)),
        len(hits) / n,
        sum(hits),
        sum(hits) / n,
        max(hits, default=0.0),
        len({round(h, 6) for h in hits}),
        masked,
        found / n,
        near,
        second / n,
        capitals / chars,
        text.count("!") / chars,
        text.count("?") / chars,
        sum(map(text.count, "#*$%&@")) / chars,
        len(text.encode("utf-8", "replace")) / chars,
        sum(map(len, words)) / n,
    ]


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: BoostedTrees | None
    calibration: Isotonic | None
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.base)
        return np.clip(self.calibration(self.trees.raw(x)), 0.0, 1.0)


def lexicon_of(words: list, toxic: np.ndarray, total: np.ndarray, n_toxic: int, n_all: int, most: int) -> dict[str, float]:
    """Insults, and the ``most`` words whose documents are toxic far more often than others; weight by log odds."""
    found = dict.fromkeys(INSULTS, 1.0)
    if not n_toxic or n_toxic == n_all or not len(words):
        return found
    rest, n_rest = total - toxic, n_all - n_toxic
    odds = np.log((toxic + 0.5) / (n_toxic - toxic + 0.5)) - np.log((rest + 0.5) / (n_rest - rest + 0.5))
    spread = np.sqrt(1 / (toxic + 0.5) + 1 / (rest + 0.5))
    strong = np.flatnonzero((odds > 1.0) & (odds / spread > 3.5) & (toxic >= 3))
    for i in strong[np.argsort(-odds[strong] / spread[strong])][:most]:
        found[words[i]] = float(odds[i])
    return found


def sampled(labels: DataFrame, column: str, rows: int, seed: int = 6) -> DataFrame:
    """At most ``rows`` labelled ids, the first by a hash; an id with several labels has the greatest."""
    known = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    return known.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(rows)


def train(documents: DataFrame, labels: DataFrame, rows: int = 20_000, lexicon_words: int = 300, folds: int = 3) -> Model:
    """Learn from at most ``rows`` labelled documents, the bound of all that comes to the driver.

    The lexicon that a row's features use is learned without its fold, and the
    calibration from the scores of trees that never saw it.
    """
    # At most `rows` ids and labels, so that broadcasting them is bounded.
    sample = checkpointed(sampled(labels, "toxic", rows).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(61)), F.lit(folds)).cast("int")))
    # One row for each id, however often it repeats, so that at most `rows` texts are learned from.
    text = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label", "fold").agg(F.min("text").alias("text"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 500):
            out = [sorted(set(_WORD.findall((t or "").lower()))) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string())), batch.column(1), batch.column(2)], names=["words", "label", "fold"])

    listed = text.select("text", "label", "fold").mapInArrow(words, "words array<string>, label int, fold int")
    # Only words of three toxic documents can enter the lexicon.
    by_fold = [F.sum(F.when(F.col("fold") == k, v).otherwise(0)).alias(f"{name}{k}") for k in range(folds) for name, v in (("n", F.lit(1)), ("t", F.col("label")))]
    counted = listed.select(F.explode("words").alias("word"), "label", "fold").groupBy("word").agg(*by_fold)
    table = counted.where(" + ".join(f"t{k}" for k in range(folds)) + " >= 3").toArrow()
    names = table.column("word").to_pylist()
    n = np.array([table.column(f"n{k}").to_numpy() for k in range(folds)], float)
    t = np.array([table.column(f"t{k}").to_numpy() for k in range(folds)], float)
    sizes = {r.fold: (r.n, r.t) for r in sample.groupBy("fold").agg(F.count("*").alias("n"), F.sum("label").alias("t")).collect()}
    size = np.array([sizes.get(k, (0, 0)) for k in range(folds)], float)

    def without(k: int | None) -> dict[str, float]:
        keep = np.array([i != k for i in range(folds)])
        return lexicon_of(names, t[keep].sum(axis=0), n[keep].sum(axis=0), int(size[keep, 1].sum()), int(size[keep, 0].sum()), lexicon_words)

    lexica = documents.sparkSession.sparkContext.broadcast([without(k) for k in range(folds)])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 500):
            folds_ = batch.column(2).to_pylist()
            out = [featurise(x or "", lexica.value[f]) for x, f in zip(batch.column(0).to_pylist(), folds_, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "label", "fold"])

    seen = text.select("text", "label", "fold").mapInArrow(features, "x array<double>, label int, fold int").toArrow()
    whole = without(None)
    x = np.array(seen.column("x").to_pylist(), float).reshape(-1, N_FEATURES)
    y, fold = seen.column("label").to_numpy().astype(float), seen.column("fold").to_numpy()
    order = np.lexsort((*x.T, y, fold))  # rows come in any order
    x, y, fold = x[order], y[order], fold[order]
    if len(set(y)) < 2 or len(y) < 20:
        return Model(whole, None, None, float(y.mean()) if len(y) else 0.5)
    apart = np.zeros(len(y))
    for k in range(folds):
        rest = fold != k
        apart[~rest] = BoostedTrees().fit(x[rest], y[rest]).raw(x[~rest]) if len(set(y[rest])) == 2 else 0.0
    return Model(whole, BoostedTrees().fit(x, y), Isotonic().fit(apart, y), float(y.mean()))


def score(documents: DataFrame, model: Model, rows_at_once: int = 500) -> DataFrame:
    """(doc_id, score) of each whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in parts(batches, rows_at_once):
            x = np.array([featurise(t or "", own.lexicon) for t in part.column(1).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own.score(x), pa.float64())], names=["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def held_out():
    return F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, by its whole text alone.

    Null and empty texts get the score of a text without words; texts of any
    length are read as a whole; without labels, or with labels of one kind only,
    all scores are their mean, or 0.5.  Of the texts of a labelled id the least
    is learned from, of its labels the greatest.  Rows that repeat are scored
    each, equal texts alike; an empty table gives no rows; extra columns are not
    read.
    """
    model = train(documents, labels.where(~held_out()))
    return score(documents, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
