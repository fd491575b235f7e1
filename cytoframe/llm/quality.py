"""Quality scores by co-training a classifier of the text and one of its metadata."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.arrow_text import NOT_SPACE, WORD_BASE, mix, parts, text_slices, word_hashes, word_spans
from cytoframe.llm.learners import BoostedTrees, Isotonic, Logistic, logit, sigmoid
from cytoframe.llm.tables import checkpointed
from cytoframe.llm.toxicity import sampled

_SYMBOLS = re.compile(r"[#*$%&|<>@^~_=+\\{}\[\]]")
_PUNCTUATION = re.compile(r"[.,;:!?]")
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]")
_DIGITS = re.compile(r"[0-9]")
N_TEXT, N_LANG, N_SOURCE = 16, 64, 512
#: Columns that words and pairs of words are hashed to.
N_GRAMS = 4096
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def text_view(text: str) -> list[float]:
    """Content features of one whole text."""
    words, lines = text.split(), [x for x in text.split("\n") if x and not x.isspace()]
    n, chars, n_lines = max(len(words), 1), max(len(text), 1), max(len(lines), 1)
    raw = text.encode("utf-8", "replace")
    letters = max(len(_LETTERS.findall(text)), 1)
    return [
        np.log1p(len(words)),
        len(_SYMBOLS.findall(text)) / n,
        len(_PUNCTUATION.findall(text)) / n,
        text.count("!") / n,
        len(_CAPITALS.findall(text)) / letters,
        letters / chars,
        len(_DIGITS.findall(text)) / chars,
        sum(map(len, words)) / n,
        len(set(words)) / n,
        len(set(lines)) / n_lines,
        n / n_lines,
        np.log1p(len(lines)),
        len(zlib.compress(raw, 1)) / max(len(raw), 1),
        text.count("|") / n,
        sum(x.rstrip()[-1:] in ".!?\"'" for x in lines) / n_lines,
        max(map(len, words), default=0),
    ]


def gram_view(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """For each text, which columns its words and its pairs of words are hashed to, as packed bits."""
    out = np.zeros((len(batch), N_GRAMS // 8), np.uint8)
    for start, end, data, offsets in text_slices(batch, column):
        starts, ends, rows = word_spans(data, offsets, NOT_SPACE)
        words = word_hashes(_LOWER[data], starts, ends)
        seen = np.zeros((end - start, N_GRAMS), bool)
        seen[rows, words >> np.uint64(52)] = True
        pair = rows[1:] == rows[:-1]
        seen[rows[1:][pair], mix(words[:-1] * WORD_BASE + words[1:])[pair] >> np.uint64(52)] = True
        out[start:end] = np.packbits(seen, axis=1)
    return out


def gram_weights(grams: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Log odds of each hashed column between good and bad texts."""
    sums = np.ones((2, N_GRAMS))
    totals = np.full(2, 2.0)
    for low in range(0, len(grams), 2000):
        bits = np.unpackbits(grams[low : low + 2000], axis=1).astype(np.float32)
        for label in (0, 1):
            w = (weight * (y == label))[low : low + 2000]
            sums[label] += w @ bits
            totals[label] += w.sum()
    return (np.log(sums[1] / totals[1]) - np.log(sums[0] / totals[0])).astype(np.float32)


def gram_score(grams: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The mean log odds of each text's columns."""
    out = np.zeros(len(grams))
    for low in range(0, len(grams), 2000):
        bits = np.unpackbits(grams[low : low + 2000], axis=1).astype(np.float32)
        out[low : low + 2000] = bits @ weights / np.maximum(bits.sum(axis=1), 1)
    return out


class TextView:
    """Trees on a text's surface and on the log odds of its words, which no row's own label takes part in."""

    def fit(self, t: np.ndarray, g: np.ndarray, y: np.ndarray, weight: np.ndarray) -> TextView:
        apart = np.zeros(len(y))
        half = np.arange(len(y)) % 2 == 0
        for mine in (half, ~half):
            apart[mine] = gram_score(g[mine], gram_weights(g[~mine], y[~mine], weight[~mine]))
        self.trees = BoostedTrees(trees=60).fit(np.column_stack([t, apart]), y, weight)
        self.weights = gram_weights(g, y, weight)
        return self

    def raw(self, t: np.ndarray, g: np.ndarray) -> np.ndarray:
        return self.trees.raw(np.column_stack([t, gram_score(g, self.weights)]))


def metadata_view(lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    """Features of a row's other columns; names are hashed to a fixed number of columns."""
    out = [0.0] * (2 + N_LANG + N_SOURCE)
    size = float(np.log1p(max(n_chars or 0, 0)))
    out[0], out[1] = size, size * size
    out[2 + zlib.crc32((lang or "").encode()) % N_LANG] = 1.0
    out[2 + N_LANG + zlib.crc32((source or "").encode()) % N_SOURCE] = 1.0
    return out


@dataclass
class Model:
    text: TextView | None
    metadata: Logistic | None
    text_scale: Isotonic | None
    metadata_scale: Isotonic | None
    prior: float
    #: Pseudo-labels that the views gave each other, round by round.
    exchanged: tuple[int, ...] = ()

    def views(self, t: np.ndarray, g: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.text is None:
            return np.full(len(t), self.prior), np.full(len(t), self.prior)
        return self.text_scale(self.text.raw(t, g)), self.metadata_scale(self.metadata.raw(m))

    def score(self, t: np.ndarray, g: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both calibrated views and their product of odds over the prior's."""
        a, b = self.views(t, g, m)
        return sigmoid(logit(a) + logit(b) - logit(np.full(len(a), self.prior))), a, b


def co_train(t: np.ndarray, g: np.ndarray, m: np.ndarray, y: np.ndarray, fold: np.ndarray, rounds: int = 4, sure: float = 0.95, most: float = 0.1) -> Model:
    """Two views teach each other: in each round each view labels the pool's rows it is surest of, for the other.

    ``y`` is 1, 0, or -1 for the pool.  Labelled rows of fold 0 calibrate and
    never train.  A pseudo-label needs a calibrated probability of ``sure`` and
    has half a label's weight; in a round each view gives at most the share
    ``most`` of the pool for each class, ties by row.
    """
    known = y >= 0
    hold, learn, pool = known & (fold == 0), known & (fold != 0), np.flatnonzero(~known)
    prior = float(np.clip(y[known].mean(), 1e-3, 1 - 1e-3)) if known.any() else 0.5
    if len(set(y[learn])) < 2 or len(set(y[hold])) < 2:
        return Model(None, None, None, None, prior)
    given: list[dict[int, int]] = [{}, {}]  # pseudo-labels for the text and for the metadata view

    def seen(view: int, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        return (t[rows], g[rows]) if view == 0 else (m[rows],)

    def fit(view: int):
        extra = given[view]
        rows = np.concatenate([np.flatnonzero(learn), np.fromiter(extra, int, len(extra))])
        labels = np.concatenate([y[learn], np.fromiter(extra.values(), float, len(extra))])
        weight = np.concatenate([np.ones(int(learn.sum())), np.full(len(extra), 0.5)])
        model = (TextView() if view == 0 else Logistic(5.0)).fit(*seen(view, rows), labels, weight)
        return model, Isotonic().fit(model.raw(*seen(view, np.flatnonzero(hold))), y[hold])

    fitted, exchanged = [fit(0), fit(1)], []
    for _ in range(rounds):
        added = 0
        for view in (0, 1):
            model, scale = fitted[view]
            other = given[1 - view]
            free = np.array([i for i in pool if i not in other], int)
            if not len(free):
                continue
            p = scale(model.raw(*seen(view, free)))
            limit = max(1, int(most * len(pool)))
            for label, sureness in ((1, p), (0, 1 - p)):
                for i in np.argsort(-sureness, kind="stable")[:limit]:
                    if sureness[i] >= sure:
                        other[int(free[i])] = label
                        added += 1
        if not added:
            break
        exchanged.append(added)
        fitted = [fit(0), fit(1)]
    return Model(fitted[0][0], fitted[1][0], fitted[0][1], fitted[1][1], prior, tuple(exchanged))


def _views(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The views of rows whose columns from ``at`` on are text, lang, source, n_chars: surface, words, metadata."""
    text, lang, source, size = (batch.column(at + k).to_pylist() for k in range(4))
    t = np.array([text_view(x or "") for x in text], float).reshape(-1, N_TEXT)
    m = np.array([metadata_view(*x) for x in zip(lang, source, size, strict=True)], float).reshape(-1, 2 + N_LANG + N_SOURCE)
    return t, gram_view(batch, batch.schema.names[at]), m


_INPUTS = ("text", "lang", "source", "n_chars")


def train(documents: DataFrame, labels: DataFrame, labelled: int = 15_000, pool: int = 15_000, **how) -> Model:
    """Co-train on at most ``labelled`` labelled and ``pool`` other documents; only their features reach the driver.

    A row of ``labels`` without a quality labels nothing.
    """
    known = sampled(labels, "quality", labelled)
    others = documents.select("doc_id").where("doc_id is not null").join(labels.where("quality is not null").select("doc_id"), "doc_id", "left_anti").distinct()
    others = others.orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").limit(pool).withColumn("label", F.lit(-1))
    # At most labelled + pool ids, so that broadcasting them is bounded.
    sample = checkpointed(known.union(others).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(21)), F.lit(4)).cast("int")))
    # One row for each id, however often it repeats, so that what is learned from has its bound.
    rows = documents.select("doc_id", *_INPUTS).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label", "fold").agg(F.min(F.struct(*_INPUTS)).alias("row")).select("doc_id", "label", "fold", "row.*")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 500):
            t, g, m = _views(batch, 3)
            packed = [pa.array([x.tobytes() for x in view], pa.binary()) for view in (t.astype(np.float32), g, m.astype(np.float32))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *packed], names=["doc_id", "label", "fold", "t", "g", "m"])

    seen = rows.mapInArrow(features, "doc_id long, label int, fold int, t binary, g binary, m binary").toArrow()
    seen = seen.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    arrays = [np.frombuffer(b"".join(seen.column(c).to_pylist()), kind).reshape(len(seen), -1 if len(seen) else width) for c, kind, width in (("t", np.float32, N_TEXT), ("g", np.uint8, N_GRAMS // 8), ("m", np.float32, 2 + N_LANG + N_SOURCE))]
    return co_train(*arrays, seen.column("label").to_numpy().astype(float), seen.column("fold").to_numpy(), **how)


def score_documents(documents: DataFrame, labels: DataFrame, rows_at_once: int = 500, **how) -> DataFrame:
    """doc_id, score, text_score, metadata_score, kept for every row, by its whole text and metadata.

    ``kept`` is a score of at least one half.  Nulls in any column are empty
    values; texts of any length are read as a whole; without labels of both
    kinds every score is the labels' mean, or one half.  An id with several
    labels has the greatest, and of its rows the least is learned from.  Rows
    that repeat are scored each, equal rows alike; an empty table gives no rows;
    extra columns are not read.
    """
    model = documents.sparkSession.sparkContext.broadcast(train(documents, labels, **how))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, rows_at_once):
            scores = model.value.score(*_views(part, 1))
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(s, pa.float64()) for s in scores]], names=["doc_id", "score", "text_score", "metadata_score"])

    scored = documents.select("doc_id", *_INPUTS).mapInArrow(run, "doc_id long, score double, text_score double, metadata_score double")
    return scored.withColumn("kept", F.col("score") >= 0.5)
