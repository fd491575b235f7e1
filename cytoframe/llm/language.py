"""Language identification by prediction by partial matching over bytes, under frozen statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.arrow_text import text_slices
from cytoframe.llm.tables import hash_share, id_remainder

ORDER = 4  # bytes of context at most; a gram is a context and the byte after it
PAD = 0x0A
EVIDENCE_BYTES = 48.0
UNDETERMINED = "und"


def _fold_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[ord("0") : ord("9") + 1] = ord("0")
    return table


_FOLD = _fold_table()


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Case-folded bytes with ``ORDER`` line feeds before each text; where each text starts in them.

    A to Z and the capitals of Latin-1 in UTF-8 become small letters, digits 0.
    """
    n = len(offsets) - 1
    folded = _FOLD[data]
    if len(data) > 1:
        capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
        folded[1:][capital] += 0x20
    out = np.full(len(data) + ORDER * n, PAD, np.uint8)
    lengths = np.diff(offsets)
    shift = np.repeat(ORDER * np.arange(1, n + 1), lengths)
    out[np.arange(len(data)) + shift] = folded
    return out, offsets[:-1] + ORDER * np.arange(1, n + 1)


def grams(out: np.ndarray) -> np.ndarray:
    """At each place of ``out`` after the first ``ORDER``, the last ``ORDER`` + 1 bytes as a number."""
    n = len(out) - ORDER
    key = out[:n].astype(np.uint64)
    for k in range(1, ORDER + 1):
        key <<= np.uint64(8)
        key |= out[k : k + n]
    return key


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted among sorted keys, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


@dataclass
class Tree:
    """One language's context tree: for each order its grams' code lengths and its contexts' escapes.

    ``costs[k]`` holds, for every gram of ``k`` + 1 bytes that the language has,
    the exact code length in bits of its last byte after the others: with escape
    method C, a seen byte costs -log2(count / (total + distinct)).  An unseen
    one costs the escape, -log2(distinct / (total + distinct)), and what it
    costs after the context without its first byte; a context that was never
    seen costs nothing and is shortened.  Below the empty context all 256 bytes
    are alike.
    """

    keys: list[np.ndarray]
    costs: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def nbytes(self) -> int:
        return sum(x.nbytes for part in (self.keys, self.costs, self.contexts, self.escapes) for x in part)

    def cost(self, key: np.ndarray) -> np.ndarray:
        """Code length in bits of the last byte of each gram of full length."""
        out = np.zeros(len(key), np.float32)
        left = np.arange(len(key))
        for k in range(ORDER, -1, -1):
            place, known = _find(self.keys[k], key)
            out[left[known]] += self.costs[k][place[known]]
            left, key = left[~known], key[~known]
            place, known = _find(self.contexts[k], key >> np.uint64(8))
            out[left[known]] += self.escapes[k][place[known]]
            if k:
                key = key & np.uint64((1 << (8 * k)) - 1)
        out[left] += 8.0
        return out


@dataclass
class Model:
    """The trees of all languages, each by itself, so that the size grows with what each language has."""

    languages: list[str]
    trees: list[Tree]

    def nbytes(self) -> int:
        return sum(t.nbytes() for t in self.trees)

    def bits(self, out: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Code length in bits of each text under each language."""
        total = np.zeros((len(lengths), len(self.languages)))
        some = np.flatnonzero(lengths > 0)
        if not len(some):
            return total
        key, inverse = np.unique(grams(out), return_inverse=True)
        bounds = np.empty(2 * len(some), np.int64)
        bounds[0::2] = starts[some] - ORDER
        bounds[1::2] = starts[some] - ORDER + lengths[some]
        if bounds[-1] == len(inverse):
            bounds = bounds[:-1]
        for j, tree in enumerate(self.trees):
            total[some, j] = np.add.reduceat(tree.cost(key)[inverse], bounds, dtype=np.float64)[0::2]
        return total


def grow(grams_: np.ndarray, counts: np.ndarray) -> Tree:
    """Freeze a language's tree from its grams of full length and their counts."""
    tree = Tree([], [], [], [])
    for k in range(ORDER + 1):
        keys, inverse = np.unique(grams_ & np.uint64((1 << (8 * (k + 1))) - 1), return_inverse=True)
        own = np.bincount(inverse, weights=counts, minlength=len(keys))
        contexts, at = np.unique(keys >> np.uint64(8), return_inverse=True)
        total, distinct = np.bincount(at, weights=own), np.bincount(at)
        tree.keys.append(keys)
        tree.costs.append(np.log2((total[at] + distinct[at]) / own).astype(np.float32))
        tree.contexts.append(contexts)
        tree.escapes.append(np.log2((total + distinct) / distinct).astype(np.float32))
    return tree


def pruned(tree: Tree, grams_: np.ndarray, counts: np.ndarray, most_bytes: int) -> Tree:
    """The tree, without the longest grams of the least counts where it is larger than ``most_bytes``.

    The shorter orders stay whole, and the statistics of what is left are those
    of all counts: a pruned gram costs its escape and what a shorter one costs,
    and a context that has no gram left is as one that was never seen.
    """
    least = 2
    while tree.nbytes() > most_bytes and least <= counts.max():
        for k in (ORDER, ORDER - 1):
            own = np.unique(grams_ & np.uint64((1 << (8 * (k + 1))) - 1), return_inverse=True)
            n = np.bincount(own[1], weights=counts)
            keep = np.isin(tree.keys[k], own[0][n >= least])
            tree.keys[k], tree.costs[k] = tree.keys[k][keep], tree.costs[k][keep]
            used = np.isin(tree.contexts[k], np.unique(tree.keys[k] >> np.uint64(8)))
            tree.contexts[k], tree.escapes[k] = tree.contexts[k][used], tree.escapes[k][used]
            if tree.nbytes() <= most_bytes:
                break
        least *= 2
    return tree


def build(counted: dict[str, tuple[np.ndarray, np.ndarray]], most_bytes: int = 100_000_000) -> Model:
    """Freeze the model from each language's grams of full length and their counts.

    Where all trees take more than ``most_bytes``, each is pruned to an equal share.
    """
    languages = sorted(counted)
    trees = [grow(*counted[x]) for x in languages]
    if sum(t.nbytes() for t in trees) > most_bytes:
        trees = [pruned(t, *counted[x], most_bytes // len(languages)) for x, t in zip(languages, trees, strict=True)]
    return Model(languages, trees)


def train(labelled: DataFrame, docs_per_language: int = 400, window_chars: int = 100_000, most_languages: int = 256, seed: int = 3) -> Model | None:
    """Count the grams of a bounded sample of ``text`` by ``lang`` and freeze them.

    ``labelled`` has doc_id, text and lang.  From each language about
    ``docs_per_language`` texts are taken by a hash of their ids, of texts of
    more than ``window_chars`` characters that many at a place chosen by a hash,
    and of languages the ``most_languages`` with the most rows, ties by name:
    documented parameters that bound what is learned from.  Counting is
    distributed and combined before its shuffle.  None where no row has a text
    and a language.
    """
    labelled = labelled.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()}
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, docs_per_language / n))])
    start = 1 + F.floor(hash_share("doc_id", seed + 1) * (F.length("text") - window_chars)).cast("int")
    piece = F.when(F.length("text") > window_chars, F.substring("text", start, F.lit(window_chars))).otherwise(F.col("text"))
    sample = labelled.where(hash_share("doc_id", seed) < F.coalesce(F.element_at(share, F.col("lang")), F.lit(0.0))).withColumn("text", piece)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}

        def sums(parts: list) -> tuple[np.ndarray, np.ndarray]:
            keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return keys, np.bincount(inverse, weights=np.concatenate([p[1] for p in parts]), minlength=len(keys)).astype(np.int64)

        for batch in batches:
            langs = np.asarray(batch.column(2).to_pylist(), dtype=object)
            for start, end, data, offsets in text_slices(batch, "text"):
                out, _ = padded(data, offsets)
                if len(out) <= ORDER:
                    continue
                key = grams(out)
                lengths = np.diff(offsets)
                spans = np.repeat(langs[start:end], lengths)
                keep = np.concatenate([np.arange(b, b + n) for b, n in zip(offsets[:-1] + ORDER * np.arange(end - start), lengths, strict=True)])
                key = key[keep]
                for language in set(langs[start:end]):
                    mine = key[spans == language]
                    parts = held.setdefault(language, [])
                    parts.append((mine, np.ones(len(mine), np.int64)))
                    if len(parts) > 8:
                        held[language] = [sums(parts)]
        for language, parts in held.items():
            keys, counts = sums(parts)
            for i in range(0, len(keys), 50_000):
                k = keys[i : i + 50_000].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(k)), pa.array(k), pa.array(counts[i : i + 50_000])], names=["lang", "gram", "n"])

    counted = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = counted.column("lang").to_numpy(zero_copy_only=False)
    keys, counts = counted.column("gram").to_numpy().astype(np.uint64), counted.column("n").to_numpy()
    if not len(keys):
        return None
    return build({x: (keys[names == x], counts[names == x]) for x in set(names)})


def identify(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with lang_pred and score, for every row by its whole text.

    ``score`` is the chosen language's share in the likelihoods that the mean
    code length of a byte gives over at most ``EVIDENCE_BYTES`` bytes, so that
    length alone makes no certainty.  Null and empty texts, texts without a
    letter (``str.isalpha``), and all texts where nothing was learned are
    ``und`` with score 0; ties go to the first language by name; texts of any
    length are scored as a whole, repeated rows each; an empty table gives none.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", lang_pred string, score double"
    shared = docs.sparkSession.sparkContext.broadcast(model)
    wanted = list(keep) + ([] if "text" in keep else ["text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            names, scores = [], []
            texts = batch.column(wanted.index("text"))
            for start, end, data, offsets in text_slices(batch, "text"):
                letters = np.zeros(end - start, bool)
                plain = ((data | 0x20) >= ord("a")) & ((data | 0x20) <= ord("z"))
                sums = np.concatenate([[0], np.cumsum(plain)])
                letters = sums[offsets[1:]] > sums[offsets[:-1]]
                for i in np.flatnonzero(~letters & (np.diff(offsets) > 0)):
                    letters[i] = any(map(str.isalpha, texts[start + int(i)].as_py()))
                if own is None:
                    letters[:] = False
                    bits = np.zeros((end - start, 1))
                else:
                    out, starts = padded(data, offsets)
                    bits = own.bits(out, starts, np.diff(offsets))
                n = np.maximum(np.diff(offsets), 1)[:, None]
                mean = bits / n * np.minimum(n, EVIDENCE_BYTES) * np.log(2)
                odds = np.exp(mean.min(axis=1, keepdims=True) - mean)
                best = bits.argmin(axis=1)
                share = odds[np.arange(len(best)), best] / odds.sum(axis=1)
                names += [own.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters, strict=True)]
                scores += np.where(letters, share, 0.0).tolist()
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"])

    return docs.select(*wanted).mapInArrow(run, schema)


def held_out():
    """True for rows that no model learns from."""
    return id_remainder("doc_id", 4) == 2


def identify_documents(documents: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out and predict all rows."""
    model = train(documents.where(~F.coalesce(held_out(), F.lit(True))))
    found = identify(documents, model)
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(documents: DataFrame, least: float = 0.4) -> DataFrame:
    """The documents with a language: all but ``und`` and those whose score is under ``least``."""
    columns = documents.columns
    model = train(documents.where(~F.coalesce(held_out(), F.lit(True))))
    # Numbered names, so that no column of the documents clashes with the prediction's.
    held = documents.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], F.col("text").alias("text"))
    found = identify(held, model, tuple(f"c{i}" for i in range(len(columns))))
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
