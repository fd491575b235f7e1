"""Phrase collocations from count tries that are merged by ranges of their prefixes.

Every shard of documents counts its word sequences in a trie of limited depth, one
level at a time, and serialises it sorted, cut into the ranges that all shards share.
A range's task merges the shards' runs into one, which holds every count in full.

The first round counts paths of up to two words.  The second one counts longer paths,
where all pairs of neighbours passed a bitmap of the pairs that are frequent, since a
phrase is no more frequent than its parts; a bit that two pairs share costs work and
changes no count.  The merged run of a range, walked in order, meets the parents of a
node before it, which gives the counts of the left parts; the right part of a node is
where its suffix links lead, by a join of the frequent nodes with themselves.

A key is the language, a tab, and the words, joined by a byte that sorts first: NUL,
which in words is stored as a space.  A subtree's keys are therefore one range.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.llm.arrow_text import WORD_BASE, mix, text_slices, word_hashes, word_spans
from cytoframe.llm.tables import checkpointed

DEPTH = 4
#: Words that a shard's trie holds at most before it is serialised, and keys that a merge holds beyond its frequent ones before it adds up.
SHARD_WORDS, MERGE_ROWS = 1 << 19, 1 << 20
#: Bits of the bitmap of frequent pairs: 8 MB, whatever the size of the corpus.
PAIR_BITS = 1 << 26
#: Documents sampled for the bounds of ranges, for each range, and keys of them for each range.
SAMPLE_DOCUMENTS, SAMPLE_KEYS = 8, 64
_RUN = pa.schema([("key", pa.large_binary()), ("n", pa.int64())])
_RUNS = "range int, run binary"


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    lower[0] = 32
    piece = np.zeros(256, bool)
    piece[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
    word = ~piece
    word[[0x20, 0x09]] = False
    return lower, piece, word


LOWER, PIECE_END, WORD_BYTE = _tables()


class Words:
    """The words of some texts: their bytes, lengths, and for each the row and the piece that it is in."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, self.rows = word_spans(data, offsets, WORD_BYTE)
        lowered = LOWER[data]
        self.hashes = word_hashes(lowered, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        breaks = np.cumsum(PIECE_END[data])
        self.pieces = breaks[starts] if len(starts) else np.zeros(0, np.int64)
        self.lengths = ends - starts
        self.bytes = lowered[WORD_BYTE[data]]


class ShardTrie:
    """Counts the word sequences of up to ``DEPTH`` words, level by level, of the texts added so far."""

    def __init__(self):
        self.parts: list[tuple[Words, np.ndarray, np.ndarray]] = []
        self.size, self.langs = 0, {}

    def add(self, words: Words, langs: list[str]) -> None:
        """``langs``: of each row.  Words of different rows or pieces follow each other nowhere."""
        ids = np.array([self.langs.setdefault(x, len(self.langs)) for x in langs], np.int64)
        n = len(words.rows)
        joined = np.zeros(n, bool)
        joined[: n - 1] = (words.rows[1:] == words.rows[:-1]) & (words.pieces[1:] == words.pieces[:-1])
        self.parts.append((words, ids[words.rows], joined))
        self.size += n

    def levels(self, pairs: np.ndarray | None) -> tuple[pa.Array, list[tuple[np.ndarray, np.ndarray]]]:
        """The distinct words, sorted, and for each level the distinct nodes (language and word numbers, a row each) with counts.

        Without ``pairs`` there are levels 0 to 2, with it 3 and 4, of sequences
        whose pairs have their bits set.
        """
        lengths = np.concatenate([p[0].lengths for p in self.parts])
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        data = np.concatenate([p[0].bytes for p in self.parts])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        langs = np.concatenate([p[1] for p in self.parts])
        joined = np.concatenate([p[2] for p in self.parts])
        if pairs is not None:
            hashes = np.concatenate([p[0].hashes for p in self.parts])
            names = lang_hashes(list(self.langs))[langs]
            places = pair_places(names[:-1], hashes[:-1], hashes[1:])
            joined[:-1] &= (pairs[places >> 3] >> (places & 7) & 1).astype(bool)
            keep = joined.copy()
            keep[1:] |= joined[:-1]
            langs, joined = langs[keep], joined[keep]
            words = words.filter(pa.array(keep))
        coded = words.dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        numbers = rank[coded.indices.to_numpy()] if len(order) else np.zeros(0, np.int64)
        found = []
        parent, at = langs, np.arange(len(langs))
        nodes = np.arange(len(self.langs))[:, None]
        if pairs is None:
            found.append((nodes, np.bincount(langs, minlength=len(nodes))))
        for depth in range(1, DEPTH + 1 if pairs is not None else 3):
            if depth > 1:
                follows = joined[at + depth - 2]
                parent, at = parent[follows], at[follows]
            key, inverse, counts = np.unique(parent * max(len(order), 1) + numbers[at + depth - 1], return_inverse=True, return_counts=True)
            nodes = np.column_stack([nodes[key // max(len(order), 1)], key % max(len(order), 1)])
            parent = inverse
            if pairs is None or depth > 2:
                found.append((nodes, counts))
        return coded.dictionary.take(pa.array(order)), found

    def serialised(self, pairs: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
        """The keys of all nodes, sorted, and their counts."""
        words, levels = self.levels(pairs)
        roots = [x.encode() + b"\t" for x in self.langs]
        rank = np.argsort(np.argsort(np.array(roots, object), kind="stable"), kind="stable") if roots else np.zeros(0, np.int64)
        keys, places = [], []
        for nodes, _ in levels:
            path = [words.take(pa.array(nodes[:, k])) for k in range(1, nodes.shape[1])]
            text = pc.binary_join_element_wise(*path, pa.scalar(b"\0", pa.large_binary())) if path else pa.array([b""] * len(nodes), pa.large_binary())
            keys.append(pc.binary_join_element_wise(pa.array(roots, pa.large_binary()).take(pa.array(nodes[:, 0])), text, pa.scalar(b"", pa.large_binary())))
            padded = np.zeros((len(nodes), DEPTH + 1), np.int64)
            padded[:, 0], padded[:, 1 : nodes.shape[1]] = rank[nodes[:, 0]], nodes[:, 1:] + 1
            places.append(padded)
        if not keys:
            return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
        places, counts = np.concatenate(places), np.concatenate([c for _, c in levels])
        used = 3 if pairs is None else DEPTH + 1
        order = np.lexsort(places[:, used - 1 :: -1].T[: used]) if used > 3 else np.argsort((places[:, 0] * (len(words) + 1) + places[:, 1]) * (len(words) + 1) + places[:, 2], kind="stable")
        return pa.concat_arrays(keys).take(pa.array(order)), counts[order]


def lang_hashes(langs: list[str]) -> np.ndarray:
    data = "".join(langs).encode()
    ends = np.cumsum([len(x.encode()) for x in langs], dtype=np.int64) if langs else np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if langs else ends
    return word_hashes(np.frombuffer(data, np.uint8), starts, ends)


def pair_places(langs: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The bit of each pair of neighbours in the bitmap."""
    return (mix((langs * WORD_BASE + first) * WORD_BASE + second) & np.uint64(PAIR_BITS - 1)).astype(np.int64)


def parent_of(key: bytes) -> bytes | None:
    """The key of a node's parent; the languages are the roots."""
    if key.endswith(b"\t"):
        return None
    cut = max(key.rfind(b"\0"), tab := key.rfind(b"\t"))
    return key[: cut + 1] if cut == tab else key[:cut]


def _packed(keys: pa.Array, counts: np.ndarray) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64())], schema=_RUN)
    with pa.ipc.new_stream(sink, _RUN, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(run: bytes) -> pa.Table:
    return pa.ipc.open_stream(run).read_all()


def cut_runs(keys: pa.Array, counts: np.ndarray, bounds: pa.Array) -> Iterator[tuple[int, bytes]]:
    """A sorted run for each range that has keys.

    Range ``r`` begins at bound ``r - 1``, whose parents, which come before it,
    are added to its run: the nodes after the bound are below them.
    """
    at = [0, *[_place(keys, b.as_py()) for b in bounds], len(keys)]
    for r in range(len(at) - 1):
        above, key = [], parent_of(bounds[r - 1].as_py()) if r else None
        while key is not None:
            k = _place(keys, key)
            above += [k] if k < len(keys) and keys[k].as_py() == key else []
            key = parent_of(key)
        if at[r] < at[r + 1] or above:
            rows = np.concatenate([above[::-1], np.arange(at[r], at[r + 1])]).astype(np.int64)
            yield r, _packed(keys.take(pa.array(rows)), counts[rows])


def _place(keys: pa.Array, key: bytes) -> int:
    """How many of the sorted keys come before this one."""
    return bisect.bisect_left(range(len(keys)), key, key=lambda i: keys[i].as_py())


def merged(runs: Iterator[bytes], least: int) -> tuple[pa.Array, np.ndarray]:
    """The sum of sorted runs, sorted: the keys with at least that count in all runs, and the languages.

    Runs are added up whenever those that came since hold more keys than before,
    so what is held stays within a few times the range's distinct keys.
    """
    held, rows, most = [], 0, MERGE_ROWS
    for run in runs:
        held.append(_unpacked(run))
        rows += len(held[-1])
        if rows > most:
            held = [_summed(held)]
            rows = len(held[0])
            most = 2 * rows + MERGE_ROWS
    if not held:
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    total = _summed(held)
    total = total.filter(pc.or_(pc.greater_equal(total["n"], least), pc.ends_with(total["key"], b"\t")))
    total = total.take(pc.sort_indices(total["key"])).combine_chunks()
    keys = total["key"].chunk(0) if len(total) else pa.array([], pa.large_binary())
    return keys, total["n"].to_numpy()


def _summed(tables: list[pa.Table]) -> pa.Table:
    """Each key once, with the sum of its counts, which stay whole numbers below 2**53; the list of tables is used up."""
    both = pa.concat_tables(tables).combine_chunks()
    tables.clear()  # or the runs would be held twice
    if not len(both):
        return both
    coded = both["key"].chunk(0).dictionary_encode()
    sums = np.bincount(coded.indices.to_numpy(), weights=both["n"].to_numpy(), minlength=len(coded.dictionary))
    return pa.table({"key": coded.dictionary, "n": sums.astype(np.int64)}, schema=_RUN)


def walked(keys: pa.Array, counts: np.ndarray, first: bytes | None) -> Iterator[tuple]:
    """(lang, key, depth, a, n, lefts) of each node that is no root and not before ``first``; ``lefts``: the counts of its parents.

    The keys are a trie in preorder, so the parents of a node are on the stack.
    """
    stack: list[tuple[bytes, int]] = []
    for key, n in zip(keys.to_pylist(), counts.tolist(), strict=True):
        parent = parent_of(key)
        while stack and stack[-1][0] != parent:
            stack.pop()
        if stack and (first is None or key >= first):
            lang, _, words = key.rpartition(b"\t")
            yield lang.decode(), words, len(stack), n, stack[0][1], [c for _, c in stack[1:]]
        stack.append((key, n))


def _shards(batches: Iterator[pa.RecordBatch], pairs: np.ndarray | None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The serialised tries of a task's texts (lang, text), one for each ``SHARD_WORDS`` words or longer text."""
    trie = ShardTrie()
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for start, end, data, offsets in text_slices(batch, "text"):
            trie.add(Words(data, offsets), langs[start:end])
            if trie.size >= SHARD_WORDS:
                done, trie = trie.serialised(pairs), ShardTrie()
                yield done
                done = None
                _give_back()
    if trie.parts:
        done, trie = trie.serialised(pairs), None
        yield done
    done = None
    _give_back()


def _give_back() -> None:
    """Memory that Arrow keeps for later goes back: a worker lives on, and what it runs next may need none."""
    pa.default_memory_pool().release_unused()


def range_bounds(docs: DataFrame, n_ranges: int) -> pa.Array:
    """Keys that divide those of a sample of documents evenly: they share out the work, and change no result.

    Of the sample, a bounded number of documents for each range, each task gives
    keys that divide its own, in proportion to their number.
    """
    total = docs.count()
    share = min(1.0, max(500, SAMPLE_DOCUMENTS * n_ranges) / max(total, 1))
    sample = docs.sample(share, seed=11) if share < 1 else docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, _ in _shards(batches, None):
            step = max(1, len(keys) // (SAMPLE_KEYS * max(16, n_ranges // 8)))
            some = keys.take(pa.array(np.arange(step // 2, len(keys), step)))
            yield pa.RecordBatch.from_arrays([some.cast(pa.binary()), pa.array(np.full(len(some), step), pa.int64())], names=["key", "weight"])

    found = sample.coalesce(8).mapInArrow(run, "key binary, weight long").toArrow()
    found = found.take(pc.sort_indices(found["key"]))
    weights = np.cumsum(found["weight"].to_numpy())
    if not len(weights):
        return pa.array([], pa.large_binary())
    at = np.searchsorted(weights, weights[-1] * np.arange(1, n_ranges) / n_ranges)
    keys = pc.unique(found["key"].take(pa.array(at)))
    return keys.cast(pa.large_binary())


def _range_rows(pairs_found) -> Iterator[pa.RecordBatch]:
    for r, run in pairs_found:
        yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([run], pa.binary())], names=["range", "run"])


def shard_runs(docs: DataFrame, bounds: pa.Array, bitmap=None) -> DataFrame:
    """(range, run): the runs of all shards' tries of ``docs`` (lang, text); of the second round where there is a bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        for keys, counts in _shards(batches, pairs):
            yield from _range_rows(cut_runs(keys, counts, bounds))

    return docs.select("lang", "text").mapInArrow(run, _RUNS)


def _by_range(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """The merged run of each range of a task, which has one: the numbers of ranges are those of partitions."""
    runs: dict[int, list[bytes]] = {}
    for batch in batches:
        for r, run in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            runs.setdefault(r, []).append(run)
    for r in sorted(runs):
        yield r, *merged(iter(runs.pop(r)), least)
        _give_back()


def merge_runs(runs: DataFrame, n_ranges: int, least: int) -> DataFrame:
    """(range, run): one run for each range, with the keys of at least ``least``, the languages, and the parents of its bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, keys, counts in _by_range(batches, least):
            yield from _range_rows([(r, _packed(keys, counts))])

    return runs.repartitionById(n_ranges, "range").mapInArrow(run, _RUNS)


def _pair_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column(1).to_pylist():
            keys = _unpacked(packed)["key"].to_pylist()
            pairs = [(lang, words) for lang, _, words in (k.rpartition(b"\t") for k in keys) if b"\0" in words]
            langs = [x.decode() for x, _ in pairs]
            text = b"".join(w for _, w in pairs)
            both = np.array([(len(w), w.index(b"\0")) for _, w in pairs], np.int64).reshape(-1, 2)
            ends = np.cumsum(both[:, 0])
            starts = ends - both[:, 0]
            data = np.frombuffer(text, np.uint8)
            first, second = word_hashes(data, starts, starts + both[:, 1]), word_hashes(data, starts + both[:, 1] + 1, ends)
            names = dict.fromkeys(langs)
            of = dict(zip(names, lang_hashes(list(names)), strict=True))
            places = np.unique(pair_places(np.array([of[x] for x in langs], np.uint64), first, second))
            yield pa.RecordBatch.from_arrays([pa.array(places)], names=["place"])


def frequent_pairs(merged_runs: DataFrame) -> bytes:
    """The bitmap of the merged runs' pairs: at most ``PAIR_BITS`` bits come to the driver, in pages that Spark puts together."""
    places = merged_runs.mapInArrow(_pair_bits, "place long")
    # Spark numbers pages and bits of positive numbers, so place p is the number p + 1.
    number = F.col("place") + 1
    pages = places.groupBy(F.bitmap_bucket_number(number).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")).toArrow()
    bits = bytearray(PAIR_BITS // 8)
    for page, found in zip(pages["page"].to_pylist(), pages["bits"].to_pylist(), strict=True):
        bits[(page - 1) * 4096 : page * 4096] = found
    return bytes(bits)


_NODES = "lang string, words binary, depth int, a long, n long, lefts array<long>"


def frequent_nodes(docs: DataFrame, least: int, n_ranges: int | None = None) -> DataFrame:
    """(lang, words, depth, a, n, lefts) of all sequences of up to ``DEPTH`` words with ``a >= least``, of docs (lang, text).

    ``words`` are joined by NUL; ``n`` counts the language's words, ``lefts`` the sequence without its last words, shortest first.
    """
    spark = docs.sparkSession
    bounds = range_bounds(docs, n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions")))
    n_ranges = len(bounds) + 1
    short = checkpointed(merge_runs(shard_runs(docs, bounds), n_ranges, least))
    bitmap = spark.sparkContext.broadcast(frequent_pairs(short))
    runs = short.unionByName(shard_runs(docs, bounds, bitmap))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        names = [x.split()[0] for x in _NODES.split(", ")]
        for r, keys, counts in _by_range(batches, least):
            columns = [[] for _ in types]
            for row in walked(keys, counts, bounds[r - 1].as_py() if r else None):
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return checkpointed(runs.repartitionById(n_ranges, "range").mapInArrow(walk, _NODES))


def mine(docs: DataFrame, least: int = 30, most: int = 2000, inside_percent: int = 80, n_ranges: int | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``most`` best phrases of two to four words of each language.

    Words are those of the pieces between ``.,;:!?`` and line ends, lower-case in
    A-Z.  A phrase with ``a >= least`` scores floor(2000000 a / (l + r)) at its
    lowest cut, the shortest left part of equal ones; phrases whose words are
    inside a longer one with at least ``inside_percent`` of ``a`` go.  Ties are
    ordered by ``a`` and then by the phrase's bytes.  A null lang is ``und``, null
    and empty texts have no words, texts of any length are counted whole, repeated
    rows count each, other columns are not read, an empty table gives none.
    ``n_ranges`` is the session's number of shuffle partitions unless it is given.
    """
    lang = F.replace(F.replace(F.coalesce(F.col("lang"), F.lit("und")), F.lit("%"), F.lit("%25")), F.lit("\t"), F.lit("%09"))
    nodes = frequent_nodes(docs.select(lang.alias("lang"), "text"), least, n_ranges)
    nodes = nodes.withColumn("words", F.split(F.decode("words", "UTF-8"), "\\x00"))
    candidates = nodes.where("depth > 1")

    def part(first, length):
        return F.slice("words", first, length)

    # Suffix links: a node without its first k words is the right part of its cut k.
    cuts = F.transform(F.sequence(F.lit(1), F.col("depth") - 1), lambda k: F.struct(k.alias("k"), F.get("lefts", k - 1).alias("l"), part(k + 1, F.col("depth") - k).alias("suffix")))
    linked = candidates.select("lang", "words", "a", "n", F.explode(cuts).alias("c")).select("lang", "words", "a", "n", "c.*")
    right = nodes.select("lang", F.col("words").alias("suffix"), F.col("a").alias("r"))
    scored = linked.join(right, ["lang", "suffix"]).withColumn("score", F.expr("CAST((CAST(a AS DECIMAL(31, 0)) * 2000000) DIV (CAST(l AS DECIMAL(20, 0)) + r) AS LONG)"))
    best = scored.groupBy("lang", "words").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b")).select("lang", "words", "b.*")

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("depth") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("depth") - m + 1), lambda i: part(i, m))))
    inside = candidates.where("depth > 2").select("lang", F.explode(inner).alias("words"), "a").groupBy("lang", "words").agg(F.max("a").alias("longer"))
    covered = F.col("longer").isNotNull() & (F.col("longer").cast("decimal(22, 0)") * 100 >= F.col("a").cast("decimal(22, 0)") * inside_percent)
    kept = best.join(inside, ["lang", "words"], "left").where(~covered)

    phrase = F.replace(F.replace(F.array_join("words", "\t"), F.lit(" "), F.lit("\u0000")), F.lit("\t"), F.lit(" "))
    named = kept.select(F.replace(F.replace("lang", F.lit("%09"), F.lit("\t")), F.lit("%25"), F.lit("%")).alias("lang"), phrase.alias("phrase"), "a", "l", "r", "n", "score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same rows for DuckDB.
ORACLE_SQL = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
listed AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM listed GROUP BY lang),
found AS (
    SELECT lang, w[i : i + m - 1] AS words FROM (
        SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM listed, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)),
counted AS (SELECT lang, words, len(words) AS depth, count(*) AS a FROM found GROUP BY lang, words HAVING count(*) >= 30),
cuts AS (SELECT lang, words, a, depth, unnest(range(1, depth)) AS k FROM counted WHERE depth > 1),
scored AS (
    SELECT c.lang, c.words, c.a, c.k, x.a AS l, y.a AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (x.a + y.a) AS BIGINT) AS score
    FROM cuts c JOIN counted x ON x.lang = c.lang AND x.words = c.words[1 : c.k]
    JOIN counted y ON y.lang = c.lang AND y.words = c.words[c.k + 1 :]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inner_parts AS (
    SELECT lang, a AS longer, words[i : i + m - 1] AS words FROM (
        SELECT lang, a, words, m, unnest(range(1, depth - m + 2)) AS i FROM counted, (SELECT unnest([2, 3]) AS m) WHERE depth > m)),
covered AS (SELECT DISTINCT b.lang, b.words FROM best b JOIN inner_parts i ON i.lang = b.lang AND i.words = b.words WHERE 100 * i.longer >= 80 * b.a),
kept AS (SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score FROM best b ANTI JOIN covered c ON c.lang = b.lang AND c.words = b.words),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
