"""N-gram Jaccard self-join by chosen paths, with exact links and classes.

1. Texts become sets of hashed word shingles; equal sets are one *set* from here
   on, whatever the number of their copies.
2. Every set gets a minhash signature, the embedding whose coordinates are the
   tokens that two sets share with probability equal to their similarity.
3. Chosen paths: each run starts at a root that holds all sets.  A node samples
   one or two coordinates by a hash of its path, 1 / threshold on average, and
   a set goes to the child of its value at each.  Nodes of up to ``leaf`` sets
   are compared by brute force; larger ones are split again, and what is still
   large at the last depth, sets that are alike, is compared in blocks.
   Runs, each with coordinates of its own, repeat until a pair at the threshold
   that meets at the last depth only is met with the target recall.
4. Candidate groups, the components of pairs whose estimate is not clearly too
   low, get an exact comparison of their shingle sets, in blocks, which counts
   every link within and keeps a spanning forest of the links for the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.llm.arrow_text import mix, shingle_hashes, text_slices, word_hashes, word_spans
from cytoframe.llm.tables import checkpointed, spread_join

#: Coordinates whose last 8 bits are compared in leaves, and those that each run chooses from.
COORDINATES = 64
RUN_COORDINATES = 16
#: A node's last 8 bits are its run.
_RUN = np.uint64(0xFF)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Words are runs of letters, digits and all that is not ASCII, after A to Z became small.
_WORD = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row, by row and then by hash; their rows."""
    n = len(offsets) - 1
    starts, ends, rows = word_spans(data, offsets, _WORD)
    hashes, owners = shingle_hashes(word_hashes(_LOWER[data], starts, ends), rows, n, width)
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[new], owners[new]


def set_ids(hashes: np.ndarray, owners: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row's set that depends on its members alone, and its size; 0 and 0 without any."""
    sizes = np.bincount(owners, minlength=n)
    some = np.flatnonzero(sizes)
    ids = np.zeros(n, np.uint64)
    if len(some):
        first = (np.cumsum(sizes) - sizes)[some]
        sums = np.add.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), first)
        ids[some] = mix(sums ^ (sizes[some].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return ids.view(np.int64), sizes


def signatures(hashes: np.ndarray, sizes: np.ndarray, coordinates: int) -> np.ndarray:
    """Minhash values of the rows with members, 32 bits for each coordinate."""
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    numbers = np.arange(1, coordinates + 1, dtype=np.uint64)
    multipliers, shifts = mix(numbers * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1), mix(numbers * np.uint64(0xA0761D6478BD642F))
    out = np.empty((len(first), coordinates), np.uint32)
    for k in range(coordinates):
        if len(first):
            out[:, k] = np.minimum.reduceat(hashes * multipliers[k] + shifts[k], first) >> np.uint64(32)
    return out


def fixed_binary(rows: np.ndarray) -> pa.Array:
    """Rows of a contiguous 2-D array as an Arrow binary column."""
    width = rows.shape[1] * rows.itemsize
    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width).buffers()[1]
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def survival(threshold: float, depth: int) -> float:
    """Chance that one run brings a pair at the threshold into one leaf at this depth."""
    two, q = 1 / threshold - 1, 1.0
    for _ in range(depth):
        p = threshold * q
        q = (1 - two) * p + two * (1 - (1 - p) ** 2)
    return q


def roots(runs: int) -> np.ndarray:
    """The node of each run that holds all sets."""
    own = np.arange(runs, dtype=np.uint64)
    return mix(own + np.uint64(1)) & ~_RUN | own


def chosen(nodes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first and the second of its run's coordinates that each node samples, and whether it takes the second."""
    h = mix(nodes)
    first = (h % np.uint64(RUN_COORDINATES)).astype(np.int64)
    second = (first + 1 + ((h >> np.uint64(16)) % np.uint64(RUN_COORDINATES - 1)).astype(np.int64)) % RUN_COORDINATES
    return first, second, (h >> np.uint64(40)).astype(np.float64) / (1 << 24) < 1 / threshold - 1


def children(nodes: np.ndarray, own: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The chosen children of records in a node each, by their values of its run; the rows of the children."""
    first, second, two = chosen(nodes, threshold)
    twice = np.flatnonzero(two)
    rows = np.concatenate([np.arange(len(nodes)), twice])
    at = np.concatenate([first, second[twice]])
    values = own[rows, at].astype(np.uint64)
    found = mix(nodes[rows] * np.uint64(0x9E3779B97F4A7C15) + mix((values << np.uint64(8)) | at.astype(np.uint64)))
    return found & ~_RUN | nodes[rows] & _RUN, rows


def binomial(n: int, p: float) -> np.ndarray:
    """Chances of 0 to n equal coordinates among n."""
    return np.array([math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)])


def missed_by_run(threshold: float, depth: int, root_takes_two: bool) -> float:
    """Chance that a pair at the threshold shares no node at this depth of a run.

    Whether a root samples two coordinates is one draw for all sets.  A run's
    nodes share its coordinates: the chance is that of every number of equal
    ones, weighted; within one, nodes choose independently.
    """
    k = np.arange(RUN_COORDINATES + 1) / RUN_COORDINATES
    both = k * (k * RUN_COORDINATES - 1) / (RUN_COORDINATES - 1)
    q = np.ones(RUN_COORDINATES + 1)
    for level in range(depth):
        two = float(root_takes_two) if level == depth - 1 else 1 / threshold - 1
        q = (1 - two) * k * q + two * (both * (1 - (1 - q) ** 2) + 2 * (k - both) * q)
    return float(1 - binomial(RUN_COORDINATES, threshold) @ q)


def plan(threshold: float, recall: float, depths: int) -> tuple[int, int, float]:
    """The number of runs, the least number of equal coordinates of a candidate pair, and the recall that they give.

    A pair at the threshold that meets at the last depth only is missed by all
    runs, or has too few equal coordinates in every leaf; a tenth of what the
    recall allows goes to the second, and the sum of both bounds the pairs lost.
    """
    below = np.cumsum(binomial(COORDINATES, threshold))
    least = int(np.searchsorted(below, (1 - recall) / 10, side="right"))
    by_bits = float(below[least - 1]) if least else 0.0
    takes_two = chosen(roots(int(_RUN) + 1), threshold)[2]
    by_runs = np.cumprod([missed_by_run(threshold, depths, bool(t)) for t in takes_two])
    enough = np.flatnonzero(by_runs + by_bits <= 1 - recall)
    if not len(enough):
        raise ValueError(f"{len(by_runs)} runs do not reach a recall of {recall} at {threshold}")
    runs = int(enough[0]) + 1
    return runs, least, 1 - float(by_runs[runs - 1]) - by_bits


def whole_groups(batches: Iterator[pa.RecordBatch], n_keys: int, rows_at_once: int) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by their first ``n_keys`` columns."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n < rows_at_once:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = [table.column(i).to_numpy() for i in range(n_keys)]
        same = np.logical_and.reduce([k == k[-1] for k in keys])
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield table.slice(0, cut)
        held = [b for b in table.slice(cut).to_batches()]
        n = len(table) - cut
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


class Forest:
    """Union-find whose labels can be read for many members at once."""

    def __init__(self, n: int):
        self.labels = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        labels = self.labels
        while True:
            x, y = labels[a], labels[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = labels[labels]
                if (up == labels).all():
                    break
                labels[:] = up


def _candidate_stars(table: pa.Table, least: int) -> pa.RecordBatch:
    """For each leaf, the components of pairs with ``least`` equal coordinates: (member, least member)."""
    keys = [table.column(i).to_numpy() for i in range(3)]
    ids = table.column("set_id").to_numpy()
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, COORDINATES)
    new = np.zeros(len(ids), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    group = np.cumsum(new)
    last = np.append(np.flatnonzero(new), len(ids))[group]
    room = last - np.arange(len(ids)) - 1
    forest = Forest(len(ids))
    alive, k = np.flatnonzero(room > 0), 1
    while len(alive):
        for part in np.array_split(alive, max(1, len(alive) // 100_000)):
            a = part[forest.labels[part] != forest.labels[part + k]]
            a = a[(sketch[a] == sketch[a + k]).sum(axis=1) >= least]
            if len(a):
                forest.join(a, a + k)
        k += 1
        alive = alive[room[alive] >= k]
    least_id = ids.copy()
    np.minimum.at(least_id, forest.labels, ids)
    root = least_id[forest.labels]
    moved = ids != root
    return pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(root[moved])], names=["a", "b"])


def _exact_rows(table: pa.Table, threshold: float) -> pa.RecordBatch:
    """Links and a spanning forest of the links in each block pair: (set_id, links, least linked set, blocks)."""
    comp, left, right, block, ids, copies, blocks = (table.column(i).to_numpy() for i in range(7))
    sets = table.column(7)
    new = np.flatnonzero((comp[1:] != comp[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])) + 1
    out_id, out_links, out_other, out_blocks = [], [], [], []
    for start, end in zip(np.append(0, new), np.append(new, len(ids)), strict=True):
        _, at = np.unique(ids[start:end], return_index=True)
        at = at + start
        if len(at) < 2:
            continue
        own = [np.frombuffer(sets[int(i)].as_py(), np.uint64) for i in at]
        sizes = np.array([len(x) for x in own])
        tokens, column, df = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(own)), sizes)
        shared = df > 1
        place = np.cumsum(shared) - 1
        keep = shared[column]
        row, column = row[keep], place[column[keep]]
        n_columns = int(shared.sum())
        common = np.zeros((len(own), len(own)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for low in range(0, n_columns, 2048):
            a, b = np.searchsorted(column, [low, low + 2048])
            dense = np.zeros((len(own), min(2048, n_columns - low)), np.float32)
            dense[row[a:b], column[a:b] - low] = 1
            common += dense @ dense.T
        linked = np.empty(common.shape, bool)
        for low in range(0, len(own), 256):  # common / (a + b - common) >= threshold, a strip at a time
            strip = common[low : low + 256].astype(np.float64)
            linked[low : low + 256] = strip * (1 + threshold) >= threshold * (sizes[low : low + 256, None] + sizes[None, :]) - 1e-6
        np.fill_diagonal(linked, False)
        if left[start] != right[start]:
            linked &= block[at][:, None] != block[at][None, :]
        links = linked @ copies[at].astype(np.float64)
        a, b = np.nonzero(np.triu(linked))
        forest = Forest(len(own))
        forest.join(a, b)
        out_id.append(ids[at])
        out_links.append(links.astype(np.int64))
        out_other.append(ids[at][forest.labels])
        out_blocks.append(blocks[at])
    if not out_id:
        out_id, out_links, out_other, out_blocks = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_id, out_links, out_other, out_blocks)], names=["set_id", "links", "other", "blocks"])


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, label) of each vertex of ``edges`` (a, b): the least id of its component.

    Alternating small and large stars on edges from a vertex to a lesser one.
    Small: the lesser ends of a vertex, and it, go to the least of them.  Large:
    an edge goes on to the least end that its lesser vertex has.  By aggregation
    and joins alone, until every vertex has one edge, to one that has none.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    ends = Window.partitionBy("a")
    for _ in range(most_rounds):
        small = edges.withColumn("m", F.min("b").over(ends))
        small = checkpointed(small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct())
        least = small.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).withColumnRenamed("a", "u")
        large = checkpointed(spread_join(small, least.select(F.col("u").alias("b"), "m"), "b").select("a", "b", F.coalesce("m", "b").alias("to")))
        # Nothing went on, and no vertex has two ends: then each edge leads to a root.
        if not large.where("b <> to").take(1) and not least.where("n > 1").take(1):
            break
        edges = large.select("a", F.col("to").alias("b")).distinct()
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return large.select(F.col("a").alias("id"), F.col("b").alias("label")).union(large.select("b", "b")).distinct()


def row_key() -> Column:
    """A number for each row's doc_id and text: rows of equal keys are repetitions."""
    return F.xxhash64("doc_id", "text")


def classes(docs: DataFrame, threshold: float = 0.8, width: int = 5, recall: float = 0.9999, leaf: int = 512, block: int = 1024, block_shingles: int = 2_000_000, depths: int = 3) -> tuple[DataFrame, DataFrame, bool]:
    """All rows (key, doc_id, set_id, n, number), a row for each set with words, and whether rows repeat.

    Sets have set_id, label, copy_id, class_id, n_links, copies; ``label`` names the class.
    One row stands for each set, whatever the ids of its rows.
    """
    documents = docs.select(row_key().alias("key"), "doc_id", "text")
    runs, least, _ = plan(threshold, recall, depths)
    coordinates = max(COORDINATES, runs * RUN_COORDINATES)

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in text_slices(batch, "text"):
                hashes, owners = shingle_sets(data, offsets, width)
                ids, sizes = set_ids(hashes, owners, end - start)
                signature = np.zeros((end - start, coordinates), np.uint32)
                signature[sizes > 0] = signatures(hashes, sizes, coordinates)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), batch.column(1).slice(start, end - start), pa.array(ids), pa.array(sizes.astype(np.int64)), fixed_binary(signature)], names=["key", "doc_id", "set_id", "n", "signature"])

    rows = documents.mapInArrow(embed, "key long, doc_id long, set_id long, n long, signature binary")
    rows = checkpointed(rows.withColumn("number", F.monotonically_increasing_id()))
    sets = rows.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("copy_id"), F.min("number").alias("number"), F.min("key").alias("key"), F.count("*").alias("copies"), F.max("n").alias("n"))
    one = rows.where("n > 0").select("set_id", "number", "signature").join(sets.select("set_id", "number"), ["set_id", "number"]).select("set_id", "signature")
    repeated = bool(rows.where("n > 0").groupBy("key").count().where("count > 1").take(1))
    nodes_schema = "node long, set_id long, sketch binary"

    def first_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 20_000):
                part = batch.slice(start, 20_000)
                signature = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, coordinates)
                sketch = (signature[:, :COORDINATES] & np.uint32(0xFF)).astype(np.uint8)
                for k, root in enumerate(roots(runs)):
                    found, at = children(np.full(len(part), root), signature[:, k * RUN_COORDINATES : (k + 1) * RUN_COORDINATES], threshold)
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), part.column(0).take(pa.array(at)), fixed_binary(sketch[at])], names=["node", "set_id", "sketch"])

    def next_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 20_000):
                part = batch.slice(start, 20_000)
                own = np.frombuffer(b"".join(part.column(3).to_pylist()), np.uint32).reshape(-1, RUN_COORDINATES)
                found, at = children(part.column(0).to_numpy().view(np.uint64), own, threshold)
                rows_ = pa.array(at)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), part.column(1).take(rows_), part.column(2).take(rows_)], names=["node", "set_id", "sketch"])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3, 20_000):
            yield _candidate_stars(table, least)

    edges, at = None, checkpointed(one).mapInArrow(first_step, nodes_schema)
    # the coordinates of a node's run
    own_part = F.substring("signature", (F.col("node").bitwiseAND(int(_RUN)) * (4 * RUN_COORDINATES) + 1).cast("int"), F.lit(4 * RUN_COORDINATES))
    for depth in range(1, depths + 1):
        sizes = checkpointed(at.groupBy("node").agg(F.count("*").alias("size")).where("size > 1"))
        sized = spread_join(at, sizes, "node", sizes.withColumnRenamed("size", "n")).where("matched").drop("matched")
        ready = sized if depth == depths else sized.where(F.col("size") <= leaf)
        blocks = F.ceil(F.col("size") / block).cast("int")
        own = F.pmod(F.xxhash64("set_id", "node"), blocks).cast("int")
        ready = ready.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        ready = ready.select("node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "set_id", "sketch")
        found = checkpointed(ready.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j").mapInArrow(leaves, "a long, b long"))
        edges = found if edges is None else edges.union(found)
        if depth < depths:
            large = sized.where(F.col("size") > leaf).select("node", "set_id", "sketch").dropDuplicates(["node", "set_id"])
            again = checkpointed(large.join(one, "set_id").select("node", "set_id", "sketch", own_part.alias("own")))
            if not again.take(1):
                break
            at = again.mapInArrow(next_step, nodes_schema)

    grouped = checkpointed(components(edges))
    candidates = grouped.join(sets.withColumnRenamed("set_id", "id"), "id")
    candidates = checkpointed(candidates.select("key", "id", "label", "copies", "n"))
    totals = checkpointed(candidates.groupBy("label").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("n") / block_shingles)).cast("int").alias("blocks"), F.count("*").alias("n")))
    members = spread_join(candidates, totals.select("label", "blocks"), "label", totals).select("key", F.col("id").alias("set_id"), F.col("label").alias("comp"), "blocks", "copies")

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1).to_numpy()
            for start, end, data, offsets in text_slices(batch, "text"):
                hashes, owners = shingle_sets(data, offsets, width)
                ids, sizes = set_ids(hashes, owners, end - start)
                ends = np.cumsum(sizes)
                keep = np.flatnonzero(ids == wanted[start:end])  # another row may have the same key
                sets_ = [hashes[ends[i] - sizes[i] : ends[i]].tobytes() for i in keep]
                take = batch.slice(start, end - start).take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([take.column(1), take.column(2), take.column(3), take.column(4), pa.array(sets_, pa.binary())], names=["set_id", "comp", "blocks", "copies", "shingles"])

    texts = documents.join(members, "key").select("text", "set_id", "comp", "blocks", "copies")
    if repeated:
        texts = texts.dropDuplicates(["set_id", "text"])
    shingled = texts.mapInArrow(shingle, "set_id long, comp long, blocks int, copies long, shingles binary")
    own = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    dealt = shingled.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.col("own").alias("block"), "set_id", "copies", "blocks", "shingles")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3, 2_000):
            yield _exact_rows(table, threshold)

    checked = checkpointed(dealt.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j").mapInArrow(exact, "set_id long, links long, other long, blocks int"))
    # A group in one block has its classes; those of several blocks meet in components.
    several = checked.where("blocks > 1 and set_id <> other").select(F.col("set_id").alias("a"), F.col("other").alias("b"))
    labels = checked.where("blocks = 1").select("set_id", F.col("other").alias("label"))
    if several.take(1):
        labels = labels.union(components(several).select(F.col("id").alias("set_id"), "label"))
    none = F.lit(None).cast("long")
    parts = sets.select("set_id", "copy_id", "copies", none.alias("links"), none.alias("label"))
    parts = parts.union(checked.select("set_id", none, none, "links", none)).union(labels.select("set_id", none, none, none, "label"))
    facts = parts.groupBy("set_id").agg(F.max("copy_id").alias("copy_id"), (F.max("copies") - 1 + F.coalesce(F.sum("links"), F.lit(0))).alias("n_links"), F.min("label").alias("label"), F.max("copies").alias("copies"))
    facts = checkpointed(facts)
    named = facts.where("label is not null")
    firsts = checkpointed(named.groupBy("label").agg(F.min("copy_id").alias("class_id"), F.count("*").alias("n")))
    named = spread_join(named, firsts.select("label", "class_id"), "label", firsts).select("set_id", "label", "copy_id", "class_id", "n_links", "copies")
    facts = named.union(facts.where("label is null").select("set_id", F.col("set_id").alias("label"), "copy_id", F.col("copy_id").alias("class_id"), "n_links", "copies"))
    return rows.select("key", "doc_id", "set_id", "n", "number"), checkpointed(facts), repeated


def of_sets(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """The rows that have words with the facts of their sets, also where one set has most of the rows."""
    return spread_join(rows.where("n > 0").select("key", "doc_id", "set_id", "number"), facts.drop("copies"), "set_id", facts.select("set_id", F.col("copies").alias("n")))


def join(docs: DataFrame, threshold: float = 0.8, **how) -> DataFrame:
    """One row for each row of ``docs``: doc_id, class_id, copy_id, n_links.

    ``class_id`` is the least doc_id of the row's class, the component of links;
    ``copy_id`` the least doc_id with an equal set; ``n_links`` the number of
    other rows whose similarity is at least ``threshold``, copies included.
    Texts of fewer than ``width`` words, but not none, are one shingle.  Null
    texts and texts without words have no links and are classes of their own;
    rows with a null id are compared as any other, and a class of such rows
    alone has a null ``class_id``.  Ties go to the least id; texts of any length
    are read as a whole, an empty table gives no rows, extra columns are not
    read.  ``how`` are parameters of ``classes``.
    """
    rows, facts, _ = classes(docs, threshold, **how)
    with_words = of_sets(rows, facts).select("doc_id", "class_id", "copy_id", "n_links")
    without = rows.where("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"))
    return with_words.union(without)


def keep_one(documents: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row of each class: one with the least doc_id, nulls last, whatever other rows have that id.

    Of rows that repeat, doc_id and text alike, one stays.  Null texts and texts
    without words are classes of their own and all stay.
    """
    rows, facts, repeated = classes(documents, threshold)
    key = next(f"_key{i}" for i in range(len(documents.columns) + 1) if f"_key{i}" not in [c.lower() for c in documents.columns])
    placed = of_sets(rows, facts).withColumnRenamed("key", key)
    placed = checkpointed(placed.select(key, "label", F.expr("doc_id <=> class_id").alias("least")))
    first = checkpointed(placed.where("least").groupBy("label").agg(F.min(key).alias(key)).select(key))
    others = placed.select(key).join(first, key, "left_anti").distinct()
    keyed = documents.withColumn(key, row_key())
    if not repeated:
        return keyed.join(others, key, "left_anti").select([F.col(f"`{c}`") for c in documents.columns])
    again = checkpointed(placed.groupBy(key).count().where("count > 1").join(first, key, "left_semi").select(key))
    alone = keyed.join(others.union(again), key, "left_anti")
    return alone.union(keyed.join(again, key, "left_semi").dropDuplicates([key])).select([F.col(f"`{c}`") for c in documents.columns])
