"""Benchmark decontamination by a broadcast hash set of the items' word windows, with DataFrame expressions alone.

The set is a bitmap of the windows' hashes, two bits each, of at most
``MOST_SLOTS`` numbers whatever the size of the benchmark: one row that every
task gets.  Places of a document whose bits are set are candidates; they are
verified by a join with the windows themselves.  A benchmark that fills the
bitmap makes more candidates, and no other result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.tables import checkpointed, spread_join, written

WINDOW = 10
#: 64-bit numbers of the bitmap at most, 8 MB; a benchmark of up to as many windows has one for each.
MOST_SLOTS = 1 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, _NOT_WORD), "")


def windows_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, window, len): each item's windows, words joined by spaces; short items are one window."""
    words = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    width = F.least(F.size("words"), F.lit(WINDOW))
    at = F.sequence(F.lit(1), F.size("words") - width + 1)
    return words.select("item_id", width.alias("len"), F.explode(F.transform(at, lambda i: F.array_join(F.slice("words", i, width), " "))).alias("window")).distinct()


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hash_at(hashes: Column, at: Column, length: int) -> Column:
    """Hash of the ``length`` words from ``at`` on, by the words' own hashes."""
    return F.xxhash64(*[F.get(hashes, at + k) for k in range(length)])


def _probes(h: Column, slots: int) -> list[tuple[Column, Column]]:
    """The places, number and bit, of a hash in a bitmap."""
    return [(F.shiftrightunsigned(h, low + 6).bitwiseAND(F.lit(slots - 1)), F.shiftrightunsigned(h, low).bitwiseAND(F.lit(63)).cast("int")) for low in (0, 32)]


def bitmap(windows: DataFrame, slots: int) -> DataFrame:
    """One row: bits, an array of ``slots`` numbers, a power of two, in which each window's two bits are set."""
    hashes = windows.select(F.transform(F.split("window", " "), lambda w: F.xxhash64(w)).alias("w"), "len").distinct()
    whole = F.lit(None).cast("long")
    for n in range(1, WINDOW + 1):
        whole = F.when(F.col("len") == n, _hash_at(F.col("w"), F.lit(0), n)).otherwise(whole)
    places = F.array(*[F.struct(slot.alias("slot"), bit.alias("bit")) for slot, bit in _probes(F.col("h"), slots)])
    numbers = hashes.select(whole.alias("h")).select(F.explode(places).alias("p")).groupBy(F.col("p.slot").alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, p.bit)")).alias("bits"))
    every = windows.sparkSession.range(slots).withColumnRenamed("id", "slot").join(numbers, "slot", "left")
    return every.agg(F.transform(F.sort_array(F.collect_list(F.struct("slot", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))), lambda x: x["bits"]).alias("bits"))


def with_candidates(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``docs`` with scanned: n_words and hits, an array of (at, len, window) of all places whose window's bits are set."""
    lengths = windows.groupBy("len").agg(F.count("*").alias("n")).orderBy("len").collect()  # at most WINDOW rows
    slots = 1
    while slots < min(sum(r.n for r in lengths), MOST_SLOTS):
        slots *= 2
    bits = checkpointed(bitmap(windows, slots))

    def scan(x: Column) -> Column:
        """The words and their hashes are bound by lambdas, so that no rewrite of the plan evaluates them again for each window."""
        words, hashes, bits = x["words"], x["hashes"], x["bits"]

        def is_set(h: Column, bits: Column) -> Column:
            slots_set = [F.call_function("shiftright", F.get(bits, slot.cast("int")), bit).bitwiseAND(F.expr("1L")) == 1 for slot, bit in _probes(h, slots)]
            return slots_set[0] & slots_set[1]

        def of_length(n: int) -> Column:
            places = F.filter(F.sequence(F.lit(0), F.size(words) - n), lambda at: _bound(_hash_at(hashes, at, n), lambda h: is_set(h, bits)))
            places = F.when(F.size(words) >= n, places).otherwise(F.array().cast("array<int>"))
            return F.transform(places, lambda at: F.struct((at + 1).alias("at"), F.lit(n).alias("len"), F.array_join(F.slice(words, at + 1, F.lit(n)), " ").alias("window")))

        found = F.concat(*[of_length(r.len) for r in lengths])
        return F.struct(F.size(words).cast("long").alias("n_words"), found.alias("hits"))

    if not lengths:
        none = F.array().cast("array<struct<at:int,len:int,window:string>>")
        return docs.withColumn("scanned", F.struct(F.size(words_of(F.col("text"))).cast("long").alias("n_words"), none.alias("hits")))
    # The bitmap is a scalar subquery, which a task holds once, not a column, which each row would copy.
    hashed = _bound(words_of(F.col("text")), lambda w: F.struct(w.alias("words"), F.transform(w, lambda x: F.xxhash64(x)).alias("hashes"), F.col("_bits").alias("bits")))
    return docs.withColumn("_bits", bits.scalar()).withColumn("scanned", _bound(hashed, scan)).drop("_bits")


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document: words, hit words, items and whether it is contaminated.

    Null texts have no words; texts of any length are scanned as a whole.  Items
    whose text is null or has no word have no windows; items that repeat count
    once.  Repeated documents are reported each.  An empty benchmark hits
    nothing, an empty table gives no rows.  Extra columns are not read.
    """
    windows = checkpointed(windows_of(benchmark))
    found = with_candidates(documents.select("doc_id", "text"), windows).select("doc_id", "scanned.n_words", "scanned.hits")
    found = checkpointed(found.withColumn("row", F.monotonically_increasing_id()))
    zero = F.lit(0).cast("long")
    clean = found.where(F.size("hits") == 0).select("doc_id", "n_words", zero.alias("n_hit"), zero.alias("n_items"), F.sha2(F.lit(""), 256).alias("items_sha256"), F.lit(False).alias("contaminated"))
    placed = found.where(F.size("hits") > 0).select("row", "doc_id", "n_words", F.explode("hits").alias("hit")).select("row", "doc_id", "n_words", F.col("hit.at").cast("long").alias("at"), F.col("hit.len").cast("long").alias("len"), "hit.window")
    seen = spread_join(placed, windows.select("item_id", "window"), "window")
    # An item's id may be null; a candidate that is no window has no row of the windows.
    items = seen.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.sort_array(F.collect_set(F.when(F.col("matched"), F.struct("at", "len")))).alias("spans"),
        F.sort_array(F.collect_set(F.when(F.col("matched"), F.col("item_id").cast("string")))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(zero.alias("end"), zero.alias("n")),
        lambda a, x: F.struct(F.greatest(a["end"], x["at"] + x["len"]).alias("end"), (a["n"] + F.greatest(zero, x["at"] + x["len"] - F.greatest(a["end"], x["at"]))).alias("n")),
        lambda a: a["n"],
    )
    dirty = items.select("doc_id", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))
    return clean.union(dirty)


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any window of the benchmark.

    Nulls, repeated rows, empty tables and columns of any name as in ``report``;
    all columns pass through.  The texts are scanned once; only candidates meet
    the windows, by the numbers of their rows.
    """
    columns = documents.columns
    windows = checkpointed(windows_of(benchmark))
    held = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    scanned = with_candidates(documents.select(*held, F.col("text").alias("text")), windows).drop("text").select("*", F.transform("scanned.hits", lambda x: x["window"]).alias("windows")).drop("scanned")
    scanned = written(scanned.withColumn("row", F.monotonically_increasing_id()))
    suspects = scanned.where(F.size("windows") > 0)
    dirty = spread_join(suspects.select("row", F.explode(F.array_distinct("windows")).alias("window")), windows.select("window").distinct(), "window").where("matched").select("row").distinct()
    kept = scanned.where(F.size("windows") == 0).union(suspects.join(dirty, "row", "left_anti").select(scanned.columns))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])


ORACLE_SQL = r"""
WITH dw AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM documents
), bw AS (
  SELECT item_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM bw WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM win),
spots AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)
), hits AS (SELECT spots.doc_id, spots.n, spots.i, win.item_id FROM spots JOIN win USING (n, t)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS items_sha256 FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
