"""Quality rules whose cutoffs are certified on labelled documents, with DataFrame expressions alone."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.llm.tables import checkpointed

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
POSITION_BITS = 24
POOLED = "*"
#: Signals and their cutoffs from the loosest to the tightest; a document is rejected above a cutoff.
CUTOFFS = {
    "symbols_per_word": [4.0, 3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1],
    "repeated_share": [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1],
    "duplicate_lines_share": [0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1],
    "capitals_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1],
}


def _covered(positions: Column) -> Column:
    """Words that windows of three at these sorted positions cover."""
    start = F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(positions, start, lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3).cast("long"), x - a["last"])).alias("n")), lambda a: a["n"])


def _same_words(p: Column, q: Column) -> Column:
    return (F.get("words", p) == F.get("words", q)) & (F.get("words", p + 1) == F.get("words", q + 1)) & (F.get("words", p + 2) == F.get("words", q + 2))


def base(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """``keep`` and the exact base counts of each whole text.

    Windows of three words that repeat are neighbours after sorting longs of 40
    hash bits and the window's place.  Windows of equal bits are compared word
    by word; should any differ, or a text have more than 2**24 words, its
    windows are sorted as strings instead.
    """
    text = F.coalesce("text", F.lit(""))
    words = docs.select(*keep, text.alias("text"), F.array_remove(F.split(text, "[ \\t-\\r]+"), "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    words = words.withColumn("n_words", F.size("words").cast("long")).withColumn("lines", lines)
    place = (1 << POSITION_BITS) - 1
    windows = F.sequence(F.lit(0).cast("long"), F.col("n_words") - 3)
    fits = (F.col("n_words") >= 3) & (F.col("n_words") <= place)
    none = F.array().cast("array<bigint>")
    keyed = F.sort_array(F.transform(windows, lambda i: F.shiftleft(F.xxhash64(F.get("words", i.cast("int")), F.get("words", (i + 1).cast("int")), F.get("words", (i + 2).cast("int"))), POSITION_BITS).bitwiseOR(i)))
    counted = words.withColumn("sorted", F.when(fits, keyed).otherwise(none))

    def bits(x: Column) -> Column:
        return F.shiftright(x, POSITION_BITS)

    alike = F.filter("sorted", lambda x, i: F.coalesce(bits(x) == bits(F.get("sorted", i - 1)), F.lit(False)) | F.coalesce(bits(x) == bits(F.get("sorted", i + 1)), F.lit(False)))
    counted = counted.withColumn("alike", alike)

    def differs(x: Column, i: Column) -> Column:
        before = F.get("alike", i - 1)
        return (i > 0) & (bits(x) == bits(before)) & ~_same_words(x.bitwiseAND(F.lit(place)).cast("int"), before.bitwiseAND(F.lit(place)).cast("int"))

    clash = (F.col("n_words") > place) | (F.size(F.filter("alike", differs)) > 0)
    spelled = F.sort_array(F.transform(windows, lambda i: F.struct(F.concat_ws(" ", F.slice("words", (i + 1).cast("int"), 3)).alias("w"), i.alias("p"))))
    twice = F.get(F.transform(F.array(spelled), lambda s: F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["w"] == x["w"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["w"] == x["w"], F.lit(False)))), F.lit(0))
    exact = F.transform(twice, lambda x: x["p"])
    repeated = F.when(clash, _covered(F.sort_array(exact))).otherwise(_covered(F.sort_array(F.transform("alike", lambda x: x.bitwiseAND(F.lit(place))))))
    letters = F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", ""))
    capitals = F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    chars = F.length("text")
    return counted.select(
        *keep,
        "n_words",
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (chars - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (chars - letters).cast("long").alias("n_letters"),
        (chars - capitals).cast("long").alias("n_capitals"),
    )


def with_signals(counts: DataFrame) -> DataFrame:
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))

    return counts.withColumns(
        {
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
            "symbols_per_word": share("n_symbols", "n_words"),
            "repeated_share": share("n_repeat_words", "n_words"),
            "duplicate_lines_share": share("n_dup_lines", "n_lines"),
            "capitals_share": share("n_capitals", "n_letters"),
        }
    )


def _log_factorial(x: Column) -> Column:
    """Stirling's series at ``x`` + 10, and the ten factors between."""
    y = x.cast("double") + 10
    series = y * F.log(y) - y + 0.5 * F.log(2 * math.pi * y) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    between = F.lit(0.0)
    for j in range(1, 11):
        between = between + F.log(x + j)
    return series - between


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X of n draws at p, where k is under n p; 1 from there on.

    The terms fall from k on downwards.  Those of nine standard deviations and
    50 more are summed: what is left is under the precision of a double.
    """
    log_last = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p)
    terms = F.least(k.cast("long"), F.ceil(9 * F.sqrt(n * p * (1 - p))).cast("long") + 50)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(a: Column, j: Column) -> Column:
        i = (k - j + 1).cast("double")
        term = a["term"] * i * (1 - p) / ((n - i + 1) * p)
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))

    total = F.aggregate(F.when(terms >= 1, F.sequence(F.lit(1).cast("long"), terms)).otherwise(F.array().cast("array<bigint>")), start, step, lambda a: a["sum"])
    return F.when(n == 0, 1.0).when(k >= n * p, 1.0).otherwise(F.exp(log_last) * total)


def certify(signals: DataFrame, labels: DataFrame, risk: float = 0.08, delta: float = 0.1, most_strata: int = 64, least_rows: int = 100, power: float = 0.995) -> DataFrame:
    """(stratum, one cutoff for each signal or null): in each stratum, with probability 1 - ``delta``
    for all strata and signals together, at most ``risk`` of the good documents that the base
    rules pass are rejected.

    Strata are the ``most_strata`` languages with the most good labelled rows, at least
    ``least_rows`` each, and ``*`` for all others.  Each signal has an equal share of the
    risk.  Its cutoffs are tested from the loosest on, each by the exact binomial tail of its
    rejections at Bonferroni's level over strata and signals, and the first that fails ends
    the sequence, so that the order needs no further correction.  Of the certified cutoffs
    the loosest counts that rejects nearly as many bad documents, ``power`` of them, as the
    tightest does: what is certified is no reason to reject what need not be rejected.
    """
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    # A labelled id counts once, however often its row repeats.
    used = ["lang", *CUTOFFS]
    seen = signals.where(~F.col("base_failed")).join(known, "doc_id").groupBy("doc_id", "quality").agg(F.min(F.struct(*used)).alias("row")).select("quality", "row.*")
    good, bad = F.col("quality") == 1, F.col("quality") == 0
    sums = [F.count_if(g & (F.col(s) > c)).alias(f"{s}_{i}{b}") for s, cutoffs in CUTOFFS.items() for i, c in enumerate(cutoffs) for g, b in ((good, ""), (bad, "_bad"))]
    by_language = checkpointed(seen.groupBy("lang").agg(F.count_if(good).alias("n"), *sums))
    ranked = by_language.where(F.col("lang").isNotNull() & (F.col("n") >= least_rows)).orderBy(F.desc("n"), "lang").limit(most_strata)
    named = by_language.join(F.broadcast(ranked.select("lang", F.lit(True).alias("own"))), "lang", "left")
    totals = [F.sum(c).alias(c) for c in by_language.columns if c != "lang"]
    strata = named.groupBy(F.when(F.col("own"), F.col("lang")).otherwise(POOLED).alias("stratum")).agg(*totals)
    tests = F.array(*[F.struct(F.lit(s).alias("signal"), F.lit(i).alias("i"), F.lit(c).alias("cutoff"), F.col(f"{s}_{i}").alias("k"), F.col(f"{s}_{i}_bad").alias("caught")) for s, cutoffs in CUTOFFS.items() for i, c in enumerate(cutoffs)])
    level = delta / (len(CUTOFFS) * F.count("*").over(Window.partitionBy(F.lit(0))))  # of most_strata + 1 rows at most
    rows = strata.withColumn("level", level).select("stratum", "n", "level", F.explode(tests).alias("t")).select("stratum", "n", "level", "t.*")
    rows = rows.withColumn("fails", binomial_tail(F.col("k"), F.col("n"), risk / len(CUTOFFS)) > F.col("level"))
    loosest_first = Window.partitionBy("stratum", "signal").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    certified = rows.withColumn("failed", F.max("fails").over(loosest_first)).where(~F.col("failed"))
    most = F.max("caught").over(Window.partitionBy("stratum", "signal"))
    certified = certified.withColumn("most", most).where(F.col("caught") >= power * F.col("most"))
    return certified.groupBy("stratum").agg(*[F.max(F.when(F.col("signal") == s, F.col("cutoff"))).alias(f"cut_{s}") for s in CUTOFFS])


def judge(documents: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """Base counts and verdict of every row: kept unless the base rules or a certified cutoff reject it.

    Null and empty texts have no words and fail the base rules; texts of any
    length are counted as a whole; a value equal to a cutoff is not above it.  A
    row without a language is in the pooled stratum.  Without labels nothing is
    certified and the base rules decide alone.  Repeated rows are judged each,
    labels and labelled rows that repeat count once, an empty table gives no
    rows, and extra columns are not read.
    """
    signals = checkpointed(with_signals(base(documents)))
    cutoffs = certify(signals, labels, **how)
    # At most most_strata + 1 rows, by construction.
    cutoffs = checkpointed(cutoffs)
    own = cutoffs.where(F.col("stratum") != POOLED).withColumnRenamed("stratum", "lang")
    pooled = cutoffs.where(F.col("stratum") == POOLED).select(*[F.col(f"cut_{s}").alias(f"rest_{s}") for s in CUTOFFS])
    found = signals.join(F.broadcast(own.withColumn("is_own", F.lit(True))), "lang", "left")
    found = found.join(F.broadcast(pooled.withColumn("at", F.lit(1))), F.lit(1) == F.col("at"), "left")
    above = F.lit(False)
    for s in CUTOFFS:
        cutoff = F.when(F.col("is_own"), F.col(f"cut_{s}")).otherwise(F.col(f"rest_{s}"))
        above = above | F.coalesce(F.col(s) > cutoff, F.lit(False))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~above).alias("kept"))
