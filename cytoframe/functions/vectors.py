"""Expressions over arrays of numbers: profiles, curves and vectors stay in the JVM.

Arrays have no nulls; an empty array gives null.  Indices of lambdas start at 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-10


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def mean(a: Column) -> Column:
    return F.try_divide(total(a), F.size(a))


def variance(a: Column) -> Column:
    return bound(mean(a), lambda m: F.try_divide(F.aggregate(a, F.lit(0.0), lambda s, x: s + (x - m) * (x - m)), F.size(a)))


def stddev(a: Column) -> Column:
    return F.sqrt(variance(a))


def bound(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def places(a: Column) -> Column:
    """0 to size - 1, empty for an empty array."""
    return F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1)).otherwise(F.array().cast("array<int>"))


def gradient(a: Column) -> Column:
    """Central differences inside, one-sided ones at both ends; at least two values."""
    n = F.size(a)

    def at(i: Column) -> Column:
        low, high = F.greatest(i - 1, F.lit(0)), F.least(i + 1, n - 1)
        return (F.get(a, high) - F.get(a, low)) / (high - low)

    return F.transform(places(a), at)


def resample(a: Column, n: int | Column) -> Column:
    """Linear interpolation at ``n`` places from the first to the last value, ends included."""
    n = F.lit(n) if isinstance(n, int) else n
    last = F.size(a) - 1

    def at(i: Column) -> Column:
        position = F.when(n > 1, i * last.cast("double") / F.greatest(n - 1, F.lit(1))).otherwise(F.lit(0.0))
        low = F.least(F.floor(position).cast("int"), last)
        high = F.least(low + 1, last)
        return F.get(a, low) + (F.get(a, high) - F.get(a, low)) * (position - low)

    return F.when((n > 0) & (F.size(a) > 0), F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), at)).otherwise(F.array().cast("array<double>"))


def interpolate(x: Column, xs: Column, ys: Column) -> Column:
    """Piecewise-linear value at ``x`` of the curve through (xs, ys), xs ascending; constant outside."""
    after = F.size(F.filter(xs, lambda v: v <= x))
    low, high = F.greatest(after - 1, F.lit(0)), F.least(after, F.size(xs) - 1)
    span = F.get(xs, high) - F.get(xs, low)
    return F.get(ys, low) + F.coalesce(F.try_divide((x - F.get(xs, low)) * (F.get(ys, high) - F.get(ys, low)), span), F.lit(0.0)) * (after > 0).cast("int")


def moving_average(a: Column, window: int) -> Column:
    """Zero-padded average over a centred window, as long as the array."""
    before = (window - 1) - (window - 1) // 2

    def at(i: Column) -> Column:
        low, high = i - before, i - before + window - 1
        first = F.greatest(low, F.lit(0))
        return total(F.slice(a, first + 1, F.greatest(F.least(high, F.size(a) - 1) - first + 1, F.lit(0)))) / window

    return F.transform(places(a), at)


def should_flip(a: Column) -> Column:
    """Whether the first half, rounded half to even, is dimmer than the whole."""
    half = F.bround(F.size(a) / 2, 0).cast("int")
    return mean(F.slice(a, 1, half)) < mean(a)


def reorient(a: Column) -> Column:
    """(profile, flipped): the brighter half first."""
    return bound(should_flip(a), lambda f: F.struct(F.when(f, F.reverse(a)).otherwise(a).alias("profile"), f.alias("flipped")))


def demograph_row(profile: Column, length: Column, n: int = 256, longest: float = 8.0, align: str = "center", orient: bool = True, uniform: bool = False, skip_end: int = 0, smooth: int = 0) -> Column:
    """(row, flipped): a profile scaled to its length within ``n`` places, padded with zeros."""
    a = moving_average(profile, smooth) if smooth > 0 and smooth % 2 else profile
    if skip_end:
        a = F.slice(a, skip_end + 1, F.size(a) - 2 * skip_end)
    flipped = should_flip(a) if orient else F.lit(False)

    def row(turned: Column) -> Column:
        if uniform:
            return resample(turned, n)
        half = F.floor(0.5 * n * F.least(F.lit(1.0), length / longest)).cast("int")
        pad = int(n * 0.5) - half
        zeros = lambda k: F.array_repeat(F.lit(0.0), k)
        before, after = {"center": (pad, pad), "left": (F.lit(0), 2 * pad), "right": (2 * pad, F.lit(0))}[align]
        return F.concat(zeros(before), resample(turned, 2 * half), zeros(after))

    return bound(flipped, lambda f: F.struct(bound(F.when(f, F.reverse(a)).otherwise(a), row).alias("row"), f.alias("flipped")))


def profile_summary(p: Column) -> Column:
    """Mean, maximum, absolute differences and place of the peak; null under three values."""
    steps = F.zip_with(F.slice(p, 2, F.size(p) - 1), F.slice(p, 1, F.size(p) - 1), lambda b, a: F.abs(b - a))
    peak = F.array_max(p)
    out = bound(
        steps,
        lambda d: F.struct(
            mean(p).alias("midline_mean"), peak.alias("midline_max"), mean(d).alias("midline_gradient_mean"), F.array_max(d).alias("midline_gradient_max"),
            ((F.array_position(p, peak) - 1) / (F.size(p) - 1)).alias("midline_peak_position"), peak.alias("midline_peak_value"),
        ),
    )
    return F.when(F.size(p) >= 3, out)


def profile_features(p: Column) -> Column:
    """Shape features of a profile along a cell; null under three values."""
    half = F.floor(F.size(p) / 2).cast("int")
    first, second = mean(F.slice(p, 1, half)), mean(F.slice(p, half + 1, F.size(p) - half))
    out = bound(
        F.transform(gradient(p), F.abs),
        lambda g: F.struct(
            mean(p).alias("mean"), stddev(p).alias("std"), F.array_min(p).alias("min"), F.array_max(p).alias("max"), (F.array_max(p) - F.array_min(p)).alias("range"),
            mean(g).alias("gradient_mean"), F.array_max(g).alias("gradient_max"), (first / (second + EPS)).alias("polar_ratio"), (first - second).alias("polar_diff"),
            ((F.array_position(p, F.array_max(p)) - 1) / F.size(p)).alias("peak_position"), F.array_max(p).alias("peak_value"),
        ),
    )
    return F.when(F.size(p) >= 3, out)


def pole_features(p: Column, pole: float = 0.10, centre: tuple[float, float] = (0.45, 0.55)) -> Column:
    """Means of both poles and of the centre, their asymmetry and enrichment, and peaks; null under ten values."""
    n = F.size(p)
    end = F.greatest(F.lit(1), F.bround(n * pole, 0).cast("int"))
    low, high = F.bround(n * centre[0], 0).cast("int"), F.bround(n * centre[1], 0).cast("int")
    means = F.struct(mean(F.slice(p, 1, end)).alias("a"), mean(F.slice(p, n - end + 1, end)).alias("b"), mean(F.slice(p, low + 1, high - low)).alias("c"))
    out = bound(
        means,
        lambda m: F.struct(
            m["a"].alias("poleA"), m["b"].alias("poleB"), m["c"].alias("center"),
            (F.abs(m["a"] - m["b"]) / (m["a"] + m["b"] + EPS)).alias("polar_asym"), (m["c"] / (0.5 * (m["a"] + m["b"]) + EPS)).alias("center_enrichment"),
        ),
    )
    return F.when(n >= 10, out)


def pole_state(asymmetry: Column, enrichment: Column, asym: float = 0.3, centre: float = 1.5) -> Column:
    """3 septal, 1 one pole, 2 two poles, -1 unknown."""
    unknown = asymmetry.isNull() | F.isnan(asymmetry) | enrichment.isNull() | F.isnan(enrichment)
    return F.when(unknown, -1).when(enrichment >= centre, 3).when(asymmetry >= asym, 1).otherwise(2)


def min_max(a: Column) -> Column:
    return bound(F.struct(F.array_min(a).alias("l"), F.array_max(a).alias("h")), lambda b: F.transform(a, lambda x: F.try_divide(x - b["l"], b["h"] - b["l"])))


def zscore(a: Column) -> Column:
    return bound(F.struct(mean(a).alias("m"), stddev(a).alias("s")), lambda b: F.transform(a, lambda x: F.try_divide(x - b["m"], b["s"])))


def percentile(a: Column, p: float) -> Column:
    """Linear interpolation between the closest ranks."""

    def at(s: Column) -> Column:
        position = (F.size(s) - 1) * (p / 100.0)
        low = F.floor(position).cast("int")
        high = F.least(low + 1, F.size(s) - 1)
        return F.get(s, low) + (F.get(s, high) - F.get(s, low)) * (position - low)

    return bound(F.array_sort(a), at)


def clamp(x: Column, low, high) -> Column:
    low, high = (F.lit(v) if not isinstance(v, Column) else v for v in (low, high))
    return F.greatest(low, F.least(x, high))


def percentile_normalize(a: Column, low: float = 0.1, high: float = 99.9, at_most_low: float | None = None, at_least_high: float | None = None) -> Column:
    """Stretch between two percentiles to 0..1; given bounds hold the limits apart."""
    l, h = percentile(a, low), percentile(a, high)  # noqa: E741
    l = l if at_most_low is None else F.least(l, F.lit(at_most_low))  # noqa: E741
    h = h if at_least_high is None else F.greatest(h, F.lit(at_least_high))
    return bound(F.struct(l.alias("l"), h.alias("h")), lambda b: F.transform(a, lambda x: clamp(F.coalesce(F.try_divide(x - b["l"], b["h"] - b["l"]), F.lit(0.0)), 0.0, 1.0)))


def invert_normalize(a: Column, top: float = 99.0) -> Column:
    """The distance below a high percentile, from 0 to 1."""
    inverted = bound(percentile(a, top), lambda t: F.transform(a, lambda x: F.greatest(t - x, F.lit(0.0))))
    return bound(inverted, lambda v: F.transform(v, lambda x: F.coalesce(F.try_divide(x, F.array_max(v)), F.lit(0.0))))


def adjust_gamma(a: Column, gamma: float = 1.0, levels: float = 65535.0) -> Column:
    return F.transform(min_max(a), lambda x: F.floor(F.pow(F.coalesce(x, F.lit(0.0)), F.lit(gamma)) * levels))


def normalize_to_background(a: Column, mask: Column, low: float = 0.5, high: float = 99.5, background: float = 0.3) -> Column:
    """Percentile stretch, then the gamma that brings the mean outside ``mask`` to ``background``."""
    return bound(
        percentile_normalize(a, low, high),
        lambda v: bound(mean(F.filter(v, lambda x, i: F.get(mask, i) == 0)), lambda m: F.transform(v, lambda x: F.when((m > 0) & (m < 1), F.pow(x, F.lit(math.log(background)) / F.log(m))).otherwise(x))),
    )


def norm_ratio(a: Column, b: Column) -> Column:
    return F.try_divide(F.least(a, b), F.greatest(a, b))


def distance_probability(x: Column, d: float = 1.0, t: float = 1.0, a: float = 1.0) -> Column:
    return F.exp(-F.pow(a * x, 2) / (4 * d * t)) / math.sqrt(4 * math.pi * d * t)


def difference(a: Column, b: Column) -> Column:
    """1 less the mean relative difference of two vectors, 0 at least."""
    parts = F.zip_with(a, b, lambda x, y: F.coalesce(F.try_divide(F.abs(x - y), (x + y) / 2), F.lit(0.0)))
    return F.greatest(F.lit(0.0), 1 - mean(parts))


def correlation(a: Column, b: Column) -> Column:
    """Pearson's correlation of two vectors."""

    def of(m: Column) -> Column:
        xy = F.aggregate(F.zip_with(a, b, lambda x, y: (x - m["a"]) * (y - m["b"])), F.lit(0.0), lambda s, v: s + v)
        xx = F.aggregate(a, F.lit(0.0), lambda s, x: s + F.pow(x - m["a"], 2))
        yy = F.aggregate(b, F.lit(0.0), lambda s, x: s + F.pow(x - m["b"], 2))
        return F.try_divide(xy, F.sqrt(xx * yy))

    return bound(F.struct(mean(a).alias("a"), mean(b).alias("b")), of)


def find_turn_point(a: Column, half: int = 2) -> Column:
    """The first place where the mean after it exceeds the mean before it by exactly one; null if none."""
    step = F.transform(places(a), lambda i: F.when((i >= half) & (i <= F.size(a) - half), mean(F.slice(a, i + 1, half)) - mean(F.slice(a, i - half + 1, half))))
    hits = F.filter(F.transform(step, lambda v, i: F.when(v == 1.0, i)), lambda v: v.isNotNull())
    return F.get(hits, F.lit(0))


def log_hu(h: Column) -> Column:
    return F.coalesce(F.nullif(F.nanvl(F.signum(h) * F.log10(F.nullif(F.abs(h), F.lit(0.0))), F.lit(0.0)), F.lit(float("inf"))), F.lit(0.0))


def parabola_offset(q1: Column, q2: Column, q3: Column) -> Column:
    """Where the parabola through three equal steps has its vertex, from the middle one."""
    return F.coalesce(F.try_divide(0.5 * (q1 - q3), q1 - 2 * q2 + q3), F.lit(0.0))
