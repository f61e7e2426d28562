"""Column expressions over sample numbers and arrays of samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rescaled_index(index: Column, native: float, target: float) -> Column:
    """A sample's number at another rate, halves to even."""
    if native <= 0 or target <= 0:
        raise ValueError("rates must be positive")
    return F.bround(index * F.lit(target / native)).cast("long")


def time_to_sample(seconds: Column, first: Column, last: Column, rate: float) -> Column:
    """Sample of a time within a file that spans first to last, clamped to it."""
    at = first + F.bround(seconds * F.lit(float(rate))).cast("long")
    return F.least(F.greatest(at, first), last)


def pieces(array: Column, size: Column | int, step: Column | int) -> Column:
    """Slices of size every step; none that is cut short."""
    size, step = (F.lit(x) if isinstance(x, int) else x for x in (size, step))
    count = F.floor((F.size(array) - size) / step).cast("int")
    starts = F.sequence(F.lit(0), count)
    cut = F.transform(starts, lambda i: F.slice(array, i * step + 1, size))
    return F.when(F.size(array) >= size, cut).otherwise(F.array().cast("array<array<double>>"))


def argmax(array: Column) -> Column:
    """Place, from 0, of the first greatest value."""
    return F.array_position(array, F.array_max(array)).cast("int") - 1


def interpolated(values: Column, mask: Column) -> Column:
    """Masked samples on the line between the nearest clean ones; the ends held; unchanged where none is clean.

    values and mask are arrays of one length; a null in the mask counts as clean.
    """
    n = F.size(values)
    clean = lambda m: ~F.coalesce(m, F.lit(False))
    # for each sample the nearest clean place at or before, and at or after
    places = F.transform(mask, lambda m, i: F.when(clean(m), i))
    run = lambda xs: F.aggregate(xs, F.struct(F.lit(None).cast("int").alias("last"), F.array().cast("array<int>").alias("out")), lambda s, x: F.struct(F.coalesce(x, s["last"]).alias("last"), F.concat(s["out"], F.array(F.coalesce(x, s["last"]))).alias("out")))["out"]
    before = run(places)
    after = F.reverse(run(F.reverse(places)))
    at = lambda i: F.try_element_at(values, i + 1)

    def value(p: Column, i: Column) -> Column:
        a, b = p["before"], p["after"]
        line = at(a) + (at(b) - at(a)) * (i - a) / (b - a)
        return F.when(a.isNull() & b.isNull(), at(i)).when(a.isNull(), at(b)).when(b.isNull() | (a == b), at(a)).otherwise(line)

    pairs = F.arrays_zip(before.alias("before"), after.alias("after"))
    return F.when(n > 0, F.transform(pairs, value)).otherwise(values)
