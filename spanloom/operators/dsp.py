"""Filters over columns of signals: one row is one channel's samples.

Rows of a batch that are equally long are handled as one matrix. No rows meet, so nothing is
shuffled; recordings are cut to rows per channel and file before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions import filters


def map_signals(df: DataFrame, column: str, f: Callable[[np.ndarray], np.ndarray], least: int = 1) -> DataFrame:
    """df with f applied to the signals of column, given as matrices of equally long rows.

    Signals that are null, shorter than least, or hold a null or a value that is not finite
    stay as they are. The column becomes array<double>.
    """
    schema = ", ".join(f"`{x.name}` {'array<double>' if x.name == column else x.dataType.simpleString()}" for x in df.schema)
    names = df.columns
    at = names.index(column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = batch[at].cast(pa.list_(pa.float64()))
            length = pc.fill_null(pc.list_value_length(arrays), -1).to_numpy()
            flat = arrays.flatten()
            value = flat.to_numpy(zero_copy_only=False)
            edge = np.concatenate(([0], np.cumsum(np.maximum(length, 0))))
            spoiled = np.concatenate(([0], np.cumsum(~np.isfinite(value))))
            whole = (spoiled[edge[1:]] == spoiled[edge[:-1]]) & (length >= least)
            out: list = arrays.to_pylist() if not whole.all() else [None] * len(length)
            for n in np.unique(length[whole]):
                rows = np.flatnonzero(whole & (length == n))
                x = value[edge[rows][:, None] + np.arange(n)]
                for i, y in zip(rows.tolist(), f(x), strict=True):
                    out[i] = y
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(work, schema)


def mended(df: DataFrame, column: str, least: int = 1) -> DataFrame:
    """df with missing readings of the signals interpolated, and why a signal isn't as given.

    Readings that are null or not finite lie on the line between the nearest others, the ends
    held: reason interpolated. Signals are null without any reading (no_reading), or where they
    are shorter than least (too_short). reason is null else. The column becomes array<double>.
    """
    schema = ", ".join(f"`{x.name}` {'array<double>' if x.name == column else x.dataType.simpleString()}" for x in df.schema) + ", reason string"
    names = df.columns
    at = names.index(column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = batch[at].cast(pa.list_(pa.float64()))
            length = pc.fill_null(pc.list_value_length(arrays), 0).to_numpy()
            value = arrays.flatten().to_numpy(zero_copy_only=False).copy()
            edge = np.concatenate(([0], np.cumsum(length)))
            good = np.isfinite(value)
            known = np.concatenate(([0], np.cumsum(good)))
            known = known[edge[1:]] - known[edge[:-1]]
            reason = np.where(known == 0, "no_reading", np.where(length < least, "too_short", np.where(known < length, "interpolated", None)))
            for i in np.flatnonzero(reason == "interpolated").tolist():
                x, ok = value[edge[i] : edge[i + 1]], good[edge[i] : edge[i + 1]]
                x[~ok] = np.interp(np.flatnonzero(~ok), np.flatnonzero(ok), x[ok])
            gone = (reason == "no_reading") | (reason == "too_short")
            edge = np.concatenate(([0], np.cumsum(np.where(gone, 0, length)))).astype(np.int32)
            value = pa.array(value[np.repeat(~gone, length)])
            columns = list(batch.columns)
            columns[at] = pa.ListArray.from_arrays(pa.array(edge), value, mask=pa.array(gone))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(reason.tolist(), pa.string())], names=[*names, "reason"])

    return df.mapInArrow(work, schema)


def bandpass(df: DataFrame, column: str, rate: float, low: float = 0.5, high: float = 40.0, order: int = 4) -> DataFrame:
    filters.butterworth(order, (low, high), "band", rate)  # checks the cutoffs
    return map_signals(df, column, lambda x: filters.bandpass(x, rate, low, high, order), 2)


def filter_interval(df: DataFrame, column: str, rate: float, begin: float, end: float, kind: str, cutoff: float | tuple[float, float], order: int = 4) -> DataFrame:
    """Only [begin, end) seconds of the signals filtered; kind is low, high or band. Choose channels by a filter on df."""
    filters.butterworth(order, cutoff, kind, rate)
    return map_signals(df, column, lambda x: filters.filter_within(x, rate, begin, end, kind, cutoff, order), max(2, round(begin * rate) + 1))


def notch(df: DataFrame, column: str, rate: float, freqs: list[float], width: float = 2.0) -> DataFrame:
    return map_signals(df, column, lambda x: filters.notch(x, rate, freqs, width), 16) if freqs else df


def resample(df: DataFrame, column: str, native: float, target: float, method: str = "fft") -> DataFrame:
    if native <= 0 or target <= 0:
        raise ValueError("rates must be positive")
    work = {"fft": filters.resample_fft, "poly": filters.resample_poly}[method]
    return map_signals(df, column, lambda x: work(x, native, target))


def psd(df: DataFrame, keys: list[str], column: str, rate: float, seconds: float = 4.0, most: float = 60.0) -> DataFrame:
    """(keys, reason, freq, psd): Welch densities up to most Hz of each row's signal; windows of seconds, or the whole.

    Missing readings are interpolated; a signal without readings or of less than 8 has one row
    with null freq and psd, and its reason.
    """
    size = int(seconds * rate)
    whole = mended(df.select(*keys, column), column, 8)
    with_n = whole.select(*keys, "reason", F.least(F.size(column), F.lit(size)).alias("_n"), column)
    densities = map_signals(with_n, column, lambda x: filters.welch(x, rate, size)[1], 8)
    out = densities.select(*keys, "reason", "_n", F.posexplode_outer(column).alias("k", "psd")).withColumn("freq", F.col("k") * F.lit(float(rate)) / F.col("_n"))
    return out.where((F.col("freq") <= most) | F.col("freq").isNull()).select(*keys, "reason", "freq", "psd")


def noise_profile(densities: DataFrame, group: list[str], channel: list[str]) -> DataFrame:
    """(group, freq, mean_power, cv) over channels, of densities that sum to 1 within each channel."""
    whole = F.sum("psd").over(Window.partitionBy(*group, *channel))
    share = densities.withColumn("share", F.col("psd") / (whole + F.lit(1e-10)))
    return share.groupBy(*group, "freq").agg(F.avg("share").alias("mean_power"), (F.stddev_pop("share") / F.avg("share")).alias("cv"))


def group_frequencies(sorted_freqs: Column, reach: float = 2.0) -> Column:
    """Means of frequencies grouped from a sorted array: a group holds what lies less than reach above its first."""
    start = F.struct(F.lit(None).cast("double").alias("anchor"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"), F.array().cast("array<double>").alias("out"))

    def step(s: Column, f: Column) -> Column:
        f = f.cast("double")
        same = s["anchor"].isNotNull() & (f - s["anchor"] < reach)
        closed = F.when(s["n"] > 0, F.concat(s["out"], F.array(s["sum"] / s["n"]))).otherwise(s["out"])
        return F.struct(F.when(same, s["anchor"]).otherwise(f).alias("anchor"), F.when(same, s["sum"] + f).otherwise(f).alias("sum"), F.when(same, s["n"] + 1).otherwise(F.lit(1)).alias("n"), F.when(same, s["out"]).otherwise(closed).alias("out"))

    return F.aggregate(sorted_freqs, start, step, lambda s: F.when(s["n"] > 0, F.concat(s["out"], F.array(s["sum"] / s["n"]))).otherwise(s["out"]))


def noise_frequencies(densities: DataFrame, group: list[str], channel: list[str], variance: float = 0.20, percentile: float = 80.0, above: float = 4.0) -> DataFrame:
    """(group, freqs): frequencies above the power percentile that vary little over channels, close ones merged."""
    profile = noise_profile(densities.where("freq is not null"), group, channel)
    line = F.percentile("mean_power", F.lit(percentile / 100)).over(Window.partitionBy(*group))
    loud = profile.withColumn("line", line).where((F.col("mean_power") > F.col("line")) & (F.col("cv") < variance) & (F.col("freq") > above))
    return loud.groupBy(*group).agg(group_frequencies(F.array_sort(F.collect_list("freq"))).alias("freqs"))
