"""Operators over signals kept as arrays: pieces, epochs, montages, artifact masks and their repair.

A signal table has one row per channel and stretch: keys, channel, samples ARRAY. Channels are
always addressed by name.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.functions import samples
from spanloom.operators.intervals import overlapping

#: Seconds of the blocks in which segments and signals meet.
MEETING_SECONDS = 60.0


def segment_fixed(df: DataFrame, column: str, size: int, step: int | None = None) -> DataFrame:
    """A row for each piece of size samples every step, with segment and seg_start_sample; short signals go."""
    if size <= 0 or step is not None and step <= 0:
        raise ValueError("size and step must be positive")
    step = step or size
    others = [c for c in df.columns if c != column]
    cut = samples.pieces(F.col(column), size, step)
    return df.select(*others, F.posexplode(cut).alias("_k", "segment")).withColumn("seg_start_sample", (F.col("_k") * step).cast("long")).drop("_k")


def adaptive_step(preictal: Column, interictal: Column, size: int) -> Column:
    """Step in samples at which preictal signals give about as many pieces as interictal ones; null without preictal ones."""
    ratio = interictal / preictal
    return F.when(preictal > 0, F.when(ratio <= 0, F.lit(size)).otherwise(F.least(F.greatest((F.lit(size) / ratio).cast("int"), F.lit(1)), F.lit(size))))


def segment_adaptive(df: DataFrame, column: str, size: int, interictal_samples: int, label: str = "label") -> DataFrame:
    """Preictal signals cut at the adaptive step, others end to end."""
    pre = df.where(F.col(label).startswith("p")).agg(F.sum(F.size(column))).first()[0] or 0
    if pre <= 0:
        raise ValueError("no preictal samples")
    step = max(1, min(size, int(size / (interictal_samples / pre)))) if interictal_samples > 0 else size
    is_pre = F.coalesce(F.col(label).startswith("p"), F.lit(False))
    return segment_fixed(df.where(is_pre), column, size, step).unionByName(segment_fixed(df.where(~is_pre), column, size))


def epochs(df: DataFrame, column: str, rate: float, seconds: float = 1.0, drop_last: bool = True) -> DataFrame:
    """Epochs of seconds end to end, with epoch. With drop_last off, a remainder raises an error."""
    if rate <= 0 or seconds <= 0:
        raise ValueError("rate and seconds must be positive")
    size = round(seconds * rate)
    if size <= 0:
        raise ValueError("an epoch must hold a sample")
    if not drop_last:
        exact = F.when(F.size(column) % size != 0, F.raise_error(F.lit("a signal is no whole number of epochs"))).otherwise(F.col(column))
        df = df.withColumn(column, exact)
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.posexplode(samples.pieces(F.col(column), size, size)).alias("epoch", "segment"))


def montage(df: DataFrame, keys: list[str], column: str = "samples", pairs: DataFrame | None = None) -> DataFrame:
    """(keys, pair, name, samples): the difference of the two channels of each pair.

    pairs: pair, ch_a, ch_b, a short list; unset, the 20 fixed ones. A pair of which a channel
    is missing has no row. Channels given twice for one key count by their greatest array.
    """
    return sides_of(df, keys, column, pairs).select(*keys, "pair", "name", F.zip_with("_a", "_b", lambda a, b: a - b).alias(column))


def sides_of(df: DataFrame, keys: list[str], column: str, pairs: DataFrame | None = None) -> DataFrame:
    """(keys, pair, name, _a, _b): the arrays of the two channels of each pair that has both."""
    if pairs is None:
        pairs = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(schema.PAIRS)], "pair int, ch_a string, ch_b string")
    sides = pairs.select("pair", F.concat_ws("-", "ch_a", "ch_b").alias("name"), F.explode(F.array(F.struct(F.col("ch_a").alias("channel"), F.lit("a").alias("side")), F.struct(F.col("ch_b").alias("channel"), F.lit("b").alias("side")))).alias("_s")).select("pair", "name", "_s.*")
    used = df.join(F.broadcast(sides), "channel")  # at most two rows a pair, a fixed list
    both = used.groupBy(*keys, "pair", "name").agg(F.max(F.when(F.col("side") == "a", F.col(column))).alias("_a"), F.max(F.when(F.col("side") == "b", F.col(column))).alias("_b"))
    return both.where("_a is not null and _b is not null")


def mask_of(probabilities: Column, n: Column, rate: float, classes: tuple[int, ...] = schema.ARTIFACT_CLASSES) -> Column:
    """Which of n samples lie in windows whose likeliest class is an artifact.

    probabilities: an array of class probabilities for each window of two seconds; of equal ones
    the first counts. Samples after the last window are clean.
    """
    size = round(schema.DETECTOR_SECONDS * rate)
    flagged = F.transform(probabilities, lambda p: samples.argmax(p).isin(*classes))
    flag = lambda i: F.coalesce(F.try_element_at(flagged, F.floor(i / size).cast("int") + 1), F.lit(False))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), flag)).otherwise(F.array().cast("array<boolean>"))


def zeroed(values: Column, mask: Column) -> Column:
    return F.zip_with(values, mask, lambda v, m: F.when(m, F.lit(0.0)).otherwise(v))


def repair(df: DataFrame, column: str, mask: str, mode: str = "interpolate") -> DataFrame:
    """df with masked samples set to zero or interpolated, and fully_flagged where no sample is clean."""
    fixed = {"zero": zeroed, "interpolate": samples.interpolated}[mode](F.col(column), F.col(mask))
    full = (F.size(mask) > 0) & F.forall(mask, lambda m: F.coalesce(m, F.lit(False)))
    return df.withColumns({"fully_flagged": full, column: fixed})


def spans(df: DataFrame, mask: str) -> DataFrame:
    """A row for each run of true samples as [span_start, span_stop)."""
    others = [c for c in df.columns if c != mask]
    m = F.col(mask)
    n = F.size(m)
    at = lambda i: F.coalesce(F.try_element_at(m, i), F.lit(False))
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    begins = F.transform(F.filter(places, lambda i: at(i) & ((i == 1) | ~at(F.greatest(i - 1, F.lit(1))))), lambda i: i - 1)
    ends = F.filter(places, lambda i: at(i) & ~at(i + 1))
    return df.select(*others, F.explode(F.arrays_zip(begins.alias("a"), ends.alias("b"))).alias("_s")).select(*others, F.col("_s.a").alias("span_start"), F.col("_s.b").alias("span_stop"))


def artifact_fraction(probabilities: DataFrame, keys: list[str], column: str = "probs") -> DataFrame:
    """(keys, artifact_fraction, windows): mean weight of the artifact classes over all windows; 0.0 without windows."""
    window = F.explode_outer(column).alias("_p")
    weight = F.aggregate(F.slice("_p", 2, F.greatest(F.size("_p") - 1, F.lit(0))), F.lit(0.0), lambda a, x: a + x)
    out = probabilities.select(*keys, window).groupBy(*keys).agg(F.avg(F.when(F.col("_p").isNotNull(), weight)).alias("f"), F.count("_p").alias("windows"))
    return out.select(*keys, F.coalesce("f", F.lit(0.0)).alias("artifact_fraction"), "windows")


def event_overlap(events: DataFrame, masks: DataFrame, keys: list[str], rate: float, mask: str = "mask") -> DataFrame:
    """Events with their sample span in the signal of their key and the percentage of it that is masked.

    Times are rounded to samples and held within the signal; empty spans have no row. Events
    whose label is bckg in any case are told apart by is_background.
    """
    n = F.size(mask)
    clamp = lambda t: F.least(F.greatest(F.bround(t * F.lit(float(rate))).cast("int"), F.lit(0)), n)
    met = events.join(masks, keys).withColumns({"first_sample": clamp(F.col("start_time")), "last_sample": clamp(F.col("stop_time"))}).where("last_sample > first_sample")
    part = F.slice(F.col(mask), F.col("first_sample") + 1, F.col("last_sample") - F.col("first_sample"))
    share = F.size(F.filter(part, lambda m: m)) / (F.col("last_sample") - F.col("first_sample"))
    return met.withColumns({"overlap_percent": F.round(share * 100, 1), "is_background": F.lower("label") == "bckg"}).drop(mask)


def overlap_counters(overlaps: DataFrame, keys: list[str]) -> DataFrame:
    """Events of event_overlap, and background ones, by key, and how many of them meet a masked sample."""
    hit, back = F.col("overlap_percent") > 0, F.coalesce("is_background", F.lit(False))
    return overlaps.groupBy(*keys).agg(F.count(F.lit(1)).alias("events"), F.count_if(hit).alias("overlapping"), F.count_if(back).alias("background"), F.count_if(back & hit).alias("background_overlapping"))


def pair_masks(masks: DataFrame, keys: list[str], mask: str = "mask", pairs: DataFrame | None = None) -> DataFrame:
    """(keys, pair, name, mask): samples masked in either channel of each pair, as montage; a null counts as clean."""
    flags = masks.withColumn(mask, F.transform(mask, lambda m: F.when(F.coalesce(m, F.lit(False)), -1.0).otherwise(0.0)))
    return sides_of(flags, keys, mask, pairs).select(*keys, "pair", "name", F.zip_with("_a", "_b", lambda a, b: (a < 0) | (b < 0)).alias(mask))


def postprocess(signals: DataFrame, keys: list[str], f: Callable[[np.ndarray, list[str]], np.ndarray], column: str = "samples") -> DataFrame:
    """(keys, channel, samples): f on each key's matrix of channels by samples, channels in order of name.

    f is given the matrix and the channels' names and returns a matrix of as many rows. The
    channels of a key must be equally long, which is that key's bound.
    """
    kinds = ", ".join(f"{k} {signals.schema[k].dataType.simpleString()}" for k in [*keys, "channel"])

    def work(group: pa.Table) -> pa.Table:
        group = group.sort_by("channel")
        out = f(np.array(group[column].to_pylist(), float), group["channel"].to_pylist())
        return pa.table([*[group[k] for k in [*keys, "channel"]], pa.array(list(out), pa.list_(pa.float64()))], names=[*keys, "channel", column])

    return signals.select(*keys, "channel", column).groupBy(*keys).applyInArrow(work, f"{kinds}, {column} array<double>")


def extract(master: DataFrame, offsets: DataFrame, signals: DataFrame, rate: float = schema.TARGET_RATE, only_valid: bool | None = True, labels: tuple[str, ...] | None = None) -> DataFrame:
    """Samples of labelled rows out of session signals.

    offsets: edf_path, session_key, start_sample, end_sample; signals: session_key, channel,
    start_sample, samples (blocks). Rows of the same file, times, label and validity are one
    segment of several channels. Segments are clipped to their file and those without samples
    have no row. Result: segment_key, channel, label, start_time, stop_time, seg_start_sample, samples.
    """
    rows = master.where("edf_path is not null and start_time is not null and stop_time is not null and label is not null")
    if labels is not None:
        rows = rows.where(F.col("label").isin(*labels))
    if only_valid is not None:
        rows = rows.where(F.col("is_valid") == only_valid)
    one = rows.groupBy("edf_path", "start_time", "stop_time", "label", "is_valid").agg(F.array_sort(F.collect_set("channel")).alias("channels"))
    at = lambda t: samples.time_to_sample(F.col(t), F.col("start_sample"), F.col("end_sample"), rate)
    placed = one.join(offsets, "edf_path").withColumns({"_a": at("start_time"), "_b": at("stop_time")}).where("_b > _a").drop("start_sample", "end_sample")
    blocks = signals.withColumnsRenamed({"session_key": "_session_key", "start_sample": "_first"}).withColumn("_last", F.col("_first") + F.size("samples"))
    met = overlapping(placed, blocks, ["session_key"], "_a", "_b", "_first", "_last", MEETING_SECONDS * rate)
    begin = F.greatest(F.col("_a") - F.col("_first"), F.lit(0))
    size = F.least(F.col("_b"), F.col("_last")) - F.greatest("_a", "_first")
    cut = met.withColumn("_part", F.struct("_first", F.slice("samples", (begin + 1).cast("int"), size.cast("int")).alias("x")))
    keys = ["edf_path", "session_key", "channel", "label", "is_valid", "start_time", "stop_time", "_a"]
    whole = cut.groupBy(*keys).agg(F.flatten(F.transform(F.array_sort(F.collect_list("_part")), lambda p: p["x"])).alias("samples"))
    return whole.withColumnRenamed("_a", "seg_start_sample")


def sample_offsets(files: DataFrame) -> DataFrame:
    """edf_path, session_key, start_sample, end_sample from the number of samples of each file, in order of path."""
    order = Window.partitionBy("session_key").orderBy("edf_path")
    end = F.sum(F.coalesce("samples", F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return files.select("edf_path", "session_key", (end - F.coalesce("samples", F.lit(0))).alias("start_sample"), end.alias("end_sample"))
