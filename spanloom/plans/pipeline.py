"""From annotations to windows in file time, and from signals to montages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.operators import annotate, dsp, signals
from spanloom.session import materialize


@dataclass(frozen=True)
class MasterConfig:
    """Lengths in seconds. preictal is the stretch before an event, buffer the time between the two."""

    preictal: float = 3600.0
    buffer: float = 300.0
    postictal: float | None = 14400.0
    window: float = 4.0
    background_stride: float | None = None
    preictal_stride: float | None = None
    with_postictal: bool = True
    with_background: bool = True
    tags: tuple[str, ...] | None = None


def build_master(rows: DataFrame, layouts: DataFrame, config: MasterConfig) -> DataFrame:
    """Labelled windows in file time from annotation rows in file time.

    Rows in session time, and all rows before overlaps are resolved, are written once to the
    shared folder, as several steps read them.

    rows have the master schema and _seq; layouts come from session_layouts.
    """
    df = rows if config.tags is None else rows.where(F.col("label").isin(*config.tags))
    df = materialize(annotate.to_session_time(df, layouts), "session-rows")
    out = annotate.add_preictal(df, config.preictal, config.buffer, config.postictal)
    if config.with_postictal and config.postictal is not None:
        out = out.unionByName(annotate.postictal_rows(df, config.postictal, config.preictal))
    if config.with_background:
        out = out.unionByName(annotate.background_rows(df, layouts, config.window, config.background_stride))
    out = materialize(out, "labelled-rows")
    out = annotate.chop(annotate.resolve_overlaps(out), config.window, config.preictal_stride or config.background_stride)
    return annotate.to_file_time(out, layouts).select(*schema.MASTER.fieldNames())


def session_signals(files: DataFrame, low: float = 0.5, high: float = 40.0, noise: list[float] | None = None, target: float = schema.TARGET_RATE) -> tuple[DataFrame, DataFrame]:
    """Signals of sessions on one rate and time line, and the sample offsets of their files.

    files: session_key, edf_path, channel, sfreq, samples, one row a channel of a file. Each is
    freed of noise frequencies and filtered at its own rate, then resampled; files follow each
    other in order of path. Files that lack one of the 17 channels are left out.
    """
    usable = files.where(F.col("channel").isin(*schema.CHANNELS))
    full = usable.groupBy("session_key", "edf_path").agg(F.count_distinct("channel").alias("n"), F.max("sfreq").alias("_rate")).where(F.col("n") == len(schema.CHANNELS)).drop("n")
    usable = usable.join(full.drop("_rate"), ["session_key", "edf_path"], "left_semi")
    out = None
    for (rate,) in full.select("_rate").distinct().orderBy("_rate").collect():  # the few native rates
        own = usable.where(F.col("sfreq") == rate)
        own = dsp.notch(own, "samples", rate, noise or [])
        own = dsp.bandpass(own, "samples", rate, low, min(high, 0.45 * rate))
        own = dsp.resample(own, "samples", rate, target) if rate != target else own
        own = own.withColumn("samples", F.col("samples").cast("array<float>"))
        out = own if out is None else out.unionByName(own)
    if out is None:
        out = usable.withColumn("samples", F.col("samples").cast("array<float>"))
    lengths = out.groupBy("session_key", "edf_path").agg(F.min(F.size("samples")).cast("long").alias("samples"))
    offsets = signals.sample_offsets(lengths)
    placed = out.join(offsets, ["session_key", "edf_path"]).select("session_key", "channel", "start_sample", "edf_path", "samples")
    return placed, offsets
