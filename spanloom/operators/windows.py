"""Windows of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.functions.labels import is_preictal
from spanloom.operators import annotate, intervals


def windows_fixed(df: DataFrame, size: float, step: float | None = None, labels: tuple[str, ...] | None = None) -> DataFrame:
    """Rows cut to windows of size every step; rows of other labels than the given pass unchanged. Short rows go."""
    if size <= 0 or step is not None and step <= 0:
        raise ValueError("window and step must be positive")
    if labels is None:
        return intervals.explode_windows(df, size, step or size, schema.EPSILON)
    chosen = F.coalesce(F.col("label").isin(*labels), F.lit(False))
    cut = intervals.explode_windows(df.where(chosen), size, step or size, schema.EPSILON)
    return df.where(~chosen).withColumn("window", F.lit(0)).unionByName(cut)


def windows_adaptive(df: DataFrame, size: float, background: float | None = None) -> DataFrame:
    """Preictal rows cut at the pace that balances them with background seconds; other rows pass uncut."""
    pre = is_preictal(F.col("label"))
    if background is None:
        pace = annotate.adaptive_pace(df.withColumn("is_valid", F.lit(True)), size).first()["pace"]
    else:
        total = df.where(pre).agg(F.sum(F.col("stop_time") - F.col("start_time"))).first()[0] or 0.0
        pace = max(0.1, min(size / (background / total), size)) if background > 0 and total > 0 else size
    cut = intervals.explode_windows(df.where(pre), size, pace, schema.EPSILON)
    return df.where(~pre).withColumn("window", F.lit(0)).unionByName(cut)
