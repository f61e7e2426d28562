"""Channel names of annotations matched to those of signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions import channels


def match_channels(annotated: DataFrame, present: DataFrame, keys: list[str], cutoff: float = 0.8) -> DataFrame:
    """(keys, annotation, channel, likeness): the signal's channel of each annotated name, null where none fits.

    Names are compared normalised; those without an equal one take the likeliest of the same
    key with a likeness of at least cutoff. A key has few channels, so its pairs are few. Of
    names that normalise alike, the least stands for them; null names never match.
    """
    a = annotated.where("channel is not null").select(*keys, F.col("channel").alias("annotation")).distinct().withColumn("_n", channels.normalized(F.col("annotation")))
    p = present.where("channel is not null").withColumn("_n", channels.normalized(F.col("channel"))).groupBy(*keys, "_n").agg(F.min("channel").alias("channel"))
    exact = a.join(p, [*keys, "_n"], "left")
    found = exact.where("channel is not null").select(*keys, "annotation", "channel", F.lit(1.0).alias("likeness"))
    rest = exact.where("channel is null").select(*keys, "annotation", F.col("_n").alias("_a"))
    near = rest.join(p, keys).withColumn("likeness", channels.likeness("_a", "_n")).where(F.col("likeness") >= cutoff)
    best = Window.partitionBy(*keys, "annotation").orderBy(F.desc("likeness"), F.desc("_n"))
    top = near.withColumn("_r", F.row_number().over(best)).where("_r = 1").select(*keys, "annotation", "channel", "likeness")
    none = rest.join(top, [*keys, "annotation"], "left_anti").select(*keys, "annotation", F.lit(None).cast("string").alias("channel"), F.lit(None).cast("double").alias("likeness"))
    return found.unionByName(top).unionByName(none)


def derive_missing(annotated: DataFrame, signals: DataFrame, keys: list[str], montage: DataFrame | None = None, column: str = "samples", cutoff: float = 0.8, unresolved: bool = False) -> DataFrame:
    """(keys, name, samples): bipolar channels that annotations name, as differences of two signals.

    montage: name, source_a, source_b from a montage file; other names are parted at their first
    hyphen. Both sources are found among the key's signals as in match_channels; a cutoff of 1
    takes equal names only. With unresolved, names that lack a source are rows with null samples.
    """
    names = annotated.where("channel is not null").select(*keys, F.col("channel").alias("name")).distinct()
    guess = channels.bipolar_sides(F.col("name"))
    if montage is not None:
        names = names.join(montage.select("name", F.struct(F.col("source_a").alias("a"), F.col("source_b").alias("b")).alias("_m")), "name", "left")
        guess = F.coalesce("_m", guess)
    sides = names.withColumn("_s", guess).where("_s is not null").select(*keys, "name", F.col("_s.a").alias("_a"), F.col("_s.b").alias("_b"))
    wanted = sides.select(*keys, F.explode(F.array("_a", "_b")).alias("channel"))
    found = match_channels(wanted, signals.select(*keys, "channel"), keys, cutoff).where("channel is not null")
    own = signals.where("channel is not null").groupBy(*keys, "channel").agg(F.min(column).alias("_x"))
    resolved = found.join(own, [*keys, "channel"]).select(*keys, "annotation", "_x")
    left, right = resolved.withColumnsRenamed({"annotation": "_a", "_x": "_xa"}), resolved.withColumnsRenamed({"annotation": "_b", "_x": "_xb"})
    how = "left" if unresolved else "inner"
    met = sides.join(left, [*keys, "_a"], how).join(right, [*keys, "_b"], how)
    return met.select(*keys, "name", F.zip_with("_xa", "_xb", lambda a, b: a - b).alias(column))
