"""Continuous periods and gaps of overlapping intervals (problem 5).

Within an entity, ordered by start, an interval opens a new period when it starts after the
running maximum of all ends before it. An entity of many rows is cut into blocks of start
times; the maximum end and the open period are carried over the blocks, so no task sorts more
than a block and the result is the same as without blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.session import materialize, materialize_counted

#: Entities with more distinct starts than this are cut into blocks.
BLOCK_ROWS = 500_000
#: Blocks of such an entity.
BLOCKS = 256


def clean_label(label: Column) -> Column:
    return F.lower(F.regexp_replace(label, r"^\s+|\s+$", ""))


def to_ms(seconds: Column) -> Column:
    """Whole milliseconds; null for null, NaN and infinite times."""
    usable = seconds.isNotNull() & ~F.isnan(seconds) & (F.abs(seconds) < F.lit(9e15))
    return F.when(usable, F.round(seconds * 1000).cast("long"))


def _opened(starts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the end reached before them and the start of the period they lie in."""
    order = Window.partitionBy(*keys).orderBy("_start")
    reach = starts.withColumn("_reach", F.max("_stop").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    marked = reach.withColumn("_open", _open())
    return marked.withColumn("_period", F.max("_open").over(order.rowsBetween(Window.unboundedPreceding, 0)))


def _open() -> Column:
    return F.when(F.col("_reach").isNull() | (F.col("_start") > F.col("_reach")), F.col("_start"))


def _opened_by_blocks(starts: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """The same, sorting no more than a block at once; ends and periods are carried over blocks."""
    cut = F.percentile_approx("_start", [i / BLOCKS for i in range(1, BLOCKS)], 10_000)
    cuts = starts.join(hot, keys, "left_semi").groupBy(*keys).agg(cut.alias("_cuts"))
    block = F.when(F.col("_cuts").isNull(), 0).otherwise(F.size(F.filter("_cuts", lambda c: c < F.col("_start"))))
    starts = materialize(starts.join(cuts, keys, "left").withColumn("_block", block).drop("_cuts"), "blocks")

    order = Window.partitionBy(*keys, "_block").orderBy("_start")
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ends = starts.groupBy(*keys, "_block").agg(F.max("_stop").alias("_end"))
    carried = ends.select(*keys, "_block", F.max("_end").over(before).alias("_carry"))
    inside = F.max("_stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    reach = starts.withColumn("_inside", inside).join(carried, [*keys, "_block"]).withColumn("_reach", F.greatest("_inside", "_carry"))
    marked = materialize(reach.drop("_inside", "_carry").withColumn("_open", _open()), "opened")
    opened = marked.groupBy(*keys, "_block").agg(F.max("_open").alias("_last"))
    still = opened.select(*keys, "_block", F.max("_last").over(before).alias("_from_before"))
    own = F.max("_open").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("_own", own).join(still, [*keys, "_block"]).withColumn("_period", F.coalesce("_own", "_from_before"))


def periods_and_gaps(intervals: DataFrame, keys: list[str], start: str, stop: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(keys, kind, from, to): kind is period or gap; touching intervals belong together.

    Rows with a null key, start or stop, or a stop not after the start, don't count. Ties and
    repeated rows change nothing. The distinct starts are written once to the shared folder. An entity without counting rows gives no row; an empty table
    an empty one. Further columns are left out; keys keep their names. start and stop may be
    integers or doubles without NaN.
    """
    usable = F.col(start).isNotNull() & F.col(stop).isNotNull() & (F.col(stop) > F.col(start))
    for key in keys:
        usable &= F.col(key).isNotNull()
    rows = intervals.where(usable).select(*keys, F.col(start).alias("_start"), F.col(stop).alias("_stop"))
    starts, n = materialize_counted(rows.groupBy(*keys, "_start").agg(F.max("_stop").alias("_stop")), "starts")
    hot = starts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block_rows)
    # no key can have more starts than there are
    placed = _opened(starts, keys) if n <= block_rows or hot.isEmpty() else _opened_by_blocks(starts, keys, hot)
    periods = placed.groupBy(*keys, F.col("_period").alias("from")).agg(F.max("_stop").alias("to"))
    gaps = placed.where(F.col("_open").isNotNull() & F.col("_reach").isNotNull())
    columns = [*keys, "kind", "from", "to"]
    return (
        periods.withColumn("kind", F.lit("period")).select(*columns)
        .unionByName(gaps.select(*keys, F.lit("gap").alias("kind"), F.col("_reach").alias("from"), F.col("_start").alias("to")))
    )


def labelled_coverage(master: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(edf_path, label, kind, from_ms, to_ms) over all channels of the master table.

    Labels count in lower case without outer blanks, times in whole milliseconds. Rows lacking
    a path, label or time (null or NaN), or empty after rounding, don't count.
    """
    rows = master.select("edf_path", clean_label(F.col("label")).alias("label"), to_ms(F.col("start_time")).alias("_from"), to_ms(F.col("stop_time")).alias("_to"))
    return periods_and_gaps(rows, ["edf_path", "label"], "_from", "_to", block_rows).withColumnsRenamed({"from": "from_ms", "to": "to_ms"})
