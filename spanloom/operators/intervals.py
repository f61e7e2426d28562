"""Interval operators: windows, complement, difference by priority, as-of placement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from spanloom.operators.coverage import periods_and_gaps


def window_count(start: Column, stop: Column, size: Column, step: Column, epsilon: float) -> Column:
    """Number of whole windows of size every step between start and stop."""
    fits = stop - start >= size - F.lit(epsilon)
    return F.when(fits, F.floor((stop + F.lit(epsilon) - size - start) / step).cast("int") + 1).otherwise(0)


def explode_windows(df: DataFrame, size: float, step: float | Column, epsilon: float = 0.0, start: str = "start_time", stop: str = "stop_time", ordinal: str = "window") -> DataFrame:
    """A row for each window of size seconds every step within [start, stop]; rows too short go.

    The k-th window starts at start + k * step. Rows with a null time go. Other columns stay.
    """
    if size <= 0 or not isinstance(step, Column) and step <= 0:
        raise ValueError("window and step must be positive")
    pace = step if isinstance(step, Column) else F.lit(float(step))
    count = window_count(F.col(start), F.col(stop), F.lit(float(size)), pace, epsilon)
    out = df.withColumn("_count", count).where("_count > 0").withColumn(ordinal, F.explode(F.sequence(F.lit(0), F.col("_count") - 1)))
    begin = F.col(start) + F.col(ordinal) * pace
    return out.withColumns({"_begin": begin}).withColumns({start: F.col("_begin"), stop: F.col("_begin") + F.lit(float(size))}).drop("_begin", "_count")


def merge(df: DataFrame, keys: list[str], start: str = "start_time", stop: str = "stop_time") -> DataFrame:
    """(keys, start, stop) of the union of each group's intervals; touching ones are one."""
    merged = periods_and_gaps(df, keys, start, stop).where("kind = 'period'")
    return merged.select(*keys, F.col("from").alias(start), F.col("to").alias(stop))


def complement(covers: DataFrame, spans: DataFrame, keys: list[str], total: str, start: str = "start_time", stop: str = "stop_time") -> DataFrame:
    """(keys, start, stop) of the time from 0 to total that no interval covers.

    spans gives each group's total; groups without cover are free from 0 to total, groups
    without a total, or with one not above 0, have no row. Covers are clipped to the span.
    """
    spans = spans.where(F.col(total).isNotNull() & (F.col(total) > 0)).select(*keys, F.col(total).alias("_total"))
    clipped = covers.select(*keys, start, stop).join(spans, keys).withColumns({start: F.greatest(F.lit(0.0), F.col(start)), stop: F.least(F.col(stop), F.col("_total"))})
    # a span's two edges as covers of length one on either side make the outer gaps inner ones
    edges = spans.select(*keys, F.explode(F.array(F.struct(F.lit(-1.0).alias("a"), F.lit(0.0).alias("b")), F.struct(F.col("_total").alias("a"), (F.col("_total") + 1).alias("b")))).alias("e"))
    edges = edges.select(*keys, F.col("e.a").alias(start), F.col("e.b").alias(stop))
    walls = clipped.where(F.col(stop) > F.col(start)).select(*keys, start, stop).unionByName(edges)
    gaps = periods_and_gaps(walls, keys, start, stop).where("kind = 'gap'")
    return gaps.select(*keys, F.col("from").alias(start), F.col("to").alias(stop))


#: Seconds of the blocks by which intervals that may overlap are brought together, and of those within which rows are ordered.
BLOCK_SECONDS, ORDER_SECONDS = 60.0, 3600.0


def overlapping(rows: DataFrame, others: DataFrame, keys: list[str], start: str = "start_time", stop: str = "stop_time", other_start: str = "_a", other_stop: str = "_b", block: float = BLOCK_SECONDS) -> DataFrame:
    """Pairs of rows and others of one key that share time; null keys meet null keys.

    Both sides are spread over the blocks of time they touch and joined by key and block, so a
    hot key is parted by time; a pair counts in the block in which its shared time begins.
    others has the keys under their names with _ before.
    """
    touched = lambda a, b: F.sequence(F.floor(F.col(a) / block), F.greatest(F.floor(F.col(a) / block), F.ceil(F.col(b) / block) - 1))
    left = rows.where(F.col(stop) > F.col(start)).withColumn("_block", F.explode(touched(start, stop)))
    right = others.where(F.col(other_stop) > F.col(other_start)).withColumn("_other_block", F.explode(touched(other_start, other_stop)))
    meets = (F.col("_block") == F.col("_other_block")) & (F.col(other_start) < F.col(stop)) & (F.col(other_stop) > F.col(start))
    for key in keys:
        meets &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    first = F.floor(F.greatest(start, other_start) / block) == F.col("_block")
    return left.join(right, meets & first).drop("_block", "_other_block")


def _with_carried(df: DataFrame, keys: list[str], block: Column, inside: Column, carried: Column, over: Callable[[Column, WindowSpec], Column], backwards: bool, name: str) -> DataFrame:
    """df with inside, a window expression within a block, or where that is null what is carried from the blocks passed before.

    carried is aggregated for each block, over takes it over the blocks of a key. Only blocks
    are sorted in one task, and the few rows of a key that stand for its blocks.
    """
    cut = df.withColumn("_block", block)
    ends = cut.groupBy(*keys, "_block").agg(carried.alias("_end"))
    order = Window.partitionBy(*keys).orderBy(F.desc("_block") if backwards else F.asc("_block"))
    told = ends.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_block").alias("_of_block"), over(F.col("_end"), order).alias("_carried"))
    same = F.col("_block").eqNullSafe(F.col("_of_block"))
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    out = cut.withColumn(name, inside).join(told, same)
    return out.withColumn(name, F.coalesce(name, "_carried")).drop("_block", "_of_block", "_carried", *[f"_{k}" for k in keys])


def neighbour(df: DataFrame, keys: list[str], order: list[str], columns: list[str], name: str, following: bool = False, block: float = ORDER_SECONDS) -> DataFrame:
    """df with a struct of columns of the row before, or following, within keys by order; null where there is none.

    order begins with a time in seconds, by whose blocks a key is parted.
    """
    window = Window.partitionBy(*keys, "_block").orderBy(*order)
    row, place = F.struct(*columns), F.struct(*order)
    near = (F.lead if following else F.lag)(row).over(window)
    edge = (F.min_by if following else F.max_by)(row, place)
    return _with_carried(df, keys, F.floor(F.col(order[0]) / block), near, edge, lambda e, w: F.lag(e).over(w), following, name)


def reach(df: DataFrame, keys: list[str], order: list[str], column: str, name: str, block: float = ORDER_SECONDS) -> DataFrame:
    """df with the greatest column of all rows before within keys by order; null where there is none."""
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    cut = _with_carried(df, keys, F.floor(F.col(order[0]) / block), F.lit(None).cast("double"), F.max(column), lambda e, w: F.max(e).over(before(w)), False, "_earlier")
    cut = cut.withColumn("_block", F.floor(F.col(order[0]) / block))
    inside = F.max(column).over(before(Window.partitionBy(*keys, "_block").orderBy(*order)))
    return cut.withColumn(name, F.greatest(inside, "_earlier")).drop("_block", "_earlier")


def subtract(rows: DataFrame, islands: DataFrame, keys: list[str], row_id: str, start: str = "start_time", stop: str = "stop_time", before: DataFrame | None = None) -> DataFrame:
    """Rows cut by the islands of their group; one row for each piece of positive length.

    islands must be disjoint within a group and have the columns keys, start and stop; row_id
    names a column that is different for each row of a group. Only keys and times of rows are
    brought together with islands, block by block; a row that none meets stays whole. before,
    if given, are the same rows with at least their time, from which the meetings are found
    without the work that shortened them.
    """
    name = F.struct(*keys, row_id)
    wide = (rows if before is None else before).select(name.alias("_row"), *keys, start, stop)
    rows = rows.withColumn("_row", name)
    cuts = islands.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(start).alias("_a"), F.col(stop).alias("_b"))
    met = overlapping(wide, cuts, keys, start, stop)
    met = met.groupBy(F.col("_row").alias("_met")).agg(F.array_sort(F.collect_list(F.struct("_a", "_b"))).alias("_cuts"))
    # pieces lie between the ends of cuts, from the row's start to its stop
    cut = F.coalesce("_cuts", F.array().cast("array<struct<_a:double,_b:double>>"))
    begins = F.concat(F.array(F.col(start).cast("double")), F.transform(cut, lambda c: F.greatest(F.col(start), c["_b"])))
    finishes = F.concat(F.transform(cut, lambda c: F.least(F.col(stop), c["_a"])), F.array(F.col(stop).cast("double")))
    pieces = F.filter(F.arrays_zip(begins.alias("a"), finishes.alias("b")), lambda p: p["b"] > p["a"])
    out = rows.join(met, F.col("_row").eqNullSafe(F.col("_met")), "left").withColumn("_piece", F.explode(pieces))
    return out.withColumns({start: F.col("_piece.a"), stop: F.col("_piece.b")}).drop("_row", "_met", "_cuts", "_piece")


def place_in_files(rows: DataFrame, layouts: DataFrame, key: str = "session_key", path: str = "edf_path") -> DataFrame:
    """Session times to times within the file that lies at the row's start (an as-of join).

    The file of the greatest offset not after the start is taken, of equal offsets the last by
    path, before the first file the first; stops may go beyond the file. Rows of a session
    without layout, or without session, stay as they are. layouts: key, path, offset_s.
    """
    order = Window.partitionBy(key).orderBy("offset_s", path)
    lead = F.lead("offset_s").over(order)
    block = lambda t: F.floor(t / BLOCK_SECONDS)
    # each file stands in the blocks of time it covers, the last one in that of its start
    files = layouts.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(path).alias("_path"), F.col("offset_s").alias("_offset"), (F.row_number().over(order) == 1).alias("_first"), lead.alias("_to"))
    files = files.withColumn("_block", F.explode(F.sequence(block(F.col("_offset")), block(F.coalesce("_to", "_offset")))))
    spans = layouts.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_session")).agg(F.min("offset_s").alias("_low"), F.max("offset_s").alias("_high"))
    known = rows.join(spans, F.col(key) == F.col("_session"), "left")
    at = (F.col(key) == F.col("_key")) & (block(F.least(F.greatest("start_time", "_low"), "_high")) == F.col("_block"))
    at &= ((F.col("start_time") >= F.col("_offset")) | F.col("_first")) & (F.col("_to").isNull() | (F.col("start_time") < F.col("_to")))
    found = known.join(files, at, "left")
    shift = F.coalesce("_offset", F.lit(0.0))
    out = found.withColumns({"start_time": F.col("start_time") - shift, "stop_time": F.col("stop_time") - shift, path: F.coalesce("_path", path)})
    return out.drop("_key", "_path", "_offset", "_first", "_to", "_block", "_session", "_low", "_high")


def overlap_seconds(left: DataFrame, right: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """Rows of left, told apart by row_id, with the time they share with the disjoint intervals of right (column overlap)."""
    left = left.withColumn("_row", F.struct(*keys, row_id))
    other = right.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("start_time").alias("_a"), F.col("stop_time").alias("_b"))
    shared = F.sum(F.least("_b", "stop_time") - F.greatest("_a", "start_time"))
    met = overlapping(left.select("_row", *keys, "start_time", "stop_time"), other, keys).groupBy(F.col("_row").alias("_met")).agg(shared.alias("overlap"))
    return left.join(met, F.col("_row").eqNullSafe(F.col("_met")), "left").withColumn("overlap", F.coalesce("overlap", F.lit(0.0))).drop("_row", "_met")
