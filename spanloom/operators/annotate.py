"""Operators over labelled intervals: what comes before, after and between events.

All take and give rows of schema.MASTER with a column _seq, a struct (stage, n, k) that is
different for each row and settles ties. Groups are the session (the file where a row has none)
and the channel. Rows whose label is null are never events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.functions import labels
from spanloom.operators import intervals

GROUP = ["_group", "channel"]
COLUMNS = schema.MASTER.fieldNames()


def seq(stage: int, n: Column, k: Column | None = None) -> Column:
    return F.struct(F.lit(stage).alias("stage"), n.cast("long").alias("n"), (F.lit(0) if k is None else k).cast("long").alias("k"))


def as_master(df: DataFrame, n: Column) -> DataFrame:
    """The columns of the master schema, missing ones as null, and _seq by n."""
    have = set(df.columns)
    columns = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.MASTER]
    return df.select(*columns, seq(0, n).alias("_seq"))


def grouped(df: DataFrame) -> DataFrame:
    return df.withColumn("_group", F.coalesce("session_key", "edf_path"))


def in_order(df: DataFrame) -> DataFrame:
    """The canonical order, for a sink."""
    return df.orderBy("split", "edf_path", "channel", "start_time", "stop_time", "label")


def _events(df: DataFrame) -> DataFrame:
    return grouped(df).where(labels.is_ictal(F.col("label")))


ORDER = ["start_time", "_seq"]


def preictal_gates(df: DataFrame, window: float, buffer: float, postictal: float | None = None) -> DataFrame:
    """Events with gate1 (too close to the start) and gate2 (too close to the event before), and their previous stop.

    window is the length of the stretch before an event, buffer the time kept free between the
    two. The event before is the one that starts before, whatever its end.
    """
    need = window + buffer
    gate2 = F.lit(False) if postictal is None else F.coalesce(F.col("start_time") - F.col("previous_stop") < F.lit(float(postictal + need)), F.lit(False))
    near = intervals.neighbour(_events(df), GROUP, ORDER, ["stop_time"], "_previous").withColumn("previous_stop", F.col("_previous.stop_time")).drop("_previous")
    return near.withColumn("gate1", F.col("start_time") < need).withColumn("gate2", gate2)


def preictal_rows(df: DataFrame, window: float, buffer: float, postictal: float | None = None) -> DataFrame:
    """Only the new rows: p-stretches and buffers, or one invalid p-row where a gate fails."""
    if window <= 0 or buffer < 0:
        raise ValueError("window must be positive and buffer not negative")
    gated = preictal_gates(df, window, buffer, postictal)
    label, start = F.col("label"), F.col("start_time")
    row = lambda name, a, b, valid, k: F.struct(name.alias("label"), a.alias("start_time"), b.alias("stop_time"), F.lit(valid).alias("is_valid"), F.lit(k).alias("k"))
    p = F.concat(F.lit("p"), label)
    failed = row(p, F.when(F.col("gate1"), F.lit(0.0)).otherwise(F.col("previous_stop")), start, False, 0)
    passed = F.array(row(p, start - (buffer + window), start - buffer, True, 0), row(F.concat(p, F.lit(schema.BUFFER_SUFFIX)), start - buffer, start, False, 1))
    new = F.explode(F.when(F.col("gate1") | F.col("gate2"), F.array(failed)).otherwise(passed))
    out = gated.select("*", new.alias("_new"))
    changed = {"label": F.col("_new.label"), "start_time": F.col("_new.start_time"), "stop_time": F.col("_new.stop_time"), "is_valid": F.col("_new.is_valid"), "status": F.lit(1)}
    return out.select(*[changed.get(c, F.col(c)).alias(c) for c in COLUMNS], seq(1, F.col("_seq.n"), F.col("_new.k")).alias("_seq"))


def add_preictal(df: DataFrame, window: float, buffer: float, postictal: float | None = None) -> DataFrame:
    """df and its preictal rows."""
    return df.unionByName(preictal_rows(df, window, buffer, postictal))


def postictal_rows(df: DataFrame, postictal: float, preictal: float) -> DataFrame:
    """A q-row after each event that is followed late or by none, else a c-row up to the next one's stretch."""
    stop, label = F.col("stop_time"), F.col("label")
    near = intervals.neighbour(_events(df), GROUP, ORDER, ["start_time", "label"], "_following", following=True)
    following = near.withColumns({"_next": F.col("_following.start_time"), "_label": F.col("_following.label")})
    late = F.col("_next").isNull() | (F.col("_next") - stop >= F.lit(float(postictal + preictal)))
    until = F.col("_next") - F.lit(float(preictal))
    name = F.when(late, F.concat(F.lit("q"), label)).when(label == F.col("_label"), F.concat(F.lit("c"), label, F.lit("2"))).otherwise(F.concat(F.lit("c"), label, F.col("_label")))
    end = F.when(late, stop + F.lit(float(postictal))).otherwise(F.greatest(stop, until))
    status = F.when(~late & (until <= stop), 2).otherwise(1)
    changed = {"label": name, "start_time": stop, "stop_time": end, "status": status}
    return following.select(*[changed.get(c, F.col(c)).alias(c) for c in COLUMNS], seq(2, F.col("_seq.n")).alias("_seq"))


def add_postictal_and_consecutive(df: DataFrame, postictal: float, preictal: float) -> DataFrame:
    return df.unionByName(postictal_rows(df, postictal, preictal))


def exclusion_rows(df: DataFrame, postictal: float) -> DataFrame:
    """An invalid x-row of postictal seconds after each event."""
    stop = F.col("stop_time")
    changed = {"label": F.concat(F.lit("x"), F.col("label")), "start_time": stop, "stop_time": stop + F.lit(float(postictal)), "is_valid": F.lit(False), "status": F.lit(1)}
    return _events(df).select(*[changed.get(c, F.col(c)).alias(c) for c in COLUMNS], seq(4, F.col("_seq.n")).alias("_seq"))


def add_exclusions(df: DataFrame, postictal: float, active: bool = False) -> DataFrame:
    """df with its exclusion rows, overlaps resolved. Exclusions are dropped rows, unless active."""
    return resolve_overlaps(df.unionByName(exclusion_rows(df, postictal)), active)


def background_rows(df: DataFrame, totals: DataFrame, window: float, stride: float | None = None, min_gap: float | None = None, label: str = schema.BACKGROUND) -> DataFrame:
    """Windows of the time that no event covers, in groups that have an event.

    totals: session_key, total_duration_s and edf_path, duration_s (layouts); a group without
    session takes its file's duration. Groups without a duration above 0 get no rows. A row is
    a copy of the group's first event but for label, times, status and confidence 1.
    """
    stride, min_gap = window if stride is None else stride, window if min_gap is None else min_gap
    if window <= 0 or stride <= 0 or min_gap <= 0:
        raise ValueError("window, stride and gap must be positive")
    events = _events(df)
    first = events.groupBy(*GROUP).agg(F.min_by(F.struct(*COLUMNS, "_seq"), F.struct("start_time", "_seq")).alias("_t"))
    sessions = totals.where("session_key is not null").groupBy(F.col("session_key").alias("_s")).agg(F.max("total_duration_s").alias("_session_total"))
    files = totals.groupBy(F.col("edf_path").alias("_f")).agg(F.max("duration_s").alias("_file_total"))
    spans = first.select(*GROUP, "_t").join(sessions, F.col("_t.session_key") == F.col("_s"), "left").join(files, F.col("_t.edf_path") == F.col("_f"), "left")
    spans = spans.select(*GROUP, "_t", F.coalesce("_session_total", "_file_total").alias("_total"))
    gaps = intervals.complement(events, spans, GROUP, "_total").where(F.col("stop_time") - F.col("start_time") >= min_gap)
    own = spans.select(*[F.col(c).alias(f"_{c}") for c in GROUP], "_t")
    told = gaps.join(own, (F.col("_group") == F.col("__group")) & (F.col("channel").eqNullSafe(F.col("_channel"))))
    made = intervals.explode_windows(told, window, stride)
    changed = {"label": F.lit(label), "start_time": F.col("start_time"), "stop_time": F.col("stop_time"), "status": F.lit(1), "confidence": F.lit(1.0)}
    return made.select(*[changed.get(c, F.col(f"_t.{c}")).alias(c) for c in COLUMNS], seq(3, F.round(F.col("start_time") * 1000), F.col("_t._seq.n")).alias("_seq"))


def add_background(df: DataFrame, totals: DataFrame, window: float, stride: float | None = None, min_gap: float | None = None) -> DataFrame:
    return df.unionByName(background_rows(df, totals, window, stride, min_gap))


def interictal_rows(df: DataFrame, durations: DataFrame, min_length: float = 0.0) -> DataFrame:
    """(edf_path, channel, start_time, stop_time, label): whole gaps of all rows of a file's channel.

    durations: edf_path, duration_s; files without one have no rows.
    """
    keys = ["edf_path", "channel"]
    spans = df.select(*keys).distinct().join(durations.groupBy("edf_path").agg(F.max("duration_s").alias("_total")), "edf_path")
    gaps = intervals.complement(df, spans, keys, "_total")
    long_enough = F.col("stop_time") - F.col("start_time") >= min_length
    return gaps.where(long_enough).withColumn("label", F.lit(schema.INTERICTAL))


def resolve_overlaps(df: DataFrame, exclusions_active: bool = False) -> DataFrame:
    """Active rows keep the time that no row of higher priority, or earlier of the same, has taken.

    A row may lose all its time or be cut in pieces. Rows that are neither valid nor buffers
    pass unchanged. Within one priority a row's start moves to the latest end before it; from
    what is left the merged time of all higher priorities is taken away.
    """
    active = labels.is_active(F.col("is_valid"), F.col("label"))
    if exclusions_active:
        active |= F.col("label").startswith("x")
    rank = grouped(df).withColumns({"_active": active, "_level": labels.priority(F.col("label"))})
    live = rank.where("_active")
    reached = intervals.reach(live, [*GROUP, "_level"], ["start_time", "edf_path", "_seq"], "stop_time", "_reach")
    trimmed = reached.withColumn("start_time", F.greatest("start_time", "_reach")).where("start_time < stop_time").drop("_reach")
    # a priority without rows needs no islands; there are no more than six
    below = F.filter(F.array(*[F.lit(x) for x in (0, 1, 2, 5)]), lambda x: x < F.col("_level"))
    present = live.select(F.col("_level").alias("_low")).distinct()
    higher = live.select(*GROUP, "start_time", "stop_time", F.explode(below).alias("_low")).join(F.broadcast(present), "_low", "left_semi")
    islands = intervals.merge(higher.withColumnRenamed("_low", "_level"), [*GROUP, "_level"])
    kept = intervals.subtract(trimmed, islands, [*GROUP, "_level"], "_seq", before=live)
    return kept.select(*COLUMNS, "_seq").unionByName(rank.where("not _active").select(*COLUMNS, "_seq"))


def adaptive_pace(df: DataFrame, size: float) -> DataFrame:
    """One row: the step at which preictal stretches give about as much as the background has (pace)."""
    length = F.col("stop_time") - F.col("start_time")
    valid = F.coalesce("is_valid", F.lit(False))
    totals = df.agg(
        F.coalesce(F.sum(F.when(valid & (F.col("label") == schema.BACKGROUND), length)), F.lit(0.0)).alias("bg"),
        F.coalesce(F.sum(F.when(valid & labels.is_preictal(F.col("label")), length)), F.lit(0.0)).alias("pre"),
    )
    step = F.greatest(F.lit(0.1), F.least(F.lit(size) / (F.col("bg") / F.col("pre")), F.lit(size)))
    return totals.select("bg", "pre", F.when((F.col("bg") > 0) & (F.col("pre") > 0), step).otherwise(F.lit(float(size))).alias("pace"))


def chop(df: DataFrame, size: float = 4.0, preictal_stride: float | None = None, adaptive: bool = False) -> DataFrame:
    """Valid rows cut to windows of size seconds.

    Invalid rows and buffers stay; background rows stay if as long as a window; preictal ones
    are cut every preictal_stride (or the adaptive pace), others end to end. Tails go.
    """
    label, length = F.col("label"), F.col("stop_time") - F.col("start_time")
    live = F.coalesce("is_valid", F.lit(False)) & ~labels.is_buffer(label)
    is_bg = F.coalesce(label == schema.BACKGROUND, F.lit(False))
    if adaptive:
        stretch = F.lit(adaptive_pace(df, size).first()["pace"])
    else:
        stretch = F.lit(float(preictal_stride or size))
    pace = F.when(labels.is_preictal(label), stretch).otherwise(F.lit(float(size)))
    windows = intervals.window_count(F.col("start_time"), F.col("stop_time"), F.lit(float(size)), pace, schema.EPSILON)
    # one pass over the rows: whole ones count as one window of their own length
    whole = (length >= size - schema.EPSILON).cast("int")
    marked = df.withColumns({"_cut": live & ~is_bg, "_pace": pace, "_count": F.when(~live, 1).when(is_bg, whole).otherwise(windows)})
    out = marked.where("_count > 0").withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_count") - 1)))
    begin = F.col("start_time") + F.col("_k") * F.col("_pace")
    cut_seq = seq(5, F.col("_seq.n"), F.col("_seq.stage") * 1_000_000_000 + F.col("_seq.k") * 100_000 + F.col("_k"))
    changed = {"start_time": begin, "stop_time": begin + F.lit(float(size)), "_seq": cut_seq}
    return out.select(*[F.when(F.col("_cut"), changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in [*COLUMNS, "_seq"]])


def session_layouts(files: DataFrame) -> DataFrame:
    """Each file's offset on its session's time line, in order of path.

    files: session_key, edf_path, duration_s, one row a file; a null or NaN duration (a file
    that can't be read) counts as 0 and shows as readable false.
    """
    usable = F.col("duration_s").isNotNull() & ~F.isnan("duration_s")
    whole = files.select("session_key", "edf_path", F.when(usable, F.col("duration_s")).otherwise(F.lit(0.0)).alias("duration_s"), usable.alias("readable"))
    order = Window.partitionBy("session_key").orderBy("edf_path")
    ahead = F.coalesce(F.sum("duration_s").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    total = F.sum("duration_s").over(Window.partitionBy("session_key"))
    return whole.select("session_key", "edf_path", F.round(ahead, 6).alias("offset_s"), "duration_s", F.round(total, 6).alias("total_duration_s"), "readable")


def to_session_time(df: DataFrame, layouts: DataFrame) -> DataFrame:
    """File times to session times; rows of files without layout keep theirs and have no session."""
    known = layouts.select(F.col("edf_path").alias("_f"), F.col("session_key").alias("_s"), F.col("offset_s").alias("_o"))
    shift = F.coalesce("_o", F.lit(0.0))
    out = df.join(known, F.col("edf_path") == F.col("_f"), "left")
    return out.withColumns({"session_key": F.col("_s"), "start_time": F.col("start_time") + shift, "stop_time": F.col("stop_time") + shift}).drop("_f", "_s", "_o")


def to_file_time(df: DataFrame, layouts: DataFrame) -> DataFrame:
    return intervals.place_in_files(df, layouts)
