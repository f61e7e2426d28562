"""Views of the given tables as the operators' inputs, and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.operators import annotate
from spanloom.operators.coverage import clean_label
from spanloom.operators.spikes import clean_channel
from spanloom.session import table

#: Labels that annotators give, as opposed to derived ones.
TAGS = ("fnsz", "gnsz", "cpsz", "seiz", "bckg")
#: Lengths in seconds that suit recordings of a few minutes.
PREICTAL, BUFFER, POSTICTAL, WINDOW = 10.0, 5.0, 20.0, 4.0

_ORDER = ["ingested_at", "edf_path", "label", "channel", "start_time", "stop_time", "csv_path", "split", "session_key", "confidence", "is_valid", "status"]


def milli(c: str) -> Column:
    return F.round(F.col(c) * 1000) / F.lit(1000.0) + F.lit(0.0)


def annotations(spark: SparkSession, d: str, tags: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of master_full in file time, each master_id once, with usable times, labels and channels."""
    m = table(spark, d, "master_full")
    usable = F.col("edf_path").isNotNull() & F.col("label").isNotNull() & F.col("channel").isNotNull() & F.col("start_time").isNotNull() & F.col("stop_time").isNotNull() & ~F.isnan("start_time") & ~F.isnan("stop_time")
    one = m.where(usable).groupBy("master_id").agg(F.min(F.struct(*_ORDER)).alias("r")).select("master_id", "r.*")
    rows = one.withColumns({"label": clean_label(F.col("label")), "channel": clean_channel(F.col("channel")), "start_time": milli("start_time"), "stop_time": milli("stop_time")})
    rows = rows.where("start_time >= 0 and stop_time > start_time")
    if tags is not None:
        rows = rows.where(F.col("label").isin(*tags))
    return annotate.as_master(rows, F.col("master_id"))


def files(spark: SparkSession, d: str) -> DataFrame:
    """Recordings once each: session_key, edf_path, duration_s."""
    duration = F.when(~F.isnan("duration"), milli("duration"))
    return table(spark, d, "recordings").where("edf_path is not null and session_key is not null").groupBy("edf_path").agg(F.min("session_key").alias("session_key"), F.max(duration).alias("duration_s"))


def layouts(spark: SparkSession, d: str) -> DataFrame:
    return annotate.session_layouts(files(spark, d))


def session_rows(spark: SparkSession, d: str) -> DataFrame:
    """Annotators' rows in session time."""
    return annotate.to_session_time(annotations(spark, d, TAGS), layouts(spark, d))


def channels_of_vectors(spark: SparkSession, d: str) -> DataFrame:
    """embeddings as recordings of 17 channels with 64 samples at 16 Hz; the last one may lack channels."""
    names = F.array(*[F.lit(c) for c in schema.CHANNELS])
    k = len(schema.CHANNELS)
    e = table(spark, d, "embeddings").where("vec_id is not null and embedding is not null")
    return e.select(F.floor(F.col("vec_id") / k).cast("long").alias("recording"), F.element_at(names, (F.pmod("vec_id", F.lit(k)) + 1).cast("int")).alias("channel"), F.col("embedding").cast("array<double>").alias("samples"))


def onto_recordings(rows: DataFrame, vectors: DataFrame) -> DataFrame:
    """rows with a recording of vectors by their number _seq.n, over all recordings that exist; recordings are numbered from 0."""
    last = vectors.agg(F.max("recording").alias("_last"))
    return rows.crossJoin(F.broadcast(last)).where("_last is not null").withColumn("recording", F.pmod(F.col("_seq.n"), F.col("_last") + 1)).drop("_last")


_LIST = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"
ICTAL_SQL, TAGS_SQL = _LIST(schema.ICTAL), _LIST(TAGS)

ANN = """
m0 as (select *, row_number() over (partition by master_id order by ingested_at nulls first, edf_path, label, channel, start_time, stop_time, csv_path nulls first, split nulls first, session_key nulls first, confidence nulls first, is_valid nulls first, status nulls first) as rn
  from master_full where edf_path is not null and label is not null and channel is not null and start_time is not null and stop_time is not null and not isnan(start_time) and not isnan(stop_time)),
m1 as (select edf_path, csv_path, split, session_key, upper(regexp_replace(channel, '\\s+', '', 'g')) as channel, round(start_time * 1000) / 1000.0 + 0.0 as start_time, round(stop_time * 1000) / 1000.0 + 0.0 as stop_time,
    lower(regexp_replace(label, '^\\s+|\\s+$', '', 'g')) as label, confidence, is_valid, status, master_id as n from m0 where rn = 1),
ann as (select * from m1 where start_time >= 0 and stop_time > start_time)"""

FILES = """
fl as (select edf_path, min(session_key) as session_key, max(case when not isnan(duration) then round(duration * 1000) / 1000.0 end) as duration_s from recordings where edf_path is not null and session_key is not null group by 1)"""

LAY = FILES + """,
lay as (select session_key, edf_path, round(coalesce(sum(coalesce(duration_s, 0)) over (partition by session_key order by edf_path rows between unbounded preceding and 1 preceding), 0), 6) as offset_s,
    coalesce(duration_s, 0) as duration_s, round(sum(coalesce(duration_s, 0)) over (partition by session_key), 6) as total_duration_s, duration_s is not null as readable from fl)"""

G = f"""{ANN}, {LAY},
g as (select ann.edf_path, csv_path, split, lay.session_key, channel, start_time + coalesce(offset_s, 0) as start_time, stop_time + coalesce(offset_s, 0) as stop_time, label, confidence, is_valid, status, n
  from ann left join lay using (edf_path) where label in {TAGS_SQL})"""

_C = "edf_path, csv_path, split, session_key, channel"
NEED = PREICTAL + BUFFER
EV = f"""{G},
ev as (select *, coalesce(session_key, edf_path) as grp, lag(stop_time) over w as prev, lead(start_time) over w as nxt, lead(label) over w as nxtl from g where label in {ICTAL_SQL}
  window w as (partition by coalesce(session_key, edf_path), channel order by start_time, n)),
gate as (select *, start_time < {NEED} as gate1, coalesce(start_time - prev < {POSTICTAL + NEED}, false) as gate2 from ev),
pre as (
  select {_C}, case when gate1 then 0.0 else prev end as start_time, start_time as stop_time, 'p' || label as label, confidence, false as is_valid, 1 as status, 1 as stage, n, 0 as k from gate where gate1 or gate2
  union all select {_C}, start_time - {NEED}, start_time - {BUFFER}, 'p' || label, confidence, true, 1, 1, n, 0 from gate where not (gate1 or gate2)
  union all select {_C}, start_time - {BUFFER}, start_time, 'p' || label || '_sopbuffer', confidence, false, 1, 1, n, 1 from gate where not (gate1 or gate2)),
post as (select {_C}, stop_time as start_time, case when late then stop_time + {POSTICTAL} else greatest(stop_time, nxt - {PREICTAL}) end as stop_time,
    case when late then 'q' || label when label = nxtl then 'c' || label || '2' else 'c' || label || nxtl end as label, confidence, is_valid, case when not late and nxt - {PREICTAL} <= stop_time then 2 else 1 end as status, 2 as stage, n, 0 as k
  from (select *, nxt is null or nxt - stop_time >= {POSTICTAL + PREICTAL} as late from ev)),
tpl as (select * from (select *, row_number() over (partition by grp, channel order by start_time, n) as rk from ev) where rk = 1),
tot as (select tpl.*, coalesce(s.total, f.total) as total from tpl left join (select session_key, max(total_duration_s) as total from lay group by 1) s using (session_key) left join (select edf_path, max(duration_s) as total from lay group by 1) f on tpl.edf_path = f.edf_path),
span as (select * from tot where total > 0),
walls as (select ev.grp, ev.channel, greatest(0, ev.start_time) as s, least(ev.stop_time, total) as e from ev join span on ev.grp = span.grp and ev.channel = span.channel
  union all select grp, channel, -1, 0 from span union all select grp, channel, total, total + 1 from span),
reach as (select *, max(e) over (partition by grp, channel order by s, e rows between unbounded preceding and 1 preceding) as r from walls where e > s),
free as (select grp, channel, r as s, s as e from reach where s > r and s - r >= {WINDOW}),
bg as (select {", ".join("span." + c for c in _C.split(", "))}, s + i * {WINDOW} as start_time, s + i * {WINDOW} + {WINDOW} as stop_time, 'bg' as label, 1.0 as confidence, is_valid, 1 as status, 3 as stage, round((s + i * {WINDOW}) * 1000)::bigint as n, span.n as k
  from (select *, unnest(range(0, greatest(0, floor((e - {WINDOW} - s) / {WINDOW})::bigint + 1))) as i from free) x join span on x.grp = span.grp and x.channel = span.channel)"""

def resolved_sql(source: str, active: str = "false") -> str:
    """CTEs act to res over a CTE with the master columns, stage, n and k; active says what else than valid rows and buffers takes part."""
    return f"""
act as (select *, coalesce(session_key, edf_path) as grp, coalesce(is_valid, false) or ends_with(label, '_sopbuffer') or {active} as active,
    case when label in {ICTAL_SQL} then 1 when label like 'x%' then 6 when label like 'c%' then 5 when label like 'p%' then 2 when label = 'interictal' then 0 else 1 end as prio from {source}),
live as materialized (select *, row_number() over (order by grp, channel, prio desc, start_time, edf_path, stage, n, k) as rid from act where active),
cuts as (select distinct grp, channel, t from (select grp, channel, start_time as t from live union all select grp, channel, stop_time from live)),
elem as (select grp, channel, t as a, lead(t) over (partition by grp, channel order by t) as b from cuts),
held as materialized (select grp, channel, list({{'rid': rid, 's': start_time, 'e': stop_time}} order by rid) as held from live group by 1, 2),
own as (select * from (select grp, channel, a, b, list_filter(held, lambda r: r.s < b and r.e > a)[1].rid as rid from elem join held using (grp, channel) where b is not null) where rid is not null),
runs as (select *, sum(fresh) over (partition by rid order by a) as piece from (select *, case when lag(b) over (partition by rid order by a) = a then 0 else 1 end as fresh from own)),
pieces as (select rid, min(a) as a, max(b) as b from runs group by rid, piece),
res as (select {_C}, p.a as start_time, p.b as stop_time, label, confidence, is_valid, status from pieces p join live using (rid)
  union all select {_C}, start_time, stop_time, label, confidence, is_valid, status from act where not active)"""


ALL = f"""{EV},
mixed as (select {_C}, start_time, stop_time, label, confidence, is_valid, status, 0 as stage, n, 0 as k from g union all select * from pre union all select * from post union all select * from bg),
{resolved_sql("mixed")}"""


def chopped_sql(source: str) -> str:
    """CTEs w, chop over a CTE with the master columns."""
    return f"""
w as (select *, coalesce(is_valid, false) and not ends_with(label, '_sopbuffer') as live from {source}),
chop as (select {_C}, start_time, stop_time, label, confidence, is_valid, status from w where not live
  union all select {_C}, start_time, stop_time, label, confidence, is_valid, status from w where live and label = 'bg' and stop_time - start_time >= {WINDOW} - 1e-9
  union all select {_C}, start_time + i * {WINDOW}, start_time + i * {WINDOW} + {WINDOW}, label, confidence, is_valid, status
    from (select *, unnest(range(0, case when stop_time - start_time >= {WINDOW} - 1e-9 then floor((stop_time + 1e-9 - {WINDOW} - start_time) / {WINDOW})::bigint + 1 else 0 end)) as i from w where live and label <> 'bg'))"""


def placed_sql(source: str) -> str:
    """CTEs first, placed: the rows of source in file time, by an ASOF join."""
    return f"""
lo as (select *, min(offset_s) over (partition by session_key) as least_offset, row_number() over (partition by session_key order by offset_s, edf_path) as ord from lay),
late as (select session_key, offset_s, max(edf_path) as edf_path from lo group by 1, 2),
s0 as (select *, row_number() over () as rid from {source}),
aso as (select s0.*, late.edf_path as f, late.offset_s as o from s0 asof left join late on s0.session_key = late.session_key and s0.start_time >= late.offset_s),
placed as (select coalesce(aso.f, lo.edf_path, aso.edf_path) as edf_path, csv_path, split, aso.session_key, channel, start_time - coalesce(o, lo.offset_s, 0) as start_time, stop_time - coalesce(o, lo.offset_s, 0) as stop_time, label, confidence, is_valid, status
  from aso left join lo on aso.f is null and aso.session_key = lo.session_key and lo.ord = 1)"""


VEC = f"""
vec as (select vec_id // 17 as recording, ({list(schema.CHANNELS)!r})[vec_id % 17 + 1] as channel, embedding::double[] as samples from embeddings where vec_id is not null and embedding is not null)"""
LAST = "last as (select max(recording) + 1 as recordings from vec)"
