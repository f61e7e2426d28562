"""Queries of the interval and signal operators, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.functions import channels, labels, samples
from spanloom.operators import annotate, dsp, intervals, match, signals, windows
from spanloom.plans import adapters as A
from spanloom.plans.pipeline import MasterConfig, build_master, session_signals
from spanloom.session import materialize, scratch, table
from spanloom.sinks import tables
from spanloom.sources import annotations as source

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

MASTER = schema.MASTER.fieldNames()
_TIMES = ("start_time", "stop_time")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _plain(x: Column) -> Column:
    """Rounded; zero without sign."""
    return F.round(x, 6) + F.lit(0.0)


def _master(df: DataFrame) -> DataFrame:
    return _rounded(df.select(*MASTER), *_TIMES)


def _session_rows(spark: SparkSession, d: str) -> DataFrame:
    """Annotators' rows in session time, written once for operators that read them several times."""
    return materialize(A.session_rows(spark, d), "session-rows")


_OUT = "edf_path, csv_path, split, session_key, channel, round(start_time, 6) as start_time, round(stop_time, 6) as stop_time, label, confidence, is_valid, status"


# Projections, filters and aggregates of annotation rows


@query(f"with {A.ANN} select distinct label from ann")
def unique_tags(spark: SparkSession, d: str) -> DataFrame:
    return A.annotations(spark, d).select("label").distinct()


@query(f"with {A.ANN} select label, count(*) as n, count(*) filter (where label <> 'bckg') as n_events from ann group by 1")
def label_histogram(spark: SparkSession, d: str) -> DataFrame:
    return A.annotations(spark, d).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") != "bckg").alias("n_events"))


@query(f"with {A.ANN} select n as master_id, label, start_time, stop_time from ann where label in ('fnsz', 'gnsz')")
def allow_tag_filter(spark: SparkSession, d: str) -> DataFrame:
    return A.annotations(spark, d, ("fnsz", "gnsz")).select(F.col("_seq.n").alias("master_id"), "label", "start_time", "stop_time")


@query("""
with r as (select distinct edf_path, string_split(edf_path, '/') as p, list_transform(string_split(lower(edf_path), '/'), lambda x: x) as l from recordings where edf_path is not null),
s as (select *, case when list_contains(l, 'train') then 'train' when list_contains(l, 'dev') then 'dev' when list_contains(l, 'eval') then 'eval' else 'unknown' end as split from r),
a as (select *, len(l) - list_position(list_reverse(l), split) + 1 as pos from s where split <> 'unknown'),
m as (select *, p[pos + 1] as patient, p[pos + 2] as session, p[pos + 3] as folder from a where pos + 3 < len(p)),
t as (select *, case when contains(lower(folder), 'tcp_ar') then 'ar' when contains(lower(folder), 'tcp_le') then 'le' else 'unk' end || case when regexp_full_match(split_part(folder, '_', 1), '[0-9]+') then split_part(folder, '_', 1)::bigint::varchar else '0' end as montage_type from m)
select edf_path, split, patient as patient_id, session as session_id, montage_type, case split when 'train' then 'trn' when 'dev' then 'vld' else 'tst' end || '_' || patient || '_' || session || '_' || montage_type as session_key from t""")
def file_index(spark: SparkSession, d: str) -> DataFrame:
    paths = table(spark, d, "recordings").where("edf_path is not null").select(F.col("edf_path").alias("path")).distinct()
    return source.index_files(paths).select(F.col("path").alias("edf_path"), "split", "patient_id", "session_id", "montage_type", "session_key")


@query("""
with f as (select distinct session_key, edf_path as path, 'edf' as kind from recordings where edf_path is not null and session_key is not null union select distinct session_key, csv_bi_path, 'csv_bi' from recordings where csv_bi_path is not null and session_key is not null)
select session_key, list_sort(list(path) filter (where kind = 'edf')) as edf_paths, list_sort(list(path) filter (where kind = 'csv_bi')) as csv_bi_paths from f group by 1""")
def session_index(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "recordings").where("edf_path is not null and csv_bi_path is not null and session_key is not null")
    files = r.select(F.explode(F.array("edf_path", "csv_bi_path")).alias("path")).distinct()
    return source.index_sessions(files).select("session_key", "edf_paths", "csv_bi_paths")


@query(f"""
with {A.ANN} select distinct label, case when label in {A.ICTAL_SQL} then 1 when label like 'x%' then 6 when label like 'c%' then 5 when label like 'p%' then 2 when label = 'interictal' then 0 else 1 end as priority,
  label in {A.ICTAL_SQL} as ictal, label like 'p%' and not ends_with(label, '_sopbuffer') as preictal from ann""")
def label_priority(spark: SparkSession, d: str) -> DataFrame:
    label = F.col("label")
    return A.annotations(spark, d).select("label").distinct().select("label", labels.priority(label).alias("priority"), labels.is_ictal(label).alias("ictal"), labels.is_preictal(label).alias("preictal"))


@query("""
select distinct csv_path, regexp_replace(csv_path, '[^/]*$', '') || replace(regexp_extract(csv_path, '[^/]*$'), '.csv', '.edf') as edf_path from master_full where csv_path is not null""")
def csv_to_edf_path(spark: SparkSession, d: str) -> DataFrame:
    paths = table(spark, d, "master_full").where("csv_path is not null").select("csv_path").distinct()
    return paths.withColumn("edf_path", labels.recording_of(F.col("csv_path")))


@query("""
with f as (select distinct csv_path, regexp_replace(csv_path, '[^/]*$', '') || replace(regexp_extract(csv_path, '[^/]*$'), '.csv', '.edf') as edf_path from master_full where csv_path is not null)
select csv_path, edf_path in (select edf_path from recordings where edf_path is not null) as has_recording from f""")
def csv_edf_semi(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "master_full").where("csv_path is not null").select("csv_path").distinct()
    there = table(spark, d, "recordings").where("edf_path is not null").select(F.col("edf_path").alias("path")).distinct()
    found = rows.withColumn("edf_path", labels.recording_of(F.col("csv_path"))).join(there.select(F.col("path").alias("edf_path")), "edf_path", "left_semi")
    none = source.without_recording(rows, there)
    return found.select("csv_path", F.lit(True).alias("has_recording")).unionByName(none.select("csv_path", F.lit(False).alias("has_recording")))


@query(f"with {A.ANN} select edf_path, start_time, stop_time, label, is_valid, list_sort(list_distinct(list(channel))) as channels from ann group by 1, 2, 3, 4, 5")
def dedup_channels(spark: SparkSession, d: str) -> DataFrame:
    keys = ["edf_path", "start_time", "stop_time", "label", "is_valid"]
    return A.annotations(spark, d).groupBy(*keys).agg(F.array_sort(F.collect_set("channel")).alias("channels"))


@query(f"""
with {A.ANN}, b as (select coalesce(sum(stop_time - start_time) filter (where is_valid and label = 'bg'), 0) as bg, coalesce(sum(stop_time - start_time) filter (where is_valid and label like 'p%' and not ends_with(label, '_sopbuffer')), 0) as pre from ann)
select round(bg, 3) as bg, round(pre, 3) as pre, round(case when bg > 0 and pre > 0 then greatest(0.1, least(4.0 / (bg / pre), 4.0)) else 4.0 end, 6) as pace from b""")
def adaptive_pace(spark: SparkSession, d: str) -> DataFrame:
    p = annotate.adaptive_pace(A.annotations(spark, d), A.WINDOW)
    return p.select(F.round("bg", 3).alias("bg"), F.round("pre", 3).alias("pre"), F.round("pace", 6).alias("pace"))


# Layouts and session time


@query(f"with {A.LAY} select session_key, edf_path, offset_s, duration_s, total_duration_s, readable from lay")
def session_layouts(spark: SparkSession, d: str) -> DataFrame:
    return A.layouts(spark, d)


@query(f"with {A.G} select {_OUT} from g")
def session_global_shift(spark: SparkSession, d: str) -> DataFrame:
    return _master(A.session_rows(spark, d))


@query(f"with {A.G}, {A.placed_sql('g')} select {_OUT} from placed")
def finalize_file_local(spark: SparkSession, d: str) -> DataFrame:
    return _master(annotate.to_file_time(A.session_rows(spark, d), A.layouts(spark, d)))


@query("""
with e as (select csv_bi_path, line_no, regexp_replace(line_text, '\\r$', '') as t from csv_bi where line_text is not null),
d0 as (select csv_bi_path, max(regexp_extract(t, 'duration[ \\t]*=[ \\t]*([+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?)[ \\t]*secs[ \\t]*$', 1)::double) as duration from e where line_no = 3 and regexp_matches(t, 'duration[ \\t]*=[ \\t]*[+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ \\t]*secs[ \\t]*$') group by 1),
k as (select distinct d0.csv_bi_path, d0.duration, session_key from d0 join recordings using (csv_bi_path) where d0.duration > 0),
c as (select *, round(coalesce(sum(duration) over (partition by session_key order by csv_bi_path rows between unbounded preceding and 1 preceding), 0), 6) as o from k),
q as (select csv_bi_path, regexp_extract_all(t, '(?:^|,)("(?:[^"]|"")*"|[^",]*)', 1) as f, t from e where line_no > 6 and regexp_full_match(t, '([^",]*|"([^"]|"")*")(,([^",]*|"([^"]|"")*"))*') and not starts_with(t, '#')),
v as (select distinct csv_bi_path, trim(f[2], '" ' || chr(9)) as a, trim(f[3], '" ' || chr(9)) as b from q where len(f) = 5 and trim(replace(trim(f[4], '"'), '""', '"')) = 'seiz'),
n as (select distinct csv_bi_path, try_cast(a as double) as start_time, try_cast(b as double) as end_time from v where regexp_full_match(a, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') and regexp_full_match(b, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'))
select session_key, n.csv_bi_path, start_time, end_time, round(o + start_time, 6) as session_start, round(o + end_time, 6) as session_end from n join c on n.csv_bi_path = c.csv_bi_path where start_time >= 0 and end_time >= start_time""")
def session_metadata(spark: SparkSession, d: str) -> DataFrame:
    out = source.session_events(table(spark, d, "csv_bi"), table(spark, d, "recordings").where("csv_bi_path is not null"))
    return _rounded(out, "session_start", "session_end")


# What comes before, after and between events


@query(f"with {A.EV} select n as master_id, round(start_time, 6) as start_time, round(stop_time, 6) as stop_time, label, gate1, gate2 from gate")
def preictal_gates(spark: SparkSession, d: str) -> DataFrame:
    g = annotate.preictal_gates(A.session_rows(spark, d), A.PREICTAL, A.BUFFER, A.POSTICTAL)
    return _rounded(g.select(F.col("_seq.n").alias("master_id"), *_TIMES, "label", "gate1", "gate2"), *_TIMES)


@query(f"with {A.EV} select label, count(*) as events, count(*) filter (where gate1) as gate1_failed, count(*) filter (where gate2 and not gate1) as gate2_failed, count(*) filter (where not gate1 and not gate2) as passed from gate group by 1")
def gate_counters(spark: SparkSession, d: str) -> DataFrame:
    g = annotate.preictal_gates(A.session_rows(spark, d), A.PREICTAL, A.BUFFER, A.POSTICTAL)
    one, two = F.col("gate1"), F.col("gate2")
    return g.groupBy("label").agg(F.count(F.lit(1)).alias("events"), F.count_if(one).alias("gate1_failed"), F.count_if(two & ~one).alias("gate2_failed"), F.count_if(~one & ~two).alias("passed"))


@query(f"with {A.EV} select {_OUT} from pre")
def preictal_rows(spark: SparkSession, d: str) -> DataFrame:
    return _master(annotate.preictal_rows(A.session_rows(spark, d), A.PREICTAL, A.BUFFER, A.POSTICTAL))


@query(f"with {A.EV} select {_OUT} from post")
def postictal_consecutive(spark: SparkSession, d: str) -> DataFrame:
    return _master(annotate.postictal_rows(A.session_rows(spark, d), A.POSTICTAL, A.PREICTAL))


@query(f"with {A.EV} select {_OUT} from (select edf_path, csv_path, split, session_key, channel, stop_time as start_time, stop_time + {A.POSTICTAL} as stop_time, 'x' || label as label, confidence, false as is_valid, 1 as status from ev)")
def exclusion_intervals(spark: SparkSession, d: str) -> DataFrame:
    return _master(annotate.exclusion_rows(A.session_rows(spark, d), A.POSTICTAL))


_EXCLUDED = f"{A.EV}, excluded as (select {A._C}, start_time, stop_time, label, confidence, is_valid, status, 0 as stage, n, 0 as k from g union all select {A._C}, stop_time, stop_time + {A.POSTICTAL}, 'x' || label, confidence, false, 1, 4, n, 0 from ev)"


@query(f"with {_EXCLUDED}, {A.resolved_sql('excluded')} select {_OUT} from res")
def add_exclusions(spark: SparkSession, d: str) -> DataFrame:
    return _master(annotate.add_exclusions(_session_rows(spark, d), A.POSTICTAL))


@query(f"with {_EXCLUDED}, {A.resolved_sql('excluded', "starts_with(label, 'x')")} select {_OUT} from res")
def add_exclusions_active(spark: SparkSession, d: str) -> DataFrame:
    """Exclusions take their time from other rows."""
    return _master(annotate.add_exclusions(_session_rows(spark, d), A.POSTICTAL, active=True))


@query(f"""
with {A.ANN}, r as (select *, max(stop_time) over (partition by edf_path, channel order by start_time, stop_time rows between unbounded preceding and 1 preceding) as reach from ann),
i as (select *, sum(case when reach is null or start_time > reach then 1 else 0 end) over (partition by edf_path, channel order by start_time, stop_time) as k from r)
select edf_path, channel, min(start_time) as start_time, max(stop_time) as stop_time from i group by edf_path, channel, k""")
def merge_intervals(spark: SparkSession, d: str) -> DataFrame:
    return intervals.merge(A.annotations(spark, d), ["edf_path", "channel"])


@query(f"""
with {A.ANN}, {A.LAY}, sp as (select distinct ann.edf_path, channel, duration_s as total from ann join lay using (edf_path) where duration_s > 0),
w as (select a.edf_path, a.channel, greatest(0, start_time) as s, least(stop_time, total) as e from ann a join sp using (edf_path, channel) union all select edf_path, channel, -1, 0 from sp union all select edf_path, channel, total, total + 1 from sp),
r as (select *, max(e) over (partition by edf_path, channel order by s, e rows between unbounded preceding and 1 preceding) as reach from w where e > s)
select edf_path, channel, reach as start_time, s as stop_time, 'interictal' as label from r where s > reach and s - reach >= 2.0""")
def interictal_gaps(spark: SparkSession, d: str) -> DataFrame:
    return annotate.interictal_rows(A.annotations(spark, d), A.files(spark, d), 2.0)


@query(f"with {A.EV} select {_OUT} from bg")
def background_windows(spark: SparkSession, d: str) -> DataFrame:
    return _master(annotate.background_rows(_session_rows(spark, d), A.layouts(spark, d), A.WINDOW))


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows, lay = _session_rows(spark, d), A.layouts(spark, d)
    mixed = annotate.add_preictal(rows, A.PREICTAL, A.BUFFER, A.POSTICTAL).unionByName(annotate.postictal_rows(rows, A.POSTICTAL, A.PREICTAL))
    return materialize(mixed.unionByName(annotate.background_rows(rows, lay, A.WINDOW)), "labelled-rows"), lay


@query(f"with {A.ALL} select {_OUT} from res")
def resolve_overlaps(spark: SparkSession, d: str) -> DataFrame:
    return _master(annotate.resolve_overlaps(_mixed(spark, d)[0]))


@query(f"""
with {A.ANN} select edf_path, channel, label, round(start_time + i * 2.0, 6) as start_time, round(start_time + i * 2.0 + 4.0, 6) as stop_time
from (select *, unnest(range(0, case when stop_time - start_time >= 4.0 - 1e-9 then floor((stop_time + 1e-9 - 4.0 - start_time) / 2.0)::bigint + 1 else 0 end)) as i from ann where label = 'fnsz')
union all select edf_path, channel, label, start_time, stop_time from ann where label <> 'fnsz'""")
def segment_sliding(spark: SparkSession, d: str) -> DataFrame:
    out = windows.windows_fixed(A.annotations(spark, d), 4.0, 2.0, ("fnsz",))
    return _rounded(out.select("edf_path", "channel", "label", *_TIMES), *_TIMES)


@query(f"""
with {A.ANN} select edf_path, channel, label, round(start_time + i * 4.0, 6) as start_time, round(start_time + i * 4.0 + 4.0, 6) as stop_time
from (select *, unnest(range(0, case when stop_time - start_time >= 4.0 - 1e-9 then floor((stop_time + 1e-9 - 4.0 - start_time) / 4.0)::bigint + 1 else 0 end)) as i from ann)""")
def segment_fixed(spark: SparkSession, d: str) -> DataFrame:
    out = windows.windows_fixed(A.annotations(spark, d), 4.0)
    return _rounded(out.select("edf_path", "channel", "label", *_TIMES), *_TIMES)


@query(f"""
with {A.ANN}, t as (select sum(stop_time - start_time) as pre from ann where label like 'p%' and not ends_with(label, '_sopbuffer')), p as (select greatest(0.1, least(2.0 / (50000.0 / pre), 2.0)) as pace from t)
select label, count(*) as n from (select label, unnest(range(0, case when stop_time - start_time >= 2.0 - 1e-9 then floor((stop_time + 1e-9 - 2.0 - start_time) / pace)::bigint + 1 else 0 end)) as i from ann, p where label like 'p%' and not ends_with(label, '_sopbuffer')) group by 1
union all select label, count(*) from ann where not (label like 'p%' and not ends_with(label, '_sopbuffer')) group by 1""")
def segment_adaptive(spark: SparkSession, d: str) -> DataFrame:
    return windows.windows_adaptive(A.annotations(spark, d), 2.0, 50_000.0).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {A.ALL}, {A.chopped_sql('res')} select {_OUT} from chop")
def chop_windows(spark: SparkSession, d: str) -> DataFrame:
    return _master(annotate.chop(annotate.resolve_overlaps(_mixed(spark, d)[0]), A.WINDOW))


@query(f"with {A.ALL}, {A.chopped_sql('res')}, {A.placed_sql('chop')} select {_OUT} from placed")
def master_pipeline(spark: SparkSession, d: str) -> DataFrame:
    config = MasterConfig(preictal=A.PREICTAL, buffer=A.BUFFER, postictal=A.POSTICTAL, window=A.WINDOW, tags=A.TAGS)
    return _master(build_master(A.annotations(spark, d), A.layouts(spark, d), config))


# Sample numbers


@query(f"""
with {A.ANN}, {A.LAY}, o as (select edf_path, session_key, (offset_s * 256)::bigint as a, (offset_s * 256)::bigint + floor(duration_s * 256)::bigint as b from lay)
select ann.n as master_id, least(greatest(a + round_even(start_time * 256, 0)::bigint, a), b) as start_sample, least(greatest(a + round_even(stop_time * 256, 0)::bigint, a), b) as stop_sample from ann join o using (edf_path)""")
def time_to_sample(spark: SparkSession, d: str) -> DataFrame:
    lay = A.layouts(spark, d).select("edf_path", F.bround(F.col("offset_s") * 256).cast("long").alias("a")).join(A.layouts(spark, d).select("edf_path", F.floor(F.col("duration_s") * 256).alias("n")), "edf_path")
    met = A.annotations(spark, d).join(lay, "edf_path").withColumn("b", F.col("a") + F.col("n"))
    at = lambda c: samples.time_to_sample(F.col(c), F.col("a"), F.col("b"), 256.0)
    return met.select(F.col("_seq.n").alias("master_id"), at("start_time").alias("start_sample"), at("stop_time").alias("stop_sample"))


@query("select segment_id, seg_start_sample, round_even(seg_start_sample * (250.0::double / 256.0::double), 0)::bigint as rescaled from (select distinct segment_id, seg_start_sample from segments)")
def rescale_index(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "segments").select("segment_id", "seg_start_sample").distinct()
    return s.withColumn("rescaled", samples.rescaled_index(F.col("seg_start_sample"), 256.0, 250.0))


@query("""
with r as (select edf_path, min(session_key) as session_key, max(case when not isnan(duration) then floor(duration * 256)::bigint end) as n from recordings where edf_path is not null and session_key is not null group by 1)
select edf_path, session_key, sum(coalesce(n, 0)) over w - coalesce(n, 0) as start_sample, sum(coalesce(n, 0)) over w as end_sample from r window w as (partition by session_key order by edf_path rows between unbounded preceding and current row)""")
def sample_offsets(spark: SparkSession, d: str) -> DataFrame:
    return signals.sample_offsets(_sample_counts(spark, d))


def _sample_counts(spark: SparkSession, d: str) -> DataFrame:
    n = F.max(F.when(~F.isnan("duration"), F.floor(F.col("duration") * 256)))
    return table(spark, d, "recordings").where("edf_path is not null and session_key is not null").groupBy("edf_path").agg(F.min("session_key").alias("session_key"), n.alias("samples"))


@query(ORACLES["sample_offsets"])
def offsets_json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    return tables.offsets_from_json(tables.offsets_json(signals.sample_offsets(_sample_counts(spark, d))))


@query("""
with s as (select distinct session_key from sessions), raw as (select distinct session_key from recordings where native_sfreq = 256), proc as (select distinct session_key from segments)
select session_key from s where not (session_key in (select session_key from raw where session_key is not null) and session_key in (select session_key from proc where session_key is not null))""")
def checkpoint_resume(spark: SparkSession, d: str) -> DataFrame:
    sessions = table(spark, d, "sessions").select("session_key").distinct()
    raw = table(spark, d, "recordings").where("native_sfreq = 256").select("session_key", F.lit("raw").alias("stage"))
    proc = table(spark, d, "segments").select("session_key", F.lit("proc").alias("stage"))
    return tables.to_resume(sessions, raw.unionByName(proc).distinct(), with_montage=True)


# Arrays of samples

_SEG = "sg as (select distinct on (segment_id) segment_id, segment from segments where segment is not null)"


def _segments(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "segments").where("segment_id is not null and segment is not null")
    return s.select("segment_id", "master_id", "edf_path", "label", "segment").dropDuplicates(["segment_id"])


def _measured(df: DataFrame) -> DataFrame:
    """Number, sum and first reading of pieces, so that results stay small."""
    total = F.aggregate("segment", F.lit(0.0), lambda a, x: a + F.coalesce(F.when(F.abs(x) < 1e6, x.cast("double")), F.lit(0.0)))
    return df.withColumns({"n": F.size("segment"), "total": F.round(total, 3) + F.lit(0.0)}).drop("segment")


@query(f"""
with {_SEG}, p as (select segment_id, i * 32 as seg_start_sample, segment[i * 32 + 1 : i * 32 + 32] as x from (select *, unnest(range(0, case when len(segment) >= 32 then (len(segment) - 32) // 32 + 1 else 0 end)) as i from sg))
select segment_id, seg_start_sample, len(x) as n, round(coalesce(list_sum(list_transform(x, lambda v: case when abs(v::double) < 1e6 then v::double else 0.0 end)), 0), 3) + 0.0 as total from p""")
def array_windows_fixed(spark: SparkSession, d: str) -> DataFrame:
    return _measured(signals.segment_fixed(_segments(spark, d).select("segment_id", "segment"), "segment", 32))


@query(f"""
with {_SEG}, p as (select segment_id, i * 16 as seg_start_sample, segment[i * 16 + 1 : i * 16 + 64] as x from (select *, unnest(range(0, case when len(segment) >= 64 then (len(segment) - 64) // 16 + 1 else 0 end)) as i from sg))
select segment_id, seg_start_sample, len(x) as n, round(coalesce(list_sum(list_transform(x, lambda v: case when abs(v::double) < 1e6 then v::double else 0.0 end)), 0), 3) + 0.0 as total from p""")
def array_windows_sliding(spark: SparkSession, d: str) -> DataFrame:
    return _measured(signals.segment_fixed(_segments(spark, d).select("segment_id", "segment"), "segment", 64, 16))


@query("""
with sg as (select distinct on (segment_id) segment_id, len(segment) as len, label from segments where segment is not null),
t as (select sum(len) filter (where starts_with(label, 'p')) as pre, sum(len) filter (where label = 'interictal') as inter from sg)
select pre, inter, case when inter / pre <= 0 then 64 else least(greatest(trunc(64 / (inter / pre))::int, 1), 64) end as step from t""")
def adaptive_step(spark: SparkSession, d: str) -> DataFrame:
    n = F.size("segment")
    t = _segments(spark, d).agg(F.sum(F.when(F.col("label").startswith("p"), n)).alias("pre"), F.sum(F.when(F.col("label") == "interictal", n)).alias("inter"))
    return t.withColumn("step", signals.adaptive_step(F.col("pre"), F.col("inter"), 64))


@query(f"""
with {A.VEC}, p as (select recording, channel, i as epoch, samples[i * 16 + 1 : i * 16 + 16] as x from (select *, unnest(range(0, len(samples) // 16)) as i from vec))
select recording, channel, epoch, len(x) as n, round(list_sum(x), 3) + 0.0 as total from p""")
def epochs(spark: SparkSession, d: str) -> DataFrame:
    return _measured(signals.epochs(A.channels_of_vectors(spark, d), "samples", 16.0))


_PAIRS = ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(schema.PAIRS))


@query(f"""
with {A.VEC}, pr(pair, a, b) as (values {_PAIRS}), x as (select l.recording, pair, a || '-' || b as name, l.samples as sa, r.samples as sb from pr join vec l on l.channel = a join vec r on r.channel = b and r.recording = l.recording)
select recording, pair, name, list_transform(range(1, len(sa) + 1), lambda i: round(sa[i] - sb[i], 6) + 0.0) as samples from x""")
def bipolar_montage(spark: SparkSession, d: str) -> DataFrame:
    out = signals.montage(A.channels_of_vectors(spark, d), ["recording"])
    return out.withColumn("samples", F.transform("samples", _plain))


# Artifact masks

_PROBS = "list_value(list_transform(samples[1:3], lambda v: abs(v)), list_transform(samples[4:6], lambda v: abs(v)))"
_MASK = f"""
pb as (select *, {_PROBS} as probs from vec),
fl2 as (select *, list_transform(probs, lambda p: list_position(p, list_max(p)) > 1) as flag from pb),
mk as (select *, list_transform(range(0, 64), lambda i: coalesce(flag[i // 32 + 1], false)) as mask from fl2)"""
_DOTS = "dt as (select recording, channel, samples, list_transform(samples, lambda v: v > 0.1) as mask from vec)"


def _probs(df: DataFrame) -> DataFrame:
    part = lambda a: F.transform(F.slice("samples", a, 3), F.abs)
    return df.withColumn("probs", F.array(part(1), part(4)))


def _masked(spark: SparkSession, d: str) -> DataFrame:
    df = _probs(A.channels_of_vectors(spark, d))
    return df.withColumn("mask", signals.mask_of(F.col("probs"), F.size("samples"), 16.0))


def _dotted(spark: SparkSession, d: str) -> DataFrame:
    return A.channels_of_vectors(spark, d).withColumn("mask", F.transform("samples", lambda v: v > 0.1))


@query(f"with {A.VEC}, {_MASK} select recording, channel, list_transform(mask, lambda m: m::int) as mask from mk")
def artifact_mask(spark: SparkSession, d: str) -> DataFrame:
    return _masked(spark, d).select("recording", "channel", F.transform("mask", lambda m: m.cast("int")).alias("mask"))


@query(f"with {A.VEC}, {_MASK} select recording, channel, list_transform(range(1, 65), lambda i: case when mask[i] then 0.0 else round(samples[i], 6) end) as samples from mk")
def zero_mask(spark: SparkSession, d: str) -> DataFrame:
    fixed = signals.repair(_masked(spark, d), "samples", "mask", "zero")
    return fixed.select("recording", "channel", F.transform("samples", lambda x: F.round(x, 6)).alias("samples"))


@query(f"""
with {A.VEC}, {_DOTS}, u as (select recording, channel, i, samples[i] as y, mask[i] as m from (select *, unnest(range(1, 65)) as i from dt)),
nb as (select *, last_value(case when not m then i end ignore nulls) over (partition by recording, channel order by i rows between unbounded preceding and current row) as i0, first_value(case when not m then i end ignore nulls) over (partition by recording, channel order by i rows between current row and unbounded following) as i1 from u),
j as (select nb.*, a.y as y0, b.y as y1 from nb left join u a on a.recording = nb.recording and a.channel = nb.channel and a.i = nb.i0 left join u b on b.recording = nb.recording and b.channel = nb.channel and b.i = nb.i1)
select recording, channel, list(round(case when i0 is null and i1 is null then y when i0 is null then y1 when i1 is null or i0 = i1 then y0 else y0 + (y1 - y0) * (i - i0) / (i1 - i0) end, 6) order by i) as samples, bool_and(m) as fully_flagged from j group by 1, 2""")
def interp_mask(spark: SparkSession, d: str) -> DataFrame:
    fixed = signals.repair(_dotted(spark, d), "samples", "mask", "interpolate")
    return fixed.select("recording", "channel", F.transform("samples", lambda x: F.round(x, 6)).alias("samples"), "fully_flagged")


@query(f"""
with {A.VEC}, {_DOTS}, u as (select recording, channel, i, mask[i + 1] as m from (select *, unnest(range(0, 64)) as i from dt)),
g2 as (select *, i - row_number() over (partition by recording, channel, m order by i) as k from u)
select recording, channel, min(i)::int as span_start, max(i)::int + 1 as span_stop from g2 where m group by recording, channel, k""")
def mask_spans(spark: SparkSession, d: str) -> DataFrame:
    return signals.spans(_dotted(spark, d).select("recording", "channel", "mask"), "mask")


@query(f"with {A.VEC}, {_MASK}, u as (select recording, unnest(probs) as p from mk) select recording, round(avg(p[2] + p[3]), 6) as artifact_fraction, count(*) as windows from u group by 1")
def artifact_fraction(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(signals.artifact_fraction(_probs(A.channels_of_vectors(spark, d)), ["recording"]), "artifact_fraction")


@query(f"with {A.VEC}, {_DOTS} select recording, round(100 * avg(list_sum(list_transform(mask, lambda m: m::int)) / 64.0), 6) as percent_flagged, count(*) filter (where list_bool_and(mask)) as fully_flagged from dt group by 1")
def percent_flagged(spark: SparkSession, d: str) -> DataFrame:
    share = F.size(F.filter("mask", lambda m: m)) / F.size("mask")
    return _dotted(spark, d).groupBy("recording").agg(F.round(F.avg(share) * 100, 6).alias("percent_flagged"), F.count_if(F.forall("mask", lambda m: m)).alias("fully_flagged"))


@query(f"""
with {A.ANN}, {A.VEC}, {_DOTS}, {A.LAST}, e as (select n as master_id, n % recordings as recording, label, start_time / 40 as s, stop_time / 40 as t from ann, last),
c as (select e.*, channel, mask, least(greatest(round_even(s * 16, 0)::int, 0), 64) as a, least(greatest(round_even(t * 16, 0)::int, 0), 64) as b from e join dt using (recording))
select master_id, recording, channel, label, a as first_sample, b as last_sample, round(100.0 * list_sum(list_transform(mask[a + 1 : b], lambda m: m::int)) / (b - a), 1) as overlap_percent, lower(label) = 'bckg' as is_background from c where b > a""")
def event_mask_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Every row on the recording of its number, over all recordings, against every channel."""
    masks = _dotted(spark, d).drop("samples")
    met = signals.event_overlap(_events_of(spark, d, masks), masks, ["recording"], 16.0)
    return met.select("master_id", "recording", "channel", "label", "first_sample", "last_sample", "overlap_percent", "is_background")


def _events_of(spark: SparkSession, d: str, vectors: DataFrame) -> DataFrame:
    rows = A.onto_recordings(A.annotations(spark, d), vectors)
    return rows.select(F.col("_seq.n").alias("master_id"), "recording", "label", (F.col("start_time") / 40).alias("start_time"), (F.col("stop_time") / 40).alias("stop_time"))


@query(f"""
with {A.ANN}, {A.VEC}, {_DOTS}, {A.LAST}, e as (select n as master_id, n % recordings as recording, label, start_time / 40 as s, stop_time / 40 as t from ann, last),
c as (select recording, channel, label, list_sum(list_transform(mask[a + 1 : b], lambda m: m::int)) as hit from (select e.*, channel, mask, least(greatest(round_even(s * 16, 0)::int, 0), 64) as a, least(greatest(round_even(t * 16, 0)::int, 0), 64) as b from e join dt using (recording)) where b > a)
select recording, channel, count(*) as events, count(*) filter (where hit > 0) as overlapping, count(*) filter (where lower(label) = 'bckg') as background, count(*) filter (where lower(label) = 'bckg' and hit > 0) as background_overlapping from c group by 1, 2""")
def event_overlap_counters(spark: SparkSession, d: str) -> DataFrame:
    return signals.overlap_counters(event_mask_overlap(spark, d), ["recording", "channel"])


@query(f"""
with {A.VEC}, {_DOTS}, pr(pair, a, b) as (values {_PAIRS})
select l.recording, a || '-' || b as name, list_transform(range(1, 65), lambda i: (l.mask[i] or r.mask[i])::int) as mask from pr join dt l on l.channel = a join dt r on r.channel = b and r.recording = l.recording""")
def mask_or(spark: SparkSession, d: str) -> DataFrame:
    out = signals.pair_masks(_dotted(spark, d).drop("samples"), ["recording"])
    return out.select("recording", "name", F.transform("mask", lambda m: m.cast("int")).alias("mask"))


# Channel names


@query("""
select distinct channel, regexp_replace(regexp_replace(regexp_replace(upper(regexp_replace(channel, '^\\s+|\\s+$', '', 'g')), '^(EEG|EKG|ECG)\\s+', ''), '-(REF|LE|AR|AVG|CZ)\\d*$', ''), '\\s+', '', 'g') as normalized,
  case when contains(trim(channel), '-') and trim(split_part(trim(channel), '-', 1)) <> '' and trim(substr(trim(channel), strpos(trim(channel), '-') + 1)) <> '' then trim(split_part(trim(channel), '-', 1)) end as side_a,
  case when contains(trim(channel), '-') and trim(split_part(trim(channel), '-', 1)) <> '' and trim(substr(trim(channel), strpos(trim(channel), '-') + 1)) <> '' then trim(substr(trim(channel), strpos(trim(channel), '-') + 1)) end as side_b
from master_full where channel is not null""")
def channel_names(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("channel")
    rows = table(spark, d, "master_full").where("channel is not null").select("channel").distinct()
    side = channels.bipolar_sides(c)
    return rows.select("channel", channels.normalized(c).alias("normalized"), side["a"].alias("side_a"), side["b"].alias("side_b"))


@query()
def channel_match_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "master_full").where("edf_path is not null and channel is not null")
    present = rows.select("edf_path", F.explode(F.split(F.upper("channel"), "-")).alias("channel")).distinct()
    return match.match_channels(rows.select("edf_path", "channel").distinct(), present, ["edf_path"])


@query(f"""
with {A.ANN}, {A.VEC}, {A.LAST}, w as (select distinct n % recordings as recording, channel as name from ann, last where contains(channel, '-')), s as (select *, split_part(name, '-', 1) as a, split_part(name, '-', 2) as b from w)
select s.recording, name, list_transform(range(1, 65), lambda i: round(l.samples[i] - r.samples[i], 6) + 0.0) as samples from s join vec l on l.recording = s.recording and l.channel = a join vec r on r.recording = s.recording and r.channel = b""")
def derived_channels(spark: SparkSession, d: str) -> DataFrame:
    """Over all recordings, by equal names."""
    v = A.channels_of_vectors(spark, d)
    return match.derive_missing(_wanted(spark, d, v), v, ["recording"], cutoff=1.0).withColumn("samples", F.transform("samples", _plain))


@query()
def derived_channels_all(spark: SparkSession, d: str) -> DataFrame:
    """derived_channels by likely names too; names that lack a source have null samples."""
    v = A.channels_of_vectors(spark, d)
    return match.derive_missing(_wanted(spark, d, v), v, ["recording"], unresolved=True).withColumn("samples", F.transform("samples", _plain))


def _wanted(spark: SparkSession, d: str, vectors: DataFrame) -> DataFrame:
    return A.onto_recordings(A.annotations(spark, d), vectors).select("recording", "channel").distinct()


# Spectra and filters


@query(f"""
with {A.VEC}, p as (select recording, channel, i as freq, abs(samples[i]) as psd from (select *, unnest(range(1, 65)) as i from vec)),
s as (select *, psd / (sum(psd) over (partition by recording, channel) + 1e-10) as share from p),
f as (select recording, freq, avg(share) as mean_power, stddev_pop(share) / avg(share) as cv from s group by 1, 2)
select recording, freq::double as freq, round(mean_power, 8) as mean_power, round(cv, 6) as cv, round(quantile_cont(mean_power, 0.8) over (partition by recording), 8) as line from f""")
def cv_by_bin(spark: SparkSession, d: str) -> DataFrame:
    p = A.channels_of_vectors(spark, d).select("recording", "channel", F.posexplode("samples").alias("k", "v")).select("recording", "channel", (F.col("k") + 1.0).alias("freq"), F.abs("v").alias("psd"))
    out = dsp.noise_profile(p, ["recording"], ["channel"]).withColumn("line", F.percentile("mean_power", F.lit(0.8)).over(Window.partitionBy("recording")))
    return out.select("recording", "freq", F.round("mean_power", 8).alias("mean_power"), F.round("cv", 6).alias("cv"), F.round("line", 8).alias("line"))


@query(f"""
with recursive {A.VEC}, l as (select recording, channel, list_sort(list_distinct(list_transform(samples, lambda v: round(abs(v) * 100)))) as f from vec),
st(recording, channel, f, i, anchor, total, n, out) as (
  select recording, channel, f, 1, f[1], f[1], 1, []::double[] from l
  union all select recording, channel, f, i + 1, case when f[i + 1] - anchor < 2 then anchor else f[i + 1] end, case when f[i + 1] - anchor < 2 then total + f[i + 1] else f[i + 1] end, case when f[i + 1] - anchor < 2 then n + 1 else 1 end, case when f[i + 1] - anchor < 2 then out else list_append(out, total / n) end from st where i < len(f))
select recording, channel, list_transform(list_append(out, total / n), lambda x: round(x, 6)) as freqs from st where i = len(f)""")
def freq_grouping(spark: SparkSession, d: str) -> DataFrame:
    freqs = F.array_sort(F.array_distinct(F.transform("samples", lambda v: F.round(F.abs(v) * 100))))
    return A.channels_of_vectors(spark, d).select("recording", "channel", F.transform(dsp.group_frequencies(freqs), lambda x: F.round(x, 6)).alias("freqs"))


def _sources(spark: SparkSession, d: str) -> DataFrame:
    return _segments(spark, d).select("segment_id", "edf_path", F.col("segment").cast("array<double>").alias("segment"))


@query()
def psd_welch(spark: SparkSession, d: str) -> DataFrame:
    return dsp.psd(_sources(spark, d), ["edf_path", "segment_id"], "segment", 256.0)


@query()
def noise_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return dsp.noise_frequencies(psd_welch(spark, d), ["edf_path"], ["segment_id"], variance=1.0)


@query()
def notch(spark: SparkSession, d: str) -> DataFrame:
    return dsp.notch(dsp.mended(_sources(spark, d), "segment", 16), "segment", 256.0, [60.0])


@query()
def bandpass(spark: SparkSession, d: str) -> DataFrame:
    return dsp.bandpass(dsp.mended(_sources(spark, d), "segment", 2), "segment", 256.0)


@query()
def filter_interval(spark: SparkSession, d: str) -> DataFrame:
    return dsp.filter_interval(dsp.mended(_sources(spark, d), "segment"), "segment", 256.0, 0.125, 0.375, "band", (0.5, 100.0))


@query()
def resample_fft(spark: SparkSession, d: str) -> DataFrame:
    return dsp.resample(dsp.mended(_sources(spark, d), "segment"), "segment", 256.0, 250.0, "fft")


@query()
def resample_poly(spark: SparkSession, d: str) -> DataFrame:
    return dsp.resample(dsp.mended(_sources(spark, d), "segment"), "segment", 256.0, 250.0, "poly")


@query()
def session_concat(spark: SparkSession, d: str) -> DataFrame:
    """Vectors as recordings of sessions of four files each, filtered and on one rate."""
    v = A.channels_of_vectors(spark, d)
    rows = v.select((F.floor(F.col("recording") / 4)).cast("string").alias("session_key"), F.lpad(F.col("recording").cast("string"), 8, "0").alias("edf_path"), "channel", F.lit(16.0).alias("sfreq"), "samples")
    placed, _ = session_signals(rows, 0.5, 6.0, target=32.0)
    return placed


@query(f"""
with {A.VEC}, {A.ANN}, {A.LAST}, b as (select (recording // 4)::varchar as session_key, channel, (recording % 4) * 64 as first, samples from vec),
o as (select distinct (recording // 4)::varchar as session_key, recording, (recording % 4) * 64 as a, (recording % 4) * 64 + 64 as z from vec),
e as (select distinct n % recordings as recording, label, is_valid, start_time / 40 as s, stop_time / 40 as t from ann, last where is_valid),
c as (select e.*, session_key, least(greatest(a + round_even(s * 16, 0)::bigint, a), z) as p, least(greatest(a + round_even(t * 16, 0)::bigint, a), z) as q, a from e join o using (recording))
select c.recording, c.session_key, channel, label, round(s, 6) as start_time, round(t, 6) as stop_time, p as seg_start_sample, q - p as n, round(list_sum(samples[p - a + 1 : q - a]), 3) + 0.0 as total from c join b on b.session_key = c.session_key and b.first = a where q > p""")
def extract_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every row on the recording of its number, over all recordings."""
    v = A.channels_of_vectors(spark, d)
    key = F.floor(F.col("recording") / 4).cast("string")
    first = (F.col("recording") % 4 * 64).cast("long")
    blocks = v.select(key.alias("session_key"), "channel", first.alias("start_sample"), "samples")
    offsets = v.select("recording").distinct().select(F.col("recording").cast("string").alias("edf_path"), key.alias("session_key"), first.alias("start_sample"), (first + 64).alias("end_sample"))
    rows = A.onto_recordings(A.annotations(spark, d), v).withColumns({"edf_path": F.col("recording").cast("string"), "start_time": F.col("start_time") / 40, "stop_time": F.col("stop_time") / 40}).drop("recording")
    cut = signals.extract(rows, offsets, blocks, 16.0)
    out = _measured(cut.withColumnRenamed("samples", "segment"))
    return _rounded(out.select(F.col("edf_path").cast("long").alias("recording"), "session_key", "channel", "label", *_TIMES, "seg_start_sample", "n", "total"), *_TIMES)


# Sessions, files and sinks


@query(f"""
with {A.ANN} select edf_path, channel, start_time, stop_time, label from ann where label not in ('bckg')""")
def reliable_rows(spark: SparkSession, d: str) -> DataFrame:
    """Without labels that do not count as reliable cover."""
    return A.annotations(spark, d).where(labels.is_reliable(F.col("label"))).select("edf_path", "channel", "start_time", "stop_time", "label")


@query("""
with s as (select distinct session_key from sessions where session_key is not null),
r as (select session_key, count(distinct edf_path) as files, count(distinct case when duration is not null and not isnan(duration) then edf_path end) as readable, count(distinct case when native_sfreq is null or isnan(native_sfreq) then edf_path end) as no_rate from recordings where edf_path is not null group by 1)
select session_key, coalesce(files, 0) as files, coalesce(readable, 0) as readable, case when files is null then 'no_edf' when readable < files then 'unreadable' when no_rate > 0 then 'no_rate' else 'success' end as status from s left join r using (session_key)""")
def session_status(spark: SparkSession, d: str) -> DataFrame:
    sessions = table(spark, d, "sessions").where("session_key is not null").select("session_key").distinct()
    return source.session_status(sessions, table(spark, d, "recordings"))


def _annotation_texts(spark: SparkSession, d: str) -> DataFrame:
    """The rows of master_full as the texts of annotation files, with a comment, a header of their own order and a bad row."""
    a = A.annotations(spark, d).where("csv_path is not null")
    line = F.concat_ws(",", "label", "channel", "start_time", "stop_time", F.coalesce(F.col("confidence").cast("string"), F.lit("")))
    lines = a.select("csv_path", F.col("_seq.n").alias("n"), line.alias("line")).groupBy("csv_path").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]).alias("lines"))
    head = F.array(F.lit("# montage_file = maps/two_sided.txt"), F.lit("Label, channel, START_time, stop_time, confidence"))
    return lines.select("csv_path", F.array_join(F.concat(head, "lines", F.array(F.lit("seiz,FP1-F7,soon,later,"))), chr(10)).alias("value"))


@query(f"""
with {A.ANN}, c as (select *, regexp_replace(csv_path, '[^/]*$', '') || replace(regexp_extract(csv_path, '[^/]*$'), '.csv', '.edf') as rec from ann where csv_path is not null)
select csv_path, rec as edf_path, channel, start_time, stop_time, label, confidence, true as is_valid, -1 as status from c where rec in (select edf_path from recordings where edf_path is not null)""")
def csv_scan(spark: SparkSession, d: str) -> DataFrame:
    """Annotation files read again from their texts, as rows of the master table."""
    rows = source.annotation_rows(_annotation_texts(spark, d))
    there = table(spark, d, "recordings").where("edf_path is not null").select(F.col("edf_path").alias("path"))
    return source.master_rows(rows, there).select("csv_path", "edf_path", "channel", "start_time", "stop_time", "label", "confidence", "is_valid", "status")


@query(f"with {A.ANN} select csv_path, 'maps/two_sided.txt' as montage_file, count(*) as rows, 1 as skipped from ann where csv_path is not null group by 1")
def csv_files(spark: SparkSession, d: str) -> DataFrame:
    """What each annotation file names as its montage, its rows and the rows that do not parse."""
    return source.annotation_files(_annotation_texts(spark, d))


_WIDE = ", ".join(f"round(max(case when channel = '{c}' then samples[i] end), 6) + 0.0 as {c}" for c in schema.CHANNELS)


@query(f"with {A.VEC} select recording, (i - 1)::bigint as sample, {_WIDE} from (select *, unnest(range(1, 65)) as i from vec) group by recording, i")
def wide_recordings(spark: SparkSession, d: str) -> DataFrame:
    """A column a channel and a row a sample, written as Parquet and read again."""
    import uuid

    where = f"{scratch(spark)}/wide-{uuid.uuid4().hex}"
    out = tables.write_wide(A.channels_of_vectors(spark, d), where, ["recording"])
    return out.select("recording", "sample", *[_plain(F.col(c)).alias(c) for c in schema.CHANNELS])


@query("select coalesce(label, '') as label, count(*) as segments from (select distinct on (segment_id) * from segments where segment_id is not null and segment is not null order by segment_id) group by 1")
def segments_by_label(spark: SparkSession, d: str) -> DataFrame:
    """Segments written in a folder for each label and read again."""
    import uuid

    where = f"{scratch(spark)}/by-label-{uuid.uuid4().hex}"
    tables.write_by_label(_segments(spark, d), where)
    return spark.read.parquet(where).groupBy(F.coalesce("label", F.lit("")).alias("label")).agg(F.count(F.lit(1)).alias("segments"))



@query("select count(*) as rows, true as verified, 0 as differing from (select distinct segment_id from segments where segment_id is not null and segment is not null)")
def parquet_convert_verify(spark: SparkSession, d: str) -> DataFrame:
    import uuid

    where = f"{scratch(spark)}/converted-{uuid.uuid4().hex}"
    return tables.convert_verified(_segments(spark, d).select("segment_id", F.col("segment").cast("array<double>").alias("segment")), where, ["segment_id"], "segment")


@query(f"with {A.ANN} select {_OUT} from ann")
def master_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    import uuid

    where = f"{scratch(spark)}/master-{uuid.uuid4().hex}"
    tables.write_master(A.annotations(spark, d), where)
    return _master(tables.read_master(spark, where))


@query(f"with {A.VEC} select recording, channel, list_transform(list_filter(range(0, 64), lambda i: i % 7 = 0), lambda i: round(samples[i + 1], 6)) as samples from vec")
def decimate(spark: SparkSession, d: str) -> DataFrame:
    """Every k-th sample so that at most ten are left."""
    step = F.ceil(F.size("samples") / F.lit(10)).cast("int")
    kept = F.filter("samples", lambda x, i: i % step == 0)
    return A.channels_of_vectors(spark, d).select("recording", "channel", F.transform(kept, lambda x: F.round(x, 6)).alias("samples"))


@query("select edf_path from (select distinct edf_path from recordings where edf_path is not null) order by md5(edf_path || '#42'), edf_path limit 5")
def sample_files(spark: SparkSession, d: str) -> DataFrame:
    """Five recordings drawn by hash, the same ones each time."""
    files = table(spark, d, "recordings").where("edf_path is not null").select("edf_path").distinct()
    return files.orderBy(F.md5(F.concat(F.col("edf_path"), F.lit("#42")).cast("binary")), "edf_path").limit(5)
