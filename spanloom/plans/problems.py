"""Queries of the general training-data problems, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators import compaction, coverage, rejects, spikes
from spanloom.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return spikes.implausible(table(spark, d, "segments"), table(spark, d, "master_full"), table(spark, d, "recordings"))


def p1_tail_fits(spark: SparkSession, d: str) -> DataFrame:
    return spikes.tail_fits(table(spark, d, "segments"), table(spark, d, "master_full"), table(spark, d, "recordings"))


def p1_sources(spark: SparkSession, d: str) -> DataFrame:
    real = lambda c: F.when(~F.isnan(c), F.round(c, 6)).alias(c)
    return p1_tail_fits(spark, d).select("edf_path", "channel", "readings", real("median"), real("spread"))


def p1_exceedances(spark: SparkSession, d: str) -> DataFrame:
    return spikes.exceedances(table(spark, d, "segments"), table(spark, d, "master_full"), table(spark, d, "recordings"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return rejects.rejected_lines(table(spark, d, "csv_bi")).select("line_id", "reason")


def p3_rows(spark: SparkSession, d: str) -> DataFrame:
    return rejects.loaded_rows(table(spark, d, "csv_bi")).select("line_id", "csv_bi_path", "start_time", "end_time", "duration")


def _consolidated(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    return compaction.consolidate_segments(table(spark, d, "segments"), table(spark, d, "segment_files"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return compaction.repeated_keys(_consolidated(spark, d)[1]).select(F.col("key").alias("segment_id"))


def p4_files(spark: SparkSession, d: str) -> DataFrame:
    return compaction.file_sizes(_consolidated(spark, d)[1])


def p4_totals(spark: SparkSession, d: str) -> DataFrame:
    """Records kept and copies dropped, and whether every file keeps to its size."""
    f = p4_files(spark, d)
    return f.agg(F.sum("records").cast("long").alias("records"), F.sum("copies_dropped").cast("long").alias("copies_dropped"), F.max(F.col("bytes") <= compaction.TARGET_BYTES).alias("in_size"))


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    """Every record as it is read from the consolidated files, its readings counted and summed."""
    lines = compaction.read_consolidated(*_consolidated(spark, d))
    kinds = table(spark, d, "segments").select("segment_id", "label", "segment").schema
    r = lines.select(F.from_json("line", kinds).alias("r")).select("r.*")
    whole = F.aggregate("segment", F.lit(0.0), lambda a, x: a + F.when(F.abs(x) < 1e6, x.cast("double")).otherwise(0.0))
    return r.select("segment_id", "label", F.when(F.col("segment").isNotNull(), F.size("segment")).alias("readings"), F.round(whole, 3) + F.lit(0.0)).toDF("segment_id", "label", "readings", "total")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return coverage.labelled_coverage(table(spark, d, "master_full"))


QUERIES = {f.__name__: f for f in (p1_found, p1_tail_fits, p1_sources, p1_exceedances, p3_found, p3_rows, p4_found, p4_files, p4_totals, p4_records, p5_found)}

_NUMBER = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
_BODY = r"""
lines as (select *, regexp_replace(coalesce(line_text, ''), '\r$', '') as t from csv_bi),
body as (
  select *, regexp_full_match(t, '([^",]*|"([^"]|"")*")(,([^",]*|"([^"]|"")*"))*') as quoted_well,
         regexp_extract_all(t, '(?:^|,)("(?:[^"]|"")*"|[^",]*)', 1) as f
  from lines where line_no > 6 and not regexp_full_match(coalesce(line_text, ''), '\s*') and not starts_with(line_text, '#')),
judged as (
  select *, trim(f[2], '" ' || chr(9)) as a, trim(f[3], '" ' || chr(9)) as b, len(f) as n from body),
reasoned as (
  select *, case when not quoted_well then 'broken_quoting' when n <> 5 then 'wrong_column_count'
    when not (regexp_full_match(a, '%s') and regexp_full_match(b, '%s')) then 'invalid_value'
    when a::double < 0 or b::double < a::double then 'invalid_value' end as reason
  from judged),
heads as (
  select *, regexp_extract(t, 'duration[ \t]*=[ \t]*(%s)[ \t]*secs[ \t]*$', 1) as secs from lines where line_no = 3)
""" % (_NUMBER, _NUMBER, _NUMBER)

_READINGS = """
ch as (select master_id, min(upper(regexp_replace(channel, '\\s+', '', 'g'))) as channel from master_full group by 1),
h as (select edf_path, max(physical_min) as lo, max(physical_max) as hi, max(resolution) as res from recordings group by 1),
seg as (select distinct on (segment_id) segment_id, edf_path, master_id, segment from segments),
r0 as (select segment_id, edf_path, master_id, unnest(segment) as v, generate_subscripts(segment, 1) as i from seg),
r as (select r0.segment_id, r0.edf_path, ch.channel, i, v::double as v, res,
             isfinite(v) and v::double >= lo - abs(lo) * 1e-6 and v::double <= hi + abs(hi) * 1e-6 as ok
      from r0 left join ch using (master_id) left join h using (edf_path)),
m as (select edf_path, channel, median(v) as med from r where ok group by 1, 2),
s as (select r.edf_path, r.channel, any_value(med) as med, 1.4826 * median(abs(v - med)) as spread
      from r join m on r.edf_path = m.edf_path and r.channel is not distinct from m.channel where ok group by 1, 2)"""

ORACLES = {
    "p1_found": f"""
with {_READINGS},
f as (select r.*, coalesce(ok and abs(v - med) > 10 * spread, false) as far
      from r left join s on r.edf_path = s.edf_path and r.channel is not distinct from s.channel),
g as (select segment_id, i - row_number() over (partition by segment_id, far order by i) as run, far from f),
w as (select segment_id, res, count(v) over k as n, max(case when isfinite(v) then v end) over k as mx, min(case when isfinite(v) then v end) over k as mn,
             count(case when isfinite(v) then 1 end) over k as fin, i
      from f window k as (partition by segment_id order by i rows between 31 preceding and current row))
select distinct segment_id, 'impossible' as kind from f where v is not null and not ok
union all select distinct segment_id, 'spike' from (select segment_id, run from g where far group by 1, 2 having count(*) <= 5)
union all select distinct segment_id, 'stuck' from w where i >= 32 and fin = 32 and mx - mn <= res + 1e-6 * greatest(abs(mx), abs(mn))
""",
    "p1_sources": f"""
with {_READINGS}, k as (select distinct edf_path, channel from (select seg.edf_path, ch.channel from seg left join ch using (master_id) where segment_id is not null))
select k.edf_path, k.channel, coalesce(n, 0) as readings, round(med, 6) as median, round(spread, 6) as spread
from k left join s on k.edf_path is not distinct from s.edf_path and k.channel is not distinct from s.channel
  left join (select edf_path, channel, count(*) as n from r where ok group by 1, 2) c on k.edf_path is not distinct from c.edf_path and k.channel is not distinct from c.channel""",
    "p3_found": f"with {_BODY} select line_id, reason from reasoned where reason is not null union all select line_id, 'invalid_value' from heads where secs = '' or secs::double <= 0",
    "p3_rows": f"""with {_BODY}, d as (select csv_bi_path, max(secs::double) as duration from heads where secs <> '' and secs::double > 0 group by 1)
select line_id, csv_bi_path, a::double as start_time, b::double as end_time, duration from reasoned left join d using (csv_bi_path) where reason is null""",
    "p4_found": "select segment_id from segments group by 1 having count(*) > 1",
    "p4_totals": "select count(distinct segment_id) + count(*) filter (where segment_id is null) as records, count(segment_id) - count(distinct segment_id) as copies_dropped, true as in_size from segments",
    "p4_records": """select segment_id, label, len(segment) as readings, round(coalesce(list_sum(list_transform(segment, lambda v: case when abs(v::double) < 1e6 then v::double else 0.0 end)), case when segment is not null then 0.0 end), 3) + 0.0 as total
from (select distinct on (segment_id) * from segments where segment_id is not null order by segment_id, written_at, file_id) union all select segment_id, label, len(segment), round(list_sum(list_transform(segment, lambda v: case when abs(v::double) < 1e6 then v::double else 0.0 end)), 3) + 0.0 from segments where segment_id is null""",
    "p5_found": """
with i as (select distinct edf_path, regexp_replace(lower(label), '^\\s+|\\s+$', '', 'g') as label, round(start_time * 1000)::bigint as s, round(stop_time * 1000)::bigint as e
  from master_full where edf_path is not null and label is not null and not isnan(start_time) and not isnan(stop_time)),
v as (select *, max(e) over (partition by edf_path, label order by s, e rows between unbounded preceding and 1 preceding) as reach from i where e > s),
n as (select *, sum(case when reach is null or s > reach then 1 else 0 end) over (partition by edf_path, label order by s, e) as k from v),
p as (select edf_path, label, k, min(s) as from_ms, max(e) as to_ms from n group by 1, 2, 3)
select edf_path, label, 'period' as kind, from_ms, to_ms from p
union all select edf_path, label, 'gap', to_ms, nxt from (select *, lead(from_ms) over (partition by edf_path, label order by k) as nxt from p) where nxt is not null
""",
}
