"""Queries of the training-text problems, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import abuse, mixing, splits, tokenizer
from spanloom.session import materialize, table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.spread_sessions(table(spark, d, "sessions"), table(spark, d, "patient_alias"))


def p2_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.assign(table(spark, d, "sessions"), table(spark, d, "patient_alias"))


def p2_shares(spark: SparkSession, d: str) -> DataFrame:
    return splits.reached(p2_splits(spark, d))


def p2_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of p2_splits: every session once, no person in two splits, no split a session or more off its quota."""
    dealt = p2_splits(spark, d)
    keys = dealt.groupBy("session_key").agg(F.count(F.lit(1)).alias("n"))
    of = dealt.groupBy("person").agg(F.count_distinct("split").alias("n"))
    by = keys.agg(F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("n") > 1).alias("repeated"))
    off = splits.reached(dealt).agg((F.max(F.abs(F.col("sessions") - F.col("target") * F.col("sessions") / F.col("share"))) < 1).alias("within_a_session"))
    return by.crossJoin(of.agg(F.count_if(F.col("n") > 1).alias("persons_apart"))).crossJoin(off)  # of one row each


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.token_ids(table(spark, d, "documents"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.reached(p7_mix(spark, d), table(spark, d, "mix_targets"))


def p7_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of p7_mix: no use of a document twice in a pass or beyond its source's cap, no share more than a document off its target."""
    targets = table(spark, d, "mix_targets")
    mixed = materialize(p7_mix(spark, d), "mixed")
    twice = mixed.groupBy("doc_id", "repeat").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("twice"))
    told = mixing.reached(mixed, targets)
    within = told.agg(F.count(F.lit(1)).alias("sources"), F.count_if(F.col("most_uses") > F.col("max_repeats")).alias("over_cap"), F.max(F.abs(F.col("actual_share") - F.col("target_share"))).alias("_off"), F.sum("tokens").alias("_all"))
    largest = mixed.agg(F.max("tokens").alias("_largest"))
    return within.crossJoin(twice).crossJoin(largest).select("sources", "twice", "over_cap", (F.col("_off") <= F.col("_largest") / F.col("_all")).alias("shares_met"))  # of one row each


def p8_scores(spark: SparkSession, d: str) -> DataFrame:
    return abuse.scores(table(spark, d, "documents"), ["doc_id", "source"])


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_scores(spark, d).where(f"score >= {abuse.THRESHOLD}").select("doc_id")


def p8_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse.rates(p8_scores(spark, d))


QUERIES = {f.__name__: f for f in (p2_found, p2_splits, p2_shares, p2_invariants, p6_ids, p7_mix, p7_shares, p7_invariants, p8_found, p8_scores, p8_rates)}

ORACLES = {
    "p7_invariants": "select count(*) as sources, 0 as twice, 0 as over_cap, true as shares_met from mix_targets",
    "p2_invariants": "select count(distinct session_key) as sessions, 0 as repeated, 0 as persons_apart, true as within_a_session from sessions",
    "p2_found": r"""
with recursive s as (
  select session_key, coalesce(
      case when lower(trim(split, ' ' || chr(9))) in ('train', 'trn', 'training') then 'train' when lower(trim(split, ' ' || chr(9))) in ('dev', 'vld', 'validation') then 'dev' when lower(trim(split, ' ' || chr(9))) in ('eval', 'tst', 'test') then 'eval' end,
      case session_key[1:3] when 'trn' then 'train' when 'vld' then 'dev' when 'tst' then 'eval' end) as split,
    coalesce(try_cast(nullif(regexp_extract(patient_id, '([0-9]+)', 1), '') as bigint), try_cast(regexp_extract(split_part(session_key, '_', 2), '([0-9]+)', 1) as bigint)) as n
  from sessions),
e0 as (select try_cast(regexp_extract(old_id, '([0-9]+)', 1) as bigint) as a, try_cast(regexp_extract(new_id, '([0-9]+)', 1) as bigint) as b from patient_alias),
e as (select a, b from e0 where a is not null and b is not null union select b, a from e0 where a is not null and b is not null),
reach(a, b) as (select a, b from e union select r.a, e.b from reach r join e on r.b = e.a),
root as (select a as n, least(a, min(b)) as root from reach group by 1),
p as (select session_key, split, coalesce(root, s.n) as person from s left join root using (n)),
w as (select person from p group by 1 having count(distinct split) > 1)
select distinct session_key from p join w using (person)
""",
}
