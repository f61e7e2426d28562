import random

import pytest

from spanloom.operators import coverage


def by_hand(intervals):
    out, periods = [], []
    for a, b in sorted(intervals):
        if periods and a <= periods[-1][1]:
            periods[-1][1] = max(periods[-1][1], b)
        else:
            periods.append([a, b])
    out += [("period", a, b) for a, b in periods]
    out += [("gap", p[1], q[0]) for p, q in zip(periods, periods[1:])]  # noqa: B905
    return sorted(out)


@pytest.mark.parametrize("block_rows", [10**6, 20])
def test_against_merge_by_hand(spark, block_rows):
    rng = random.Random(3)
    data = []
    for key in ("a", "b", "c"):
        for _ in range(300 if key == "a" else 30):
            s = rng.randrange(4000)
            data.append((key, s, s + rng.choice([1, 5, 40]), 0, "x"))
    data += [("a", 5, 5, 0, "x"), ("d", 3, 1, 0, "x"), (None, 1, 2, 0, "x"), ("e", None, 2, 0, "x"), ("a", 0, 4500, 1, "x")][:4]
    df = spark.createDataFrame(data, "key string, s long, e long, kind int, `from` string")
    got = {}
    for r in coverage.periods_and_gaps(df, ["key"], "s", "e", block_rows).collect():
        got.setdefault(r["key"], []).append((r["kind"], r["from"], r["to"]))
    want = {k: by_hand([(s, e) for key, s, e, *_ in data if key == k and s is not None and e > s]) for k in "abc"}
    assert {k: sorted(v) for k, v in got.items()} == want


def test_labels_and_times(spark, rows):
    data = [("p", " FNSZ\t", 0.0004, 1.0), ("p", "fnsz", 1.0000001, 2.0), ("p", "fnsz", 3.0, float("nan")), ("p", "fnsz", 5.0, 6.0), ("p", None, 1.0, 2.0), (None, "fnsz", 1.0, 2.0), ("p", "fnsz", 8.0, 8.0000001)]
    df = spark.createDataFrame(data, "edf_path string, label string, start_time double, stop_time double")
    assert rows(coverage.labelled_coverage(df)) == [("p", "fnsz", "gap", 2000, 5000), ("p", "fnsz", "period", 0, 2000), ("p", "fnsz", "period", 5000, 6000)]
    assert coverage.labelled_coverage(df.limit(0)).count() == 0
