import random

import numpy as np
import pytest

from spanloom.llm import splits

SESSIONS = "session_key string, split string, patient_id string, montage_type string, person int, extra string"


def forest(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in root}


@pytest.mark.parametrize("shape", ["random", "path", "star"])
def test_components(spark, shape):
    rng = random.Random(2)
    name = lambda i: f"n{i:04d}"
    pairs = {"random": [(rng.randrange(300), rng.randrange(300)) for _ in range(180)], "path": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 90)]}[shape]
    pairs = [(name(a), name(b)) for a, b in pairs]
    df = spark.createDataFrame([*pairs, *pairs[:5], (None, "n0001"), ("n0001", None)], "a string, b string")
    got = {r["node"]: r["root"] for r in splits.connected_components(df).collect()}
    assert got == forest(pairs)


def sessions(spark):
    data = [("trn_p00000001_s1_2000_ar1", "train", "p00000001", "ar1"), ("vld_p1_s2_2001_ar1", " Dev ", "P-0001", "ar1"), ("tst_p2_s1_2000_le2", None, None, "le2"), ("trn_p00000002_s2_2000_ar1", "TRN", " ", "ar1"), ("trn_p5_s1_2000_ar1", "train", "p5", None), ("trn_p6_s1_2000_ar1", "train", "p6", "ar1"), ("vld_p7_s1_2000_ar1", "validation", "p 7\t", "ar1"), ("trn_p8_s1_2000_ar1", "training", "p8", "ar1"), ("trn_p8_s1_2000_ar1", "train", "p8", "ar1"), (None, "train", "p9", "ar1")]
    alias = [("p6", "P0007"), ("p00000008", None), (None, "p5"), ("p8", "p8"), ("nobody", "p5")]
    return spark.createDataFrame([(*x, 1, "y") for x in data], SESSIONS), spark.createDataFrame(alias, "old_id string, new_id string")


def test_found(spark, rows):
    s, a = sessions(spark)
    want = ["trn_p00000001_s1_2000_ar1", "vld_p1_s2_2001_ar1", "tst_p2_s1_2000_le2", "trn_p00000002_s2_2000_ar1", "trn_p6_s1_2000_ar1", "vld_p7_s1_2000_ar1"]
    assert rows(splits.spread_sessions(s, a)) == sorted((x,) for x in want)
    assert splits.spread_sessions(s.limit(0), a.limit(0)).count() == 0
    assert splits.assign(s.limit(0), a.limit(0)).count() == 0


def test_assignment(spark):
    rng = random.Random(5)
    data = [(f"trn_p{p}_s{i}_x", None, f"p{p}", rng.choice(["ar1", "le2"]), 1, "y") for p in range(400) for i in range(1 + (p % 7 == 0) * 9 + p % 3)]
    data.append(("trn_p0_s0_x", None, "p3", "ar1", 1, "y"))  # one session of two patients
    df = spark.createDataFrame(data, SESSIONS)
    out = splits.assign(df, spark.createDataFrame([("p1", "p2")], "old_id string, new_id string"))
    got = out.collect()
    assert len(got) == len({r["session_key"] for r in got}) == len({x[0] for x in data})
    of = {r["session_key"]: r["split"] for r in got}
    person = forest([("1", "2"), ("0", "3")])
    by = {}
    for key, _, patient, *_ in data:
        by.setdefault(person.get(patient[1:], patient[1:]), set()).add(of[key])
    assert all(len(x) == 1 for x in by.values())
    share = {r["split"]: r["share"] for r in splits.reached(out).collect()}
    assert all(abs(share[k] - v) < 0.01 for k, v in splits.PROPORTIONS.items())


def test_allocation_meets_quotas():
    rng = random.Random(1)
    for _ in range(30):
        bundles = [(rng.randrange(1, 9), rng.randrange(1, 40)) for _ in range(rng.randrange(1, 30))]
        sent = splits.allocate(bundles, [0.8, 0.1, 0.1])
        assert all(sum(x) == n and min(x) >= 0 for x, (_, n) in zip(sent, bundles, strict=True))
        total = sum(s * n for s, n in bundles)
        for j, share in enumerate((0.8, 0.1, 0.1)):
            assert abs(sum(bundles[i][0] * sent[i][j] for i in range(len(bundles))) - share * total) <= max(s for s, _ in bundles)


def sizes(bundles, sent):
    return [sum(s * x[j] for (s, _), x in zip(bundles, sent, strict=True)) for j in range(len(sent[0]))]


def test_allocation_gives_way_to_one_large_person():
    bundles = [(100_000, 1)] + [(1, 40_000)] * 5
    for own in range(6):  # the large person's label: one of the bundles' or its own
        labels = np.zeros((6, 6))
        labels[0, own] = 100_000
        labels[range(1, 6), range(5)] = 1
        assert sizes(bundles, splits.allocate(bundles, [0.8, 0.1, 0.1], labels)) == [240_000, 30_000, 30_000]
    sent = splits.allocate(bundles, [0.8, 0.1, 0.1], labels)
    assert all(abs(x[1] - 6_000) <= 1 and abs(x[2] - 6_000) <= 1 for x in sent[1:])


def test_allocation_moves_several_components_of_any_size():
    # only two of 6 for one of 10, or larger sizes than the smallest 64, meet the quotas
    assert sizes([(10, 4), (6, 6)], splits.allocate([(10, 4), (6, 6)], [0.5, 0.5])) == [38, 38]
    bundles = [(s, 1) for s in range(1000, 1100)]
    reached = sizes(bundles, splits.allocate(bundles, [0.8, 0.1, 0.1]))
    assert all(abs(x - share * 104_950) <= 1 for x, share in zip(reached, (0.8, 0.1, 0.1), strict=True))


def test_allocation_keeps_labels():
    # as many rows of either label; sizes alone could be met with one label in dev and eval
    bundles = [(2, 100), (1, 200), (1, 3)]
    labels = np.array([[2.0, 0], [0, 1], [0, 1]])
    sent = np.array(splits.allocate(bundles, [0.8, 0.1, 0.1], labels))
    assert np.abs(labels.T @ sent - np.outer(labels.T @ [100, 200, 3], (0.8, 0.1, 0.1))).max() <= 2


def test_one_person_holds_a_third_of_the_rows(spark):
    data = [(f"trn_p0_s{i}_x", None, "p0", "ar1", 1, "y") for i in range(1000)] + [(f"trn_p{p}_s0_x", None, f"p{p}", "abcde"[p % 5], 1, "y") for p in range(1, 2001)]
    out = splits.assign(spark.createDataFrame(data, SESSIONS), spark.createDataFrame([], "old_id string, new_id string"))
    assert {r["split"]: r["sessions"] for r in splits.reached(out).collect()} == {"train": 2400, "dev": 300, "eval": 300}


def least_cost(bundles, shares):
    """The least squared deviation of all ways to deal the components, tried one by one."""
    total = sum(s * n for s, n in bundles)
    quota = [p * total for p in shares]
    reach = {(0, 0)}
    for s, n in bundles:
        reach = {(a + s * x, b + s * y) for a, b in reach for x in range(n + 1) for y in range(n + 1 - x)}
    return min((a - quota[0]) ** 2 + (b - quota[1]) ** 2 + (total - a - b - quota[2]) ** 2 for a, b in reach)


@pytest.mark.parametrize("shares", [[0.8, 0.1, 0.1], [0.5, 0.3, 0.2]])
def test_allocation_costs_least_of_all(shares):
    rng = np.random.default_rng(1)
    for _ in range(12):
        m = rng.integers(1, 7)
        bundles = sorted({int(s): int(n) for s, n in zip(rng.integers(1, 30, m), rng.integers(1, 5, m), strict=True)}.items())
        quota = np.array(shares) * sum(s * n for s, n in bundles)
        assert ((np.array(sizes(bundles, splits.allocate(bundles, shares))) - quota) ** 2).sum() <= least_cost(bundles, shares) + 1e-6


def test_allocation_of_a_hundred_sizes():
    bundles = [(s, 1) for s in range(100, 200)]
    reached = sizes(bundles, splits.allocate(bundles, [0.8, 0.1, 0.1]))
    assert all(abs(x - share * 14_950) <= 1 for x, share in zip(reached, (0.8, 0.1, 0.1), strict=True))


def test_bundles_are_spread_evenly(spark):
    # persons of one size in four profiles: each split gets its share of every profile
    data = [(f"trn_p{p}_s{i}_x", None, f"p{p}", ("ar1", "le2")[(i + p // 2) % (1 + p % 2)], 1, "y") for p in range(1000) for i in range(2)]
    out = splits.assign(spark.createDataFrame(data, SESSIONS), spark.createDataFrame([], "old_id string, new_id string")).collect()
    kind = {key: label for key, _, _, label, *_ in data}
    for label, total in (("ar1", 1500), ("le2", 500)):
        got = [sum(r["split"] == s and kind[r["session_key"]] == label for r in out) for s in ("train", "dev", "eval")]
        assert all(abs(n - share * total) <= 4 for n, share in zip(got, (0.8, 0.1, 0.1), strict=True)), got
