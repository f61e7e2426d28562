import random

import pytest
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.functions import channels, labels
from spanloom.operators import annotate, intervals, match, windows
from spanloom.plans.pipeline import MasterConfig, build_master

COLUMNS = "edf_path string, split string, session_key string, channel string, start_time double, stop_time double, label string, is_valid boolean, status int"


def master(spark, data, session=None):
    full = [(d[3] if len(d) > 3 else "a.edf", "train", session, "FP1-F7", float(d[0]), float(d[1]), d[2], d[4] if len(d) > 4 else True, -1) for d in data]
    df = spark.createDataFrame(full, COLUMNS).coalesce(1)
    return annotate.as_master(df, F.monotonically_increasing_id())


def seen(df, *more):
    return sorted((r["label"], r["start_time"], r["stop_time"], r["is_valid"]) for r in df.collect())


def test_preictal_gates(spark):
    two = master(spark, [(100, 110, "fnsz"), (400, 420, "gnsz")])
    assert seen(annotate.preictal_rows(two, 10, 50)) == [("pfnsz", 40, 50, True), ("pfnsz_sopbuffer", 50, 100, False), ("pgnsz", 340, 350, True), ("pgnsz_sopbuffer", 350, 400, False)]
    assert ("pfnsz", 0, 100, False) in seen(annotate.preictal_rows(two, 10, 200))
    assert ("pfnsz", 0, 100, False) in seen(annotate.preictal_rows(two, 150, 50))
    near = master(spark, [(100, 110, "fnsz"), (200, 210, "fnsz")])
    assert ("pfnsz", 110, 200, False) in seen(annotate.preictal_rows(near, 10, 20, 100))
    assert ("pfnsz", 170, 180, True) in seen(annotate.preictal_rows(near, 10, 20))
    assert annotate.add_preictal(near, 10, 20).count() == 6
    with pytest.raises(ValueError):
        annotate.preictal_rows(near, 0, 20)


def test_postictal_and_consecutive(spark):
    assert seen(annotate.postictal_rows(master(spark, [(100, 110, "fnsz")]), 60, 50)) == [("qfnsz", 110, 170, True)]
    assert seen(annotate.postictal_rows(master(spark, [(100, 110, "fnsz"), (200, 210, "fnsz")]), 60, 50)) == [("cfnsz2", 110, 150, True), ("qfnsz", 210, 270, True)]
    got = annotate.postictal_rows(master(spark, [(100, 110, "fnsz"), (130, 140, "gnsz")]), 60, 50).collect()
    assert sorted((r["label"], r["start_time"], r["stop_time"], r["status"]) for r in got) == [("cfnszgnsz", 110, 110, 2), ("qgnsz", 140, 200, 1)]


def test_exclusions(spark):
    df = master(spark, [(100, 110, "fnsz"), (300, 320, "fnsz"), (800, 820, "gnsz"), (150, 160, "fnsz", "b.edf")])
    got = seen(annotate.add_exclusions(df, 60))
    assert sum(x[0] == "fnsz" for x in got) == 3 and ("xfnsz", 110, 170, False) in got and all(not x[3] for x in got if x[0].startswith("x"))


@pytest.mark.parametrize("data,duration,least,want", [([(0, 100), (500, 600)], 1000, 0, [(100, 500), (600, 1000)]), ([(200, 300)], 300, 0, [(0, 200)]), ([(0, 1000)], 1000, 0, []), ([(0, 100), (105, 200)], 200, 10, []), ([(0, 100), (110, 200)], 200, 10, [(100, 110)]), ([(100, 300), (0, 150), (400, 500)], 500, 0, [(300, 400)])])
def test_interictal(spark, data, duration, least, want):
    df = master(spark, [(*x, "seiz") for x in data])
    durations = spark.createDataFrame([("a.edf", float(duration)), ("none.edf", 5.0)], "edf_path string, duration_s double")
    assert sorted((r["start_time"], r["stop_time"]) for r in annotate.interictal_rows(df, durations, least).collect()) == want


def test_background(spark):
    lay = spark.createDataFrame([(None, "a.edf", 30.0, None)], "session_key string, edf_path string, duration_s double, total_duration_s double")
    got = annotate.background_rows(master(spark, [(10, 15, "fnsz")]), lay, 4.0)
    assert sorted((r["start_time"], r["stop_time"]) for r in got.collect()) == [(0, 4), (4, 8), (15, 19), (19, 23), (23, 27)]
    assert annotate.background_rows(master(spark, [(0, 30, "bckg")]), lay, 4.0).count() == 0


def test_resolve_examples(spark):
    assert seen(annotate.resolve_overlaps(master(spark, [(0, 10, "fnsz"), (4, 6, "pgnsz"), (5, 8, "cfnsz2")]))) == [("cfnsz2", 5, 8, True), ("fnsz", 0, 4, True), ("fnsz", 8, 10, True), ("pgnsz", 4, 5, True)]
    assert seen(annotate.resolve_overlaps(master(spark, [(0, 10, "xfnsz", "a.edf", False), (5, 7, "fnsz")]))) == [("fnsz", 5, 7, True), ("xfnsz", 0, 10, False)]
    assert seen(annotate.resolve_overlaps(master(spark, [(0, 10, "cpsz"), (8, 12, "pfnsz")]))) == [("cpsz", 0, 8, True), ("pfnsz", 8, 12, True)]
    assert seen(annotate.resolve_overlaps(master(spark, [(5, 5, "cfnsz2"), (0, 10, "fnsz")]))) == [("fnsz", 0, 10, True)]


def greedy(data):
    rank = {"fnsz": 1, "pfnsz": 2, "cfnsz2": 5, "interictal": 0, "bg": 1}
    placed, out = [], []
    for i in sorted(range(len(data)), key=lambda i: (-rank[data[i][2]], data[i][0], i)):
        pieces = [(data[i][0], data[i][1])]
        for a, b in placed:
            pieces = [p for x, y in pieces for p in ((x, min(y, a)), (max(x, b), y)) if p[1] > p[0]]
        pieces = sorted(set(pieces))
        placed += pieces
        out += [(data[i][2], float(a), float(b), True) for a, b in pieces]
    return sorted(out)


def test_resolve_against_greedy(spark):
    rng = random.Random(7)
    data = []
    for _ in range(60):
        a = rng.randrange(300)
        data.append((a, a + rng.randrange(1, 30), rng.choice(["fnsz", "pfnsz", "cfnsz2", "interictal", "bg"])))
    once = annotate.resolve_overlaps(master(spark, data))
    assert seen(once) == greedy(data)
    again = seen(once)
    assert sum(b - a for _, a, b, _ in again) == len({t for a, b, _ in data for t in range(a, b)})


def test_chop_and_windows(spark):
    df = master(spark, [(0, 10, "pfnsz"), (20, 28, "fnsz"), (30, 34, "bg"), (100, 120, "pfnsz_sopbuffer", "a.edf", False)])
    counts = {r["label"]: r["n"] for r in annotate.chop(df, 4.0).groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"pfnsz": 2, "fnsz": 2, "bg": 1, "pfnsz_sopbuffer": 1}
    assert annotate.chop(df.unionByName(master(spark, [(200, 300, "bg")])), 4.0, adaptive=True).where("label = 'pfnsz'").count() == 16  # every 4 / (104 / 10) s
    assert [r["start_time"] for r in windows.windows_fixed(master(spark, [(0, 10, "fnsz"), (10, 12, "fnsz")]), 4.0).collect()] == [0, 4]
    out = windows.windows_adaptive(master(spark, [(0, 100, "bg"), (100, 120, "pfnsz")]), 4.0, 100.0)
    assert out.where("label = 'bg'").count() == 1 and out.where("label = 'pfnsz'").count() == 21
    with pytest.raises(ValueError):
        windows.windows_fixed(df, 0)


def test_layout_and_file_time(spark):
    files = spark.createDataFrame([("s", "t000", 100.0), ("s", "t001", None), ("s", "t002", 50.0)], "session_key string, edf_path string, duration_s double")
    lay = annotate.session_layouts(files)
    assert [(r["offset_s"], r["total_duration_s"], r["readable"]) for r in lay.orderBy("edf_path").collect()] == [(0, 150, True), (100, 150, False), (100, 150, True)]
    df = master(spark, [(90, 110, "a"), (100, 104, "b"), (160, 164, "c"), (-5, 1, "d")], "s")
    assert sorted((r["label"], r["edf_path"], r["start_time"], r["stop_time"]) for r in annotate.to_file_time(df, lay).collect()) == [("a", "t000", 90, 110), ("b", "t002", 0, 4), ("c", "t002", 60, 64), ("d", "t000", -5, 1)]
    lost = annotate.to_file_time(master(spark, [(1, 2, "a")], None), lay).first()
    assert (lost["edf_path"], lost["start_time"]) == ("a.edf", 1)


def test_whole_pipeline(spark):
    lay = annotate.session_layouts(spark.createDataFrame([("s", "a.edf", 200.0)], "session_key string, edf_path string, duration_s double"))
    out = build_master(master(spark, [(100, 110, "fnsz"), (0, 100, "bckg")]), lay, MasterConfig(10, 5, 20, 4, tags=("fnsz",)))
    got = {r["label"]: r["n"] for r in out.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got["pfnsz"] == 2 and got["fnsz"] == 2 and got["qfnsz"] == 5 and got["bg"] > 30 and got["pfnsz_sopbuffer"] == 1
    assert out.columns == schema.MASTER.fieldNames()


def test_paths_and_names(spark):
    df = spark.createDataFrame([("/x/edf/train/p001/s001_2015/01_tcp_ar/a.csv.csv",), ("/d/edf/TRAIN/p/s/weird/a.edf",), ("/d/edf/misc/p/s/f/a.edf",), ("train/a.edf",), (None,)], "path string")
    parts = labels.path_parts(F.col("path"))
    got = df.select(labels.split_of_path(F.col("path")), parts["patient"], labels.montage_type(parts["folder"]), labels.recording_of(F.col("path"))).collect()
    assert [r[0] for r in got] == ["train", "train", "unknown", "train", "unknown"]
    assert [r[1] for r in got] == ["p001", "p", None, None, None] and [r[2] for r in got][:2] == ["ar1", "unk0"]
    assert got[0][3] == "/x/edf/train/p001/s001_2015/01_tcp_ar/a.edf.edf"
    names = spark.createDataFrame([(" eeg fp1-REF ",), ("C3-CZ",), ("A-",), ("T3 - P3-X",), (None,)], "c string")
    out = names.select(channels.normalized(F.col("c")), channels.bipolar_sides(F.col("c"))).collect()
    assert [r[0] for r in out] == ["FP1", "C3", "A-", "T3-P3-X", None]
    assert [tuple(r[1]) if r[1] else None for r in out] == [None if x is None else x for x in [("eeg fp1", "REF"), ("C3", "CZ"), None, ("T3", "P3-X"), None]]


def test_matching(spark):
    a = spark.createDataFrame([("k", "EEG FP1-REF"), ("k", "FP1F7X"), ("k", "ZZZ"), ("k", None)], "k string, channel string")
    p = spark.createDataFrame([("k", "FP1"), ("k", "FP1F7"), ("j", "ZZZ")], "k string, channel string")
    got = {r["annotation"]: r["channel"] for r in match.match_channels(a, p, ["k"]).collect()}
    assert got == {"EEG FP1-REF": "FP1", "FP1F7X": "FP1F7", "ZZZ": None}
    s = spark.createDataFrame([("k", "FP1", [3.0, 4.0]), ("k", "F7", [1.0, 1.0])], "k string, channel string, samples array<double>")
    w = spark.createDataFrame([("k", "FP1-F7"), ("k", "FP1-T3"), ("k", "odd")], "k string, channel string")
    m = spark.createDataFrame([("odd", "F7", "FP1")], "name string, source_a string, source_b string")
    assert {r["name"]: r["samples"] for r in match.derive_missing(w, s, ["k"], m).collect()} == {"FP1-F7": [2, 3], "odd": [-2, -3]}


def test_derived_by_likeness(spark):
    s = spark.createDataFrame([("k", "EEG FP1-REF", [3.0, 4.0]), ("k", "F7", [1.0, 1.0]), ("j", "T3", [5.0, 5.0])], "k string, channel string, samples array<double>")
    w = spark.createDataFrame([("k", "FP01-F7"), ("k", "FP1-F7"), ("k", "FP1-T3"), ("k", "F7"), ("j", "FP1-F7")], "k string, channel string")
    got = {(r["k"], r["name"]): r["samples"] for r in match.derive_missing(w, s, ["k"], unresolved=True).collect()}
    assert got == {("k", "FP01-F7"): [2, 3], ("k", "FP1-F7"): [2, 3], ("k", "FP1-T3"): None, ("j", "FP1-F7"): None}
    assert {r["name"] for r in match.derive_missing(w, s, ["k"], cutoff=1.0).collect()} == {"FP1-F7"}


def test_overlap_seconds(spark):
    left = spark.createDataFrame([(1, "a", 0.0, 10.0), (2, "a", 20.0, 30.0)], "id int, k string, start_time double, stop_time double")
    right = spark.createDataFrame([("a", 5.0, 7.0), ("a", 9.0, 25.0)], "k string, start_time double, stop_time double")
    assert {r["id"]: r["overlap"] for r in intervals.overlap_seconds(left, right, ["k"], "id").collect()} == {1: 3.0, 2: 5.0}


def test_overlapping_and_subtract_by_brute_force(spark):
    import random

    rng = random.Random(3)
    rows, islands = [], []
    for k in ("a", "b", None):
        at = -50.0
        while at < 700:
            at += rng.choice([0.0, 1.5, 40.0])
            islands.append((k, at, at + rng.choice([0.5, 61.0, 200.0])))
            at = islands[-1][2] + rng.choice([0.5, 30.0])
        rows += [(k, i, s := rng.choice([-10.0, 0.0, 59.5, 60.0, 120.0, 333.3]) + rng.random(), s + rng.choice([0.0, 0.1, 60.0, 500.0])) for i in range(40)]
    left = spark.createDataFrame(rows, "k string, id int, start_time double, stop_time double")
    right = spark.createDataFrame(islands, "k string, start_time double, stop_time double")
    want = []
    for k, i, a, b in rows:
        at = a
        for _, x, y in sorted((v for v in islands if v[0] == k and v[1] < b and v[2] > a), key=lambda v: v[1]):
            if x > at:
                want.append((str(k), i, at, x))
            at = max(at, y)
        if b > at:
            want.append((str(k), i, at, b))
    got = [(str(r["k"]), r["id"], r["start_time"], r["stop_time"]) for r in intervals.subtract(left, right, ["k"], "id").collect()]
    assert sorted(got) == sorted(want)
    whole = left.withColumn("start_time", F.col("start_time") - 70).withColumn("stop_time", F.col("stop_time") + 3)
    shortened = intervals.subtract(left, right, ["k"], "id", before=whole).collect()
    assert sorted((str(r["k"]), r["id"], r["start_time"], r["stop_time"]) for r in shortened) == sorted(want)
    pairs = intervals.overlapping(left, right.toDF("_k", "_a", "_b"), ["k"]).count()
    assert pairs == sum(a < y and b > x and b > a for k, _, a, b in rows for q, x, y in islands if q == k)


def test_rows_before_and_after_over_blocks(spark):
    import random

    rng = random.Random(4)
    data = [(k, i, float(rng.choice([-7.0, 0.0, 3.0, 9.9, 10.0, 55.0, 1000.0]) + rng.randrange(3)), float(rng.randrange(100))) for k in ("a", None) for i in range(60)]
    df = spark.createDataFrame(data, "k string, n int, start_time double, stop_time double")
    order = ["start_time", "n"]
    before = {(r["k"], r["n"]): r["near"] and r["near"]["n"] for r in intervals.neighbour(df, ["k"], order, ["n"], "near", block=10.0).collect()}
    after = {(r["k"], r["n"]): r["near"] and r["near"]["n"] for r in intervals.neighbour(df, ["k"], order, ["n"], "near", following=True, block=10.0).collect()}
    reach = {(r["k"], r["n"]): r["reach"] for r in intervals.reach(df, ["k"], order, "stop_time", "reach", block=10.0).collect()}
    for k in ("a", None):
        rows = sorted((d for d in data if d[0] == k), key=lambda d: (d[2], d[1]))
        for i, d in enumerate(rows):
            assert before[k, d[1]] == (rows[i - 1][1] if i else None)
            assert after[k, d[1]] == (rows[i + 1][1] if i + 1 < len(rows) else None)
            assert reach[k, d[1]] == max((x[3] for x in rows[:i]), default=None)
    assert intervals.reach(df.limit(0), ["k"], order, "stop_time", "reach").count() == 0


def test_chop_keeps_whole_rows_and_drops_what_is_too_short(spark):
    rows = [(0, 3.9, "bg"), (0, 4, "bg"), (10, 19, "bg"), (0, 3, "fnsz"), (20, 32.5, "fnsz"), (40, 41, "xfnsz", "a.edf", False), (50, 51, "pfnsz_sopbuffer"), (60, 70, "pfnsz")]
    df = master(spark, rows)
    want = [("bg", 0, 4), ("bg", 10, 19), ("fnsz", 20, 24), ("fnsz", 24, 28), ("fnsz", 28, 32), ("pfnsz", 60, 64), ("pfnsz", 63, 67), ("pfnsz", 66, 70), ("pfnsz_sopbuffer", 50, 51), ("xfnsz", 40, 41)]
    got = annotate.chop(df, 4.0, preictal_stride=3.0)
    assert got.columns == [*annotate.COLUMNS, "_seq"]
    assert sorted((r["label"], r["start_time"], r["stop_time"]) for r in got.collect()) == want
    assert got.select("_seq").distinct().count() == len(want)
    timeless = df.withColumn("stop_time", F.lit(None).cast("double"))
    assert sorted(r["label"] for r in annotate.chop(timeless, 4.0).collect()) == ["pfnsz_sopbuffer", "xfnsz"]
    assert annotate.chop(df.withColumn("label", F.lit(None).cast("string")), 4.0).where("is_valid").count() == 1 + 2 + 3 + 2  # of 4, 9, 12.5 and 10 s
    assert annotate.chop(df.limit(0), 4.0).count() == 0


def test_resolve_without_some_priorities(spark):
    lowest = master(spark, [(0, 20, "interictal"), (5, 8, "pfnsz")])
    assert seen(annotate.resolve_overlaps(lowest)) == [("interictal", 0, 5, True), ("interictal", 8, 20, True), ("pfnsz", 5, 8, True)]
    single = master(spark, [(0, 10, "fnsz"), (4, 12, "fnsz")])
    assert seen(annotate.resolve_overlaps(single)) == [("fnsz", 0, 10, True), ("fnsz", 10, 12, True)]
    assert annotate.resolve_overlaps(single.limit(0)).count() == 0
