import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.functions import filters, samples
from spanloom.operators import dsp, signals
from spanloom.plans.pipeline import session_signals
from spanloom.sinks import tables
from spanloom.sources import annotations
from spanloom.sources.edf import EdfSource, recordings_of
from spanloom.streaming import gates


def power(x, rate, f):
    freqs, p = filters.welch(x, rate, min(len(x), int(rate * 4)))
    return p[np.argmin(np.abs(freqs - f))]


def test_welch_has_the_variance():
    x = np.random.default_rng(1).normal(0, 2, 20_000)
    freqs, p = filters.welch(x, 100.0, 400)
    assert abs(p.sum() * (freqs[1] - freqs[0]) - 4) < 0.2


def test_filters_pass_and_stop():
    t = np.arange(0, 20, 1 / 256)
    x = np.sin(2 * np.pi * 5 * t) + np.sin(2 * np.pi * 60 * t)
    y = filters.bandpass(x[None], 256.0)[0]
    assert power(y, 256, 60) < 0.1 * power(x, 256, 60) and power(y, 256, 5) > 0.9 * power(x, 256, 5)
    z = filters.filter_within(x, 256.0, 5.0, 15.0, "band", (0.5, 40.0))
    assert (z[: 5 * 256] == x[: 5 * 256]).all() and (z[15 * 256 :] == x[15 * 256 :]).all()
    assert power(z[6 * 256 : 14 * 256], 256, 60) < 0.1 * power(x, 256, 60) and power(z[6 * 256 : 14 * 256], 256, 5) > 0.5 * power(x, 256, 5)
    n = filters.notch(x[None], 256.0, [60.0])[0]
    assert power(n, 256, 60) < 0.05 * power(x, 256, 60) and power(n, 256, 5) > 0.9 * power(x, 256, 5)
    assert filters.notch(x, 256.0, []) is x
    level = filters.zero_phase(filters.butterworth(4, 40.0, "low", 256.0), np.full((2, 50), 7.0))
    assert np.allclose(level, 7.0)
    for low, high in ((0, 40), (50, 40), (1, 128)):
        with pytest.raises(ValueError):
            filters.bandpass(x[None], 256.0, low, high)


@pytest.mark.parametrize("native,target", [(250, 256), (512, 256), (256, 250), (400, 256)])
@pytest.mark.parametrize("work", [filters.resample_fft, filters.resample_poly])
def test_resampling(native, target, work):
    t = np.arange(0, 8, 1 / native)
    y = work(np.sin(2 * np.pi * 10 * t)[None], native, target)[0]
    assert abs(len(y) - 8 * target) <= 2
    want = np.sin(2 * np.pi * 10 * np.arange(len(y)) / target)
    assert np.abs(y - want)[target : -target].max() < 0.02
    if native == 512:
        alias = work(np.sin(2 * np.pi * 200 * t)[None], native, target)[0]
        assert np.abs(alias[target:-target]).max() < 0.1
    with pytest.raises(ValueError):
        work(y, 0, 1)


def test_signal_rows(spark):
    data = [(1, [1.0] * 40), (2, None), (3, [1.0, None, 2.0]), (4, []), (5, [float(i % 2) for i in range(64)])]
    df = spark.createDataFrame(data, "id int, x array<double>")
    out = {r["id"]: r["x"] for r in dsp.bandpass(df, "x", 32.0, 0.5, 8.0).collect()}
    assert out[2] is None and out[3] == [1, None, 2] and out[4] == [] and len(out[5]) == 64 and max(map(abs, out[1])) < 0.01
    assert dsp.resample(df.limit(0), "x", 2, 1).count() == 0


def test_missing_readings_and_short_signals(spark):
    whole = [float(np.sin(i / 3)) for i in range(64)]
    gap = [*whole[:10], None, math.nan, *whole[12:]]
    data = [(1, whole), (2, gap), (3, [1.0, math.inf, 3.0]), (4, [None, math.nan]), (5, None), (6, [])]
    df = spark.createDataFrame(data, "id int, x array<double>")
    got = {r["id"]: r for r in dsp.mended(df, "x").collect()}
    assert [got[i]["reason"] for i in range(1, 7)] == [None, "interpolated", "interpolated", "no_reading", "no_reading", "no_reading"]
    assert got[1]["x"] == whole and got[3]["x"] == [1, 2, 3] and got[4]["x"] is got[5]["x"] is got[6]["x"] is None
    assert got[2]["x"][9:13] == pytest.approx([whole[9], whole[9] + (whole[12] - whole[9]) / 3, whole[9] + 2 * (whole[12] - whole[9]) / 3, whole[12]])
    assert {r["id"]: r["x"] and len(r["x"]) for r in dsp.resample(dsp.mended(df, "x"), "x", 64.0, 32.0).collect()} == {1: 32, 2: 32, 3: 2, 4: None, 5: None, 6: None}
    rows = dsp.psd(df, ["id"], "x", 32.0).collect()
    assert {(r["id"], r["reason"]) for r in rows if r["psd"] is None} == {(3, "too_short"), (4, "no_reading"), (5, "no_reading"), (6, "no_reading")}
    assert sum(r["id"] == 1 and r["psd"] is not None for r in rows) == sum(r["id"] == 2 and r["psd"] is not None for r in rows) == 33


def test_noise(spark):
    rng = np.random.default_rng(42)
    t = np.arange(2000) / 250
    data = [("a", c, [float(v) for v in rng.normal(0, 1, 2000) + 8 * np.sin(2 * np.pi * 50 * t) + 6 * np.sin(2 * np.pi * 2 * t) + (9 * np.sin(2 * np.pi * 20 * t) if c == 0 else 0)]) for c in range(8)]
    df = spark.createDataFrame(data, "f string, c int, x array<double>")
    got = dsp.noise_frequencies(dsp.psd(df, ["f", "c"], "x", 250.0), ["f"], ["c"]).first()["freqs"]
    assert any(abs(f - 50) < 1 for f in got) and all(f > 4 for f in got) and not any(abs(f - 20) < 1 for f in got)
    groups = spark.range(1).select(dsp.group_frequencies(F.array(*[F.lit(x) for x in (10.0, 11.0, 12.0, 13.9, 50.0)]))).first()[0]
    assert groups == [10.5, 12.95, 50.0]


def test_pieces_and_epochs(spark):
    df = spark.createDataFrame([(1, [float(i) for i in range(22)]), (2, [1.0, 2.0]), (3, None)], "id int, x array<double>")
    assert [(r["id"], r["seg_start_sample"], r["segment"][0]) for r in signals.segment_fixed(df, "x", 5).collect()] == [(1, 0, 0), (1, 5, 5), (1, 10, 10), (1, 15, 15)]
    assert signals.epochs(df, "x", 4.0, 1.0).count() == 5
    with pytest.raises(Exception, match="whole number"):
        signals.epochs(df, "x", 4.0, 1.0, drop_last=False).collect()
    steps = spark.createDataFrame([(1000.0, 1000.0), (1000.0, 5000.0), (5000.0, 1000.0), (0.0, 1.0)], "p double, i double").select(signals.adaptive_step(F.col("p"), F.col("i"), 256)).collect()
    assert [r[0] for r in steps] == [256, 51, 256, None]


def test_masks(spark):
    probs = [[0.9, 0.05, 0.05], [0.1, 0.8, 0.1], [0.4, 0.4, 0.2]]
    df = spark.createDataFrame([(1, probs, [float(i) for i in range(14)]), (2, [], [1.0]), (3, [[0.0, 1.0, 0.0]], [5.0, 5.0])], "id int, probs array<array<double>>, x array<double>")
    masked = df.withColumn("mask", signals.mask_of(F.col("probs"), F.size("x"), 2.0))
    got = {r["id"]: r["mask"] for r in masked.collect()}
    assert got == {1: [False] * 4 + [True] * 4 + [False] * 6, 2: [False], 3: [True, True]}
    fixed = {r["id"]: (r["x"], r["fully_flagged"]) for r in signals.repair(masked, "x", "mask").collect()}
    assert fixed[1] == ([float(i) for i in range(14)], False) and fixed[3] == ([5.0, 5.0], True)
    assert {r["id"]: r["x"] for r in signals.repair(masked, "x", "mask", "zero").collect()}[1][4:8] == [0.0] * 4
    assert [(r["id"], r["span_start"], r["span_stop"]) for r in signals.spans(masked.select("id", "mask"), "mask").collect()] == [(1, 4, 8), (3, 0, 2)]
    fraction = {r["id"]: (round(r["artifact_fraction"], 6), r["windows"]) for r in signals.artifact_fraction(df, ["id"]).collect()}
    assert fraction == {1: (round((0.1 + 0.9 + 0.6) / 3, 6), 3), 2: (0.0, 0), 3: (1.0, 1)}
    edge = spark.createDataFrame([([9.0, 1.0, 9.0, 9.0, 4.0, 9.0], [True, False, True, True, False, True])], "x array<double>, m array<boolean>")
    assert edge.select(samples.interpolated(F.col("x"), F.col("m"))).first()[0] == [1, 1, 2, 3, 4, 4]


def test_montage(spark):
    df = spark.createDataFrame([(1, c, [float(i)] * 3) for i, c in enumerate(schema.CHANNELS)] + [(2, "FP1", [1.0] * 3)], "rec int, channel string, samples array<double>")
    got = signals.montage(df, ["rec"]).collect()
    at = {c: float(i) for i, c in enumerate(schema.CHANNELS)}
    assert len(got) == 20 and all(r["samples"] == [at[a] - at[b]] * 3 for r in got for a, b in [r["name"].split("-")])


def test_extract_over_blocks(spark):
    rows = spark.createDataFrame([("f2", 0.0, 2.0, "fnsz", True, "A"), ("f2", 0.0, 2.0, "fnsz", True, "B"), ("f2", 5.0, 9.0, "bg", True, "A"), ("f1", 9.0, 10.0, "bg", True, "A")], "edf_path string, start_time double, stop_time double, label string, is_valid boolean, channel string")
    offsets = signals.sample_offsets(spark.createDataFrame([("f1", "s", 5), ("f2", "s", 12)], "edf_path string, session_key string, samples long"))
    blocks = spark.createDataFrame([("s", "A", 0, [float(i) for i in range(8)]), ("s", "A", 8, [float(i) for i in range(8, 17)])], "session_key string, channel string, start_sample long, samples array<double>")
    got = {r["label"]: (r["seg_start_sample"], r["samples"]) for r in signals.extract(rows, offsets, blocks, 2.0).collect()}
    assert got == {"fnsz": (5, [5, 6, 7, 8]), "bg": (15, [15, 16])}


def edf(path, labels, rate, seconds, values):
    n = len(labels)
    pad = lambda x, w: str(x).ljust(w)[:w].encode()
    head = pad("0", 8) + pad("", 80) * 2 + pad("01.01.24", 8) + pad("00.00.00", 8) + pad(256 * (n + 1), 8) + pad("", 44) + pad(seconds, 8) + pad(1, 8) + pad(n, 4)
    for width, vals in ((16, labels), (80, [""] * n), (8, ["uV"] * n), (8, [-100] * n), (8, [100] * n), (8, [-1000] * n), (8, [1000] * n), (80, [""] * n), (8, [rate] * n), (32, [""] * n)):
        head += b"".join(pad(v, width) for v in vals)
    body = b"".join(np.round(np.array(values)[:, s * rate : (s + 1) * rate] * 10).astype("<i2").tobytes() for s in range(seconds))
    path.write_bytes(head + body)


def test_edf(spark, tmp_path):
    x = np.stack([np.arange(300) % 50 / 1.0, -(np.arange(300) % 40) / 1.0])
    edf(tmp_path / "a.edf", ["EEG FP1-REF", "EEG F7-LE"], 100, 3, x)
    (tmp_path / "bad.edf").write_bytes(b"0" * 100)
    spark.dataSource.register(EdfSource)
    head = {(r["path"].rsplit("/", 1)[1], r["channel"]): r for r in spark.read.format("edf").option("mode", "header").load(str(tmp_path)).collect()}
    assert head["bad.edf", None]["error"] and head["a.edf", "EEG FP1-REF"]["n_times"] == 300 and head["a.edf", "EEG F7-LE"]["sfreq"] == 100.0
    got = spark.read.format("edf").option("mode", "signal").option("channels", "F7").load(str(tmp_path / "a.edf")).collect()
    assert [r["channel"] for r in got] == ["EEG F7-LE"] and np.allclose(got[0]["samples"], x[1], atol=0.06)


def test_blocks_to_sessions(spark, tmp_path):
    """Recordings in several blocks become signals of a session on one time line."""
    rng = np.random.default_rng(1)
    names = [f"EEG {c}-REF" for c in schema.CHANNELS]
    x = {f: np.round(rng.normal(0, 20, (17, n * 32)), 1) for f, n in (("a", 150), ("b", 70))}
    for f, values in x.items():
        edf(tmp_path / f"{f}.edf", names, 32, values.shape[1] // 32, values)
    spark.dataSource.register(EdfSource)
    blocks = spark.read.format("edf").option("mode", "signal").load(str(tmp_path))
    whole = recordings_of(blocks.unionByName(blocks))
    got = {(r["edf_path"].rsplit("/", 1)[1][0], r["channel"]): r["samples"] for r in whole.collect()}
    assert len(got) == 34
    for f, values in x.items():
        for i, c in enumerate(schema.CHANNELS):
            assert np.allclose(got[f, c], values[i], atol=0.06)
    placed, offsets = session_signals(whole.withColumn("session_key", F.lit("s")), 0.5, 10.0, target=32.0)
    assert sorted((r["start_sample"], r["end_sample"]) for r in offsets.collect()) == [(0, 4800), (4800, 7040)]
    assert placed.count() == 34


def test_postprocess(spark):
    df = spark.createDataFrame([("s", "B", [1.0, 2.0]), ("s", "A", [3.0, 5.0]), ("t", "A", [7.0, 7.0])], "session_key string, channel string, samples array<double>")
    out = signals.postprocess(df, ["session_key"], lambda x, names: x - x.mean(0))
    got = {(r["session_key"], r["channel"]): r["samples"] for r in out.collect()}
    assert got == {("s", "A"): [1.0, 1.5], ("s", "B"): [-1.0, -1.5], ("t", "A"): [0.0, 0.0]}


def test_annotation_files(spark, tmp_path):
    root = tmp_path / "edf/train/p1/s1_2000/01_tcp_ar"
    root.mkdir(parents=True)
    (root / "a.csv").write_text("# version\n# montage_file = m.txt\nchannel, start_time,stop_time ,label,confidence\nFP1-F7,0.0,1.0,fnsz,1 # note\nFP1-F7,x,1.0,bckg,1\n\nC3-CZ,2,3,bckg,0.5\n")
    (root / "b.csv").write_text("not,valid,csv\n1,2,3\n")
    (root / "a.edf").write_text("x")
    (root / "m.txt").write_text("montage = 0, FP1-F7: EEG FP1-REF -- EEG F7-REF\nother\n")
    rows = annotations.read_annotations(spark, str(tmp_path))
    files = annotations.inventory(spark, str(tmp_path))
    told = annotations.annotation_files(spark.createDataFrame([("a", (root / "a.csv").read_text()), ("b", (root / "b.csv").read_text()), ("c", None)], "csv_path string, value string"))
    assert [tuple(r) for r in told.collect()] == [("a", "m.txt", 2, 1)]
    found = annotations.montage_paths(told, annotations.inventory(spark, str(tmp_path), "*.txt")).first()
    assert found["montage_path"].endswith("01_tcp_ar/m.txt")
    got = annotations.master_rows(rows, files, ("fnsz",)).collect()
    assert [(r["channel"], r["stop_time"], r["split"], r["status"]) for r in got] == [("FP1-F7", 1.0, "train", -1)]
    assert annotations.master_rows(rows, files).count() == 2
    index = annotations.index_sessions(files).first()
    assert index["session_key"] == "trn_p1_s1_2000_ar1" and len(index["csv_paths"]) == 2 and len(index["edf_paths"]) == 1
    assert tuple(annotations.read_montage(spark, str(root / "m.txt")).first()) == ("FP1-F7", "EEG FP1-REF", "EEG F7-REF")


def test_checkpoints(spark, tmp_path):
    df = spark.createDataFrame([("s1", "A", [0.1, 0.2]), ("s2", "A", [3.0])], "session_key string, channel string, samples array<double>")
    where = str(tmp_path / "c")
    tables.write_checkpoint(df, where, "raw")
    tables.write_checkpoint(df.where("session_key = 's2'").withColumn("samples", F.array(F.lit(4.0))), where, "raw")
    assert tables.read_checkpoint(spark, where, "raw", "s2").first()["samples"] == [4.0]
    assert np.allclose(tables.read_checkpoint(spark, where, "raw", "s1").first()["samples"], [0.1, 0.2])
    with pytest.raises(FileNotFoundError):
        tables.read_checkpoint(spark, where, "raw", "s3")
    assert tuple(tables.convert_verified(df, str(tmp_path / "v"), ["session_key", "channel"], "samples").first()) == (2, True, 0)


def test_session_signals(spark):
    t = np.arange(320) / 32
    data = [("s", f, c, 32.0, [float(v) for v in np.sin(2 * np.pi * 2 * t)]) for f in ("f1", "f2") for c in schema.CHANNELS] + [("s", "f3", "FP1", 32.0, [1.0] * 320)]
    df = spark.createDataFrame(data, "session_key string, edf_path string, channel string, sfreq double, samples array<double>")
    placed, offsets = session_signals(df, 0.5, 10.0, target=64.0)
    assert sorted((r["edf_path"], r["start_sample"], r["end_sample"]) for r in offsets.collect()) == [("f1", 0, 640), ("f2", 640, 1280)]
    assert placed.count() == 34 and {r["start_sample"] for r in placed.collect()} == {0, 640}


def test_stream(spark, tmp_path):
    data = [("a", 100.0, 110.0), ("a", 200.0, 210.0), ("b", 50.0, 60.0), ("a", 900.0, 901.0)]
    for i in range(0, 4, 2):
        spark.createDataFrame(data[i : i + 2], "k string, start_time double, stop_time double").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, start_time double, stop_time double").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    out = gates.gate_stream(stream, "k", 30.0, 100.0)
    q = out.writeStream.format("memory").queryName("gated").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(tuple(r) for r in spark.table("gated").collect()) == [("a", 100, 110, False), ("a", 200, 210, True), ("a", 900, 901, False), ("b", 50, 60, False)]
