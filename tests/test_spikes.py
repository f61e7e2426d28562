import math

import numpy as np
import pytest

from spanloom.operators import spikes

SEG = "segment_id long, master_id long, edf_path string, seg_start_sample long, segment array<float>, channel string, kind string"
REC = "edf_path string, physical_min double, physical_max double, resolution double"


def brute(segments, channel, header):
    """Kinds by the rules as they are stated, reading by reading."""
    seen, found = {}, set()
    for sid, mid, path, _, x in segments:
        seen.setdefault(sid, (path, channel.get(mid), x))
    inside = lambda v, h: v is not None and math.isfinite(v) and h[0] - abs(h[0]) * 1e-6 <= v <= h[1] + abs(h[1]) * 1e-6
    sources = {}
    for path, ch, x in seen.values():
        sources.setdefault((path, ch), []).extend(v for v in x or [] if inside(v, header[path]))
    for sid, (path, ch, x) in seen.items():
        h, xs = header[path], x or []
        values = np.array(sources[path, ch], float)
        m = np.median(values) if len(values) else math.nan
        s = 1.4826 * np.median(np.abs(values - m)) if len(values) else math.nan
        if any(v is not None and not inside(v, h) for v in xs):
            found.add((sid, "impossible"))
        run = 0
        for v in [*xs, None]:
            if inside(v, h) and abs(v - m) > 10 * s:
                run += 1
            else:
                if 1 <= run <= 5:
                    found.add((sid, "spike"))
                run = 0
        for i in range(len(xs) - 31):
            w = xs[i : i + 32]
            if all(v is not None and math.isfinite(v) for v in w) and max(w) - min(w) <= h[2] + 1e-6 * max(abs(max(w)), abs(min(w))):
                found.add((sid, "stuck"))
    return sorted(found)


def made(seed):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(60):
        n = int(rng.choice([0, 20, 64, 128], p=[0.1, 0.2, 0.2, 0.5]))
        x = [float(np.float32(round(v, 1))) for v in rng.normal(3, 5, n)]
        kind = int(rng.integers(0, 9))
        if n > 40:
            at = int(rng.integers(0, n - 36))
            if kind == 0:
                x[at] = 5000.0
            elif kind == 1:
                x[at] = math.nan
            elif kind == 2:
                x[at : at + 3] = [400.0, -400.0, 390.0]
            elif kind == 3:
                x[at : at + 6] = [400.0] * 6
            elif kind == 4:
                x[at : at + 33] = [7.1] * 33
            elif kind == 5:
                x[at : at + 34] = [7.1, 7.2] * 16 + [7.0, 7.1]
            elif kind == 6:
                x[at : at + 8] = [400.0, 400.0, 400.0, None, 400.0, 400.0, 400.0, 9999.0]
            elif kind == 7:
                x[-5:] = [300.0] * 5
        out.append((i, int(rng.choice([1, 2, 3, 9])), str(rng.choice(["p", "p", "p", "q"])), int(rng.integers(0, 99)) * 128, None if i == 5 else x))
    return out + out[:7]


@pytest.mark.parametrize("chunk", [20_000, 9])
def test_against_the_rules(spark, rows, chunk):
    segments = made(4)
    df = spark.createDataFrame([(*s, "clash", "x") for s in segments], SEG)
    master = spark.createDataFrame([(1, " c3-cz "), (1, "C3 - CZ"), (2, "C3-CZ"), (3, "T3"), (None, "T3")], "master_id long, channel string")
    recordings = spark.createDataFrame([("p", -3200.0, 3200.0, 0.1), ("p", -3200.0, 3200.0, 0.1), ("q", -500.0, 500.0, 0.1)], REC)
    want = brute(segments, {1: "C3-CZ", 2: "C3-CZ", 3: "T3"}, {"p": (-3200, 3200, 0.1), "q": (-500, 500, 0.1)})
    assert len({k for _, k in want}) == 3
    assert rows(spikes.implausible(df, master, recordings, chunk)) == sorted(want, key=str)


def test_fits_of_split_sources(spark):
    segments = [*[(*s, "clash", "x") for s in made(4)], *[(100 + i, 3, "q", 0, [None, math.nan], "clash", "x") for i in range(20)]]
    df = spark.createDataFrame(segments, SEG)
    master = spark.createDataFrame([(1, "C3-CZ"), (2, "C3-CZ"), (3, "T3")], "master_id long, channel string")
    recordings = spark.createDataFrame([("p", -3200.0, 3200.0, 0.1)], REC)
    for table in (df, df.where("master_id = 3 and segment_id >= 100")):  # the second has no usable reading
        whole, parts = (sorted(map(tuple, spikes.tail_fits(table, master, recordings, n).collect()), key=str) for n in (20_000, 3))
        assert len(whole) == len(parts) > 0
        for a, b in zip(whole, parts, strict=True):
            assert a[:2] == b[:2]
            np.testing.assert_allclose(np.array(a[2:], float), np.array(b[2:], float), rtol=1e-9)


def test_empty_and_unknown(spark, rows):
    df = spark.createDataFrame([(1, None, None, None, [1.0, float("inf")], "x", "x"), (None, 1, "p", 0, [1.0], "x", "x")], SEG)
    none = spark.createDataFrame([], "master_id long, channel string"), spark.createDataFrame([], REC)
    assert rows(spikes.implausible(df, *none)) == [(1, "impossible")]
    assert spikes.implausible(df.limit(0), *none).count() == 0


def test_cutoffs_never_exceed_the_rule():
    rng = np.random.default_rng(1)
    for _ in range(50):
        x = rng.standard_t(2, 500)
        median, spread = spikes.median_and_spread(x)
        phase = rng.integers(0, spikes.BINS, 500)
        season = spikes.profile(*spikes.profile_sums(x, phase, median, spread), spread)
        tails = spikes.tail_sums(x - median - season[phase], spread)
        for part in np.split(tails, 2):
            at = spikes.candidate_cutoff(spikes.fit_tail(part, 500, spread), spread, season)
            assert 0 <= at <= spikes.SPIKE_SPREADS * spread - np.abs(season).max() + 1e-12


@pytest.mark.parametrize("shape", [-0.2, 0.0, 0.3, 0.8, 1.5])
def test_fits_find_the_tail(shape):
    rng = np.random.default_rng(5)
    y = -np.log(rng.random(20_000)) if shape == 0 else (rng.random(20_000) ** -shape - 1) / shape
    excess = np.concatenate((y + spikes.TAIL, np.zeros(180_000)))
    sums = np.split(spikes.tail_sums(excess, 1.0), 2)[1]
    tail = spikes.fit_tail(sums, len(excess), 1.0)
    assert abs(tail.shape - shape) < 0.1 and abs(tail.scale - 1) < 0.15
    beyond = (excess > tail.cutoff).mean()
    assert 0.3 * spikes.RISK < beyond < 3 * spikes.RISK
    assert tail.probability(np.array([tail.cutoff]))[0] == pytest.approx(spikes.RISK)


def test_exceedances_by_the_fits_alone(spark, rows):
    rng = np.random.default_rng(2)
    data = [(i, 3, "q", 0, [float(np.float32(v)) for v in rng.normal(0, 5, 128)], "clash", "x") for i in range(200)]
    for i, at, value in ((7, 5, 43.0), (9, 100, -44.0), (9, 101, -46.0)):  # within ten spreads, beyond what the source shows
        data[i][4][at] = value
    df = spark.createDataFrame(data, SEG)
    master = spark.createDataFrame([(3, "T3")], "master_id long, channel string")
    recordings = spark.createDataFrame([("q", -500.0, 500.0, 0.1)], REC)
    got = spikes.exceedances(df, master, recordings).collect()
    parts = spikes.exceedances(df, master, recordings, 9).collect()
    key = lambda r: (r["segment_id"], r["side"], r["first_sample"], r["readings"])
    assert sorted(map(key, got)) == sorted(map(key, parts))
    assert {(7, "high", 5, 1), (9, "low", 100, 2)} <= {key(r) for r in got} and len(got) < 15
    assert all(r["probability"] < spikes.RISK and r["peak"] > r["cutoff"] for r in got)
    assert rows(spikes.implausible(df, master, recordings)) == []
    assert spikes.exceedances(df.limit(0), master, recordings).count() == 0
