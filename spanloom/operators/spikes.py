"""Implausible readings of sampled signals: impossible, spike and stuck (problem 1).

Per source, residuals are readings less the source's median and its seasonal profile (the
phase within half a second). A generalised Pareto distribution is fitted to the excesses of
either tail over a threshold, and its quantile at a fixed risk is the tail's cutoff. Readings
beyond a cutoff are candidates; for them a cutoff never exceeds the distance that the spike rule
asks for, so the exact rule that follows sees every case. Duration and plausibility rules find
stuck and impossible readings. exceedances lists what lies beyond the cutoffs as fitted.

Segments of one source meet in one task, up to CHUNK_SEGMENTS of them. A source of more is
dealt to several chunks; its median and spread then come from counted distinct values, its
profile and tail moments from sums, all aggregated by Spark, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.arrow_groups import boundaries, whole_groups
from spanloom.session import materialize

CHUNK_SEGMENTS = 20_000
#: Fixed values of the rules.
SPIKE_SPREADS = 10.0
SPIKE_LONGEST = 5
STUCK_SHORTEST = 32
SPREAD = 1.4826
TOLERANCE = 1e-6
#: Season: readings per period and bins of a profile; the profile stays within one spread.
PERIOD, BINS = 128, 16
#: Tail threshold in spreads, risk of a cutoff, and the ratios of shape to scale that are tried, by one spread.
TAIL, RISK = 2.5, 1e-4
THETAS = 2.0 ** (np.arange(-16, 9) / 2)

SOURCE = ["edf_path", "channel"]
KINDS = np.array(["impossible", "spike", "stuck"])
FOUND = "segment_id long, kind string"
FITS = "edf_path string, channel string, readings long, median double, spread double, excesses_low long, shape_low double, scale_low double, excesses_high long, shape_high double, scale_high double, cutoff_low double, cutoff_high double"
RUNS = "segment_id long, side string, first_sample int, readings int, peak double, cutoff double, probability double"


def clean_channel(channel: Column) -> Column:
    """Channel names in upper case without blanks."""
    return F.upper(F.regexp_replace(channel, r"\s+", ""))


@dataclass
class Readings:
    """Readings of segments laid end to end."""

    value: np.ndarray  # float64, nulls as NaN
    null: np.ndarray
    row: np.ndarray  # segment of each reading
    phase: np.ndarray  # bin of the season
    usable: np.ndarray  # finite and within the recording's range
    length: np.ndarray  # readings of each segment


def readings(table: pa.Table) -> Readings:
    arrays = table["segment"].combine_chunks()
    arrays = pc.if_else(pc.is_null(arrays), pa.scalar([], arrays.type), arrays) if arrays.null_count else arrays
    length = pc.list_value_length(arrays).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = arrays.flatten()
    null = pc.is_null(flat).to_numpy(zero_copy_only=False)
    value = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(length)), length)
    at = np.arange(len(value)) - np.repeat(np.cumsum(length) - length, length)
    begin = pc.fill_null(table["seg_start_sample"], 0).to_numpy()
    phase = (begin[row] + at) % PERIOD // (PERIOD // BINS)
    low, high = (pc.fill_null(table[c], v).to_numpy().astype(np.float64) for c, v in (("physical_min", -np.inf), ("physical_max", np.inf)))
    slack = lambda x: np.where(np.isfinite(x), np.abs(x) * TOLERANCE, 0)
    with np.errstate(invalid="ignore"):
        usable = np.isfinite(value) & (value >= (low - slack(low))[row]) & (value <= (high + slack(high))[row])
    return Readings(value, null, row, phase, usable, length)


def median_and_spread(x: np.ndarray) -> tuple[float, float]:
    if not len(x):
        return np.nan, np.nan
    middle = float(np.median(x))
    return middle, SPREAD * float(np.median(np.abs(x - middle)))


def profile_sums(x: np.ndarray, phase: np.ndarray, median: float, spread: float) -> tuple[np.ndarray, np.ndarray]:
    """Sums and numbers of clipped residuals by phase."""
    clipped = np.clip(x - median, -3 * spread, 3 * spread)
    return np.bincount(phase, clipped, BINS).astype(float), np.bincount(phase, minlength=BINS).astype(float)  # whole numbers where there are none


def profile(sums: np.ndarray, counts: np.ndarray, spread: float) -> np.ndarray:
    """Seasonal means, drawn to 0 where readings are few and held within one spread."""
    return np.clip(sums / (counts + 32), -spread, spread)


def tail_sums(residual: np.ndarray, spread: float) -> np.ndarray:
    """Of the low, then of the high tail: number, sum and squares of excesses, and the sums of log(1 + t * excess) for each t of THETAS.

    All add up over parts of a source, and no excess is capped.
    """
    out = []
    for side in (-residual, residual):
        y = side[side > TAIL * spread] - TAIL * spread
        out += [len(y), y.sum(), (y * y).sum(), *(np.log1p(t * y).sum() for t in THETAS / (spread or 1.0))]
    return np.array(out)


@dataclass
class Tail:
    """A generalised Pareto fit of the excesses over a threshold; rate is the share of readings beyond it."""

    count: int
    threshold: float
    shape: float = np.nan
    scale: float = np.nan
    rate: float = np.nan

    @property
    def cutoff(self) -> float:
        """The residual that a reading exceeds with probability RISK; NaN without a fit."""
        ratio = self.rate / RISK
        return self.threshold + self.scale * (np.log(ratio) if abs(self.shape) < 1e-9 else (ratio**self.shape - 1) / self.shape)

    def probability(self, residual: np.ndarray) -> np.ndarray:
        """With which a reading lies further than residual."""
        y = np.maximum(residual - self.threshold, 0) / self.scale
        if abs(self.shape) < 1e-9:
            return self.rate * np.exp(-y)
        with np.errstate(divide="ignore"):
            return self.rate * np.maximum(1 + self.shape * y, 0) ** (-1 / self.shape)


def fit_tail(sums: np.ndarray, readings_: int, spread: float) -> Tail:
    """The fit of one tail from its sums; none from fewer than two excesses.

    Heavy tails by maximum likelihood over the ratios THETAS of shape to scale, where the
    likeliest shape is the mean of log(1 + t * excess); where no ratio is likelier than an
    exponential tail, by moments with a shape from -0.5 to 0.
    """
    count, total, squares = float(sums[0]), float(sums[1]), float(sums[2])
    tail = Tail(int(count), TAIL * spread)
    if count < 2 or not total > 0:
        return tail
    tail.rate = count / readings_
    theta = THETAS / (spread or 1.0)
    shape = np.asarray(sums[3:], float) / count
    likely = -(np.log(shape / theta) + shape + 1)
    mean = total / count
    best = int(np.argmax(likely))
    if likely[best] > -(np.log(mean) + 1):
        tail.shape, tail.scale = float(shape[best]), float(shape[best] / theta[best])
    else:
        variance = max(squares / count - mean * mean, 1e-300)
        tail.shape = float(np.clip(0.5 * (1 - mean * mean / variance), -0.5, 0.0))
        tail.scale = mean * (1 - tail.shape)
    return tail


def candidate_cutoff(tail: Tail, spread: float, season: np.ndarray) -> float:
    """The fit's cutoff, but at most the distance within which the spike rule can hold; that distance without a fit."""
    most = SPIKE_SPREADS * spread - float(np.abs(season).max(initial=0))
    return float(min(max(tail.cutoff, 0.0), most)) if tail.count >= 2 and not np.isnan(tail.cutoff) else most


def kinds_of(r: Readings, rows: slice, flat: slice, median: float, spread: float, season: np.ndarray, low: float, high: float, resolution: np.ndarray, only_candidates: bool = False) -> np.ndarray:
    """Segments by kinds found, as booleans (segments, 3), of one source's rows."""
    n = rows.stop - rows.start
    out = np.zeros((n, 3), bool)
    x, row, usable, null = r.value[flat], r.row[flat] - rows.start, r.usable[flat], r.null[flat]
    if not len(x):
        return out
    out[row[~usable & ~null], 0] = True
    if not np.isnan(median):
        with np.errstate(invalid="ignore"):
            residual = x - median - season[r.phase[flat]]
            candidate = usable & ((residual > high) | (residual < -low))
        if candidate.any():
            # the exact rule, on the segments that hold a candidate
            far = candidate & (np.abs(x - median) > SPIKE_SPREADS * spread)
            edge = np.flatnonzero(np.diff(np.concatenate(([0], far.view(np.int8), [0]))))
            new = np.flatnonzero(far[1:] & far[:-1] & (row[1:] != row[:-1])) + 1  # a run ends with its segment
            begin, end = np.sort(np.concatenate((edge[::2], new))), np.sort(np.concatenate((edge[1::2], new)))
            short = (end - begin) <= SPIKE_LONGEST
            out[row[begin[short]], 1] = True
    long_enough = np.flatnonzero(r.length[rows] >= STUCK_SHORTEST)
    if len(long_enough):
        out[:, 2] = stuck(x, row, r.length[rows], resolution)
    return out


def stuck(x: np.ndarray, row: np.ndarray, length: np.ndarray, resolution: np.ndarray) -> np.ndarray:
    """Which segments hold STUCK_SHORTEST consecutive readings within one resolution of each other."""
    out = np.zeros(len(length), bool)
    if len(x) < STUCK_SHORTEST:
        return out
    step = resolution[row]
    slack = np.abs(x) * TOLERANCE
    with np.errstate(invalid="ignore"):
        calm = (np.abs(np.diff(x)) <= step[1:] + np.maximum(slack[1:], slack[:-1])) & (row[1:] == row[:-1])
    edge = np.flatnonzero(np.diff(np.concatenate(([0], calm.view(np.int8), [0]))))
    a, b = edge[::2], edge[1::2]
    long_enough = b - a + 1 >= STUCK_SHORTEST
    for a, b in zip(a[long_enough], b[long_enough], strict=True):  # runs in which neighbours lie close
        w = np.lib.stride_tricks.sliding_window_view(x[a : b + 1], STUCK_SHORTEST)
        top, bottom = w.max(1), w.min(1)
        if (top - bottom <= step[a] + TOLERANCE * np.maximum(np.abs(top), np.abs(bottom))).any():
            out[row[a]] = True
    return out


def _sources(table: pa.Table, keys: list[str]) -> Iterator[tuple[pa.Table, Readings, slice, slice]]:
    """Each source's rows and readings, copies of a segment left out."""
    table = table.take(pa.array(boundaries(table, [*keys, "segment_id"])))
    r = readings(table)
    starts = boundaries(table, keys)
    bound = np.concatenate(([0], np.cumsum(r.length)))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
        yield table, r, slice(a, b), slice(int(bound[a]), int(bound[b]))


def _resolution(table: pa.Table) -> np.ndarray:
    return pc.fill_null(table["resolution"], np.nan).to_numpy().astype(np.float64)


@dataclass
class Fit:
    """What a source normally shows; cutoffs as distances from median and season."""

    readings: int
    median: float
    spread: float
    season: np.ndarray
    low: Tail
    high: Tail

    @classmethod
    def of(cls, readings_: int, median: float, spread: float, season: np.ndarray, tails: np.ndarray) -> Fit:
        if not readings_:
            return cls(0, np.nan, np.nan, np.zeros(BINS), Tail(0, np.nan), Tail(0, np.nan))
        half = len(tails) // 2
        return cls(readings_, median, spread, season, fit_tail(tails[:half], readings_, spread), fit_tail(tails[half:], readings_, spread))

    @classmethod
    def of_row(cls, get) -> Fit:
        """From the aggregated statistics of a source of many chunks."""
        n = get("readings") or 0
        return cls.of(n, get("median"), get("spread"), np.array(get("season") or [0.0] * BINS), np.array(get("tails") or [0.0] * (2 * (3 + len(THETAS)))))

    def candidates(self) -> tuple[float, float]:
        return candidate_cutoff(self.low, self.spread, self.season), candidate_cutoff(self.high, self.spread, self.season)

    def row(self) -> tuple:
        tails = [x for t in (self.low, self.high) for x in (t.count, t.shape, t.scale)]
        return (self.readings, self.median, self.spread, *tails, self.low.cutoff, self.high.cutoff)


def _fit(r: Readings, flat: slice) -> Fit:
    usable = r.usable[flat]
    x, phase = r.value[flat][usable], r.phase[flat][usable]
    median, spread = median_and_spread(x)
    if not len(x):
        return Fit.of(0, median, spread, np.zeros(BINS), np.zeros(0))
    season = profile(*profile_sums(x, phase, median, spread), spread)
    return Fit.of(len(x), median, spread, season, tail_sums(x - median - season[phase], spread))


def runs_beyond(r: Readings, rows: slice, flat: slice, fit: Fit) -> list[tuple]:
    """(row, side, first sample, readings, peak, cutoff, probability) of the runs of usable readings beyond a tail's own cutoff."""
    out: list[tuple] = []
    if not fit.readings:
        return out
    x, row, usable = r.value[flat], r.row[flat] - rows.start, r.usable[flat]
    at = np.arange(len(x)) - np.repeat(np.cumsum(r.length[rows]) - r.length[rows], r.length[rows])
    with np.errstate(invalid="ignore"):
        residual = x - fit.median - fit.season[r.phase[flat]]
    for side, tail, away in (("low", fit.low, -residual), ("high", fit.high, residual)):
        if tail.count < 2:
            continue
        with np.errstate(invalid="ignore"):
            far = usable & (away > tail.cutoff)
        where = np.flatnonzero(far)
        if not len(where):
            continue
        starts = np.flatnonzero(np.concatenate(([True], (np.diff(where) > 1) | (np.diff(row[where]) > 0))))
        peak = np.maximum.reduceat(away[where], starts)
        size = np.diff(np.concatenate((starts, [len(where)])))
        first = where[starts]
        out += [(int(row[i]), side, int(at[i]), int(n), float(p), tail.cutoff, float(q)) for i, n, p, q in zip(first.tolist(), size.tolist(), peak.tolist(), tail.probability(peak).tolist(), strict=True)]
    return out


def _batch_found(ids: list[np.ndarray], kinds: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids) if ids else [], pa.int64()), pa.array(np.concatenate(kinds) if kinds else [], pa.string())], names=["segment_id", "kind"])


def _batch_fits(out: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in FITS.split(", ")]
    types = [{"string": pa.string(), "long": pa.int64(), "double": pa.float64()}[x.split()[1]] for x in FITS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def _append(out: np.ndarray, table: pa.Table, rows: slice, ids: list, kinds: list) -> None:
    at, kind = np.nonzero(out)
    if len(at):
        ids.append(table["segment_id"].combine_chunks().take(pa.array(at + rows.start)).to_numpy())
        kinds.append(KINDS[kind].astype(object))


def _flag_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, SOURCE):
        ids, kinds = [], []
        for part, r, rows, flat in _sources(table, SOURCE):
            fit = _fit(r, flat)
            _append(kinds_of(r, rows, flat, fit.median, fit.spread, fit.season, *fit.candidates(), _resolution(part)[rows]), part, rows, ids, kinds)
        yield _batch_found(ids, kinds)


def _fit_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, SOURCE):
        out = []
        for part, r, rows, flat in _sources(table, SOURCE):
            out.append((part["edf_path"][rows.start].as_py(), part["channel"][rows.start].as_py(), *_fit(r, flat).row()))
        yield _batch_fits(out)


def _fit_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fits of sources of many chunks from their statistics; as of _fit_whole where no reading is usable."""
    for batch in batches:
        out = [(r["edf_path"], r["channel"], *Fit.of_row(r.get).row()) for r in batch.to_pylist()]
        if out:
            yield _batch_fits(out)


def _value_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, [*SOURCE, "chunk"]):
        for part, r, rows, flat in _sources(table, [*SOURCE, "chunk"]):
            value, n = np.unique(r.value[flat][r.usable[flat]], return_counts=True)
            same = lambda c: pa.array([part[c][rows.start].as_py()] * len(value), pa.string())  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([same("edf_path"), same("channel"), pa.array(value), pa.array(n)], names=[*SOURCE, "value", "n"])


def _partial(what: str):
    """Seasonal sums, or tail sums, of each chunk as (source, k, a, b)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, [*SOURCE, "chunk"]):
            for part, r, rows, flat in _sources(table, [*SOURCE, "chunk"]):
                usable = r.usable[flat]
                x, phase = r.value[flat][usable], r.phase[flat][usable]
                median, spread = part["median"][rows.start].as_py(), part["spread"][rows.start].as_py()
                if what == "season":
                    a, b = profile_sums(x, phase, median, spread)
                else:
                    season = np.array(part["season"][rows.start].as_py())
                    a = tail_sums(x - median - season[phase], spread)
                    b = np.zeros(len(a))
                same = lambda c, n=len(a): pa.array([part[c][rows.start].as_py()] * n, pa.string())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([same("edf_path"), same("channel"), pa.array(np.arange(len(a))), pa.array(a), pa.array(b)], names=[*SOURCE, "k", "a", "b"])

    return work


def _flag_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, [*SOURCE, "chunk"]):
        ids, kinds = [], []
        for part, r, rows, flat in _sources(table, [*SOURCE, "chunk"]):
            get = lambda c: part[c][rows.start].as_py()  # noqa: B023, E731
            fit = Fit.of_row(get)
            _append(kinds_of(r, rows, flat, fit.median, fit.spread, fit.season, *fit.candidates(), _resolution(part)[rows]), part, rows, ids, kinds)
        yield _batch_found(ids, kinds)


def _batch_runs(table: pa.Table, rows: slice, runs: list[tuple]) -> pa.RecordBatch:
    ids = table["segment_id"].combine_chunks().take(pa.array([k + rows.start for k, *_ in runs], pa.int64()))
    types = [pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
    columns = zip(zip(*[x[1:] for x in runs], strict=True), types, strict=True)
    return pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in columns]], names=[x.split()[0] for x in RUNS.split(", ")])


def _runs(keys: list[str], fit_of):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            for part, r, rows, flat in _sources(table, keys):
                if runs := runs_beyond(r, rows, flat, fit_of(part, r, rows, flat)):
                    yield _batch_runs(part, rows, runs)

    return work


def _placed(segments: DataFrame, master: DataFrame, recordings: DataFrame, chunk_segments: int) -> tuple[DataFrame, bool]:
    """Segments with source, chunk, range and resolution; whether any source has several chunks.

    Keys and headers are joined and written first, so the readings are shuffled only to their
    segment's row and to their source.
    """
    channel = master.where("master_id is not null").groupBy("master_id").agg(F.min(clean_channel(F.col("channel"))).alias("channel"))
    header = recordings.where("edf_path is not null").groupBy("edf_path").agg(*[F.max(c).cast("double").alias(c) for c in ("physical_min", "physical_max", "resolution")])
    ids = segments.where("segment_id is not null").groupBy("segment_id").agg(F.min(F.struct("edf_path", "master_id")).alias("_s")).select("segment_id", "_s.*")
    known = ids.join(channel, "master_id", "left").join(header, "edf_path", "left").drop("master_id")
    many = known.groupBy(*SOURCE).agg(F.ceil(F.count(F.lit(1)) / chunk_segments).cast("int").alias("_chunks")).where("_chunks > 1").withColumnsRenamed({c: f"_{c}" for c in SOURCE})
    same = known["edf_path"].eqNullSafe(many["_edf_path"]) & known["channel"].eqNullSafe(many["_channel"])
    chunks = F.coalesce("_chunks", F.lit(1))
    dims = known.join(many, same, "left").select("segment_id", *SOURCE, "physical_min", "physical_max", "resolution", (chunks > 1).alias("split"), F.pmod(F.xxhash64("segment_id"), chunks).cast("int").alias("chunk"))
    dims = materialize(dims, "segment-sources")
    full = segments.select("segment_id", F.col("segment").cast("array<float>").alias("segment"), F.col("seg_start_sample").cast("long").alias("seg_start_sample")).join(dims, "segment_id")
    return full, not dims.where("split").isEmpty()


def _sorted(df: DataFrame) -> DataFrame:
    return df.repartition(*SOURCE, "chunk").sortWithinPartitions(*SOURCE, "chunk", "segment_id")


def _with_statistics(split: DataFrame) -> DataFrame:
    """Rows of sources of many chunks with the source's statistics."""

    def add(rows: DataFrame, stats: DataFrame) -> DataFrame:
        stats = stats.withColumnsRenamed({c: f"_{c}" for c in SOURCE})
        same = F.col("edf_path").eqNullSafe(F.col("_edf_path")) & F.col("channel").eqNullSafe(F.col("_channel"))
        return rows.join(stats, same, "left").drop("_edf_path", "_channel")

    group = "edf_path string, channel string, "
    counts = _sorted(split).mapInArrow(_value_counts, group + "value double, n long").groupBy(*SOURCE, "value").agg(F.sum("n").alias("n"))
    # distinct readings of a source are bounded by its range over its resolution
    middle = counts.groupBy(*SOURCE).agg(F.percentile("value", F.lit(0.5), F.col("n")).alias("median"), F.sum("n").alias("readings"))
    off = add(counts, middle).withColumn("off", F.abs(F.col("value") - F.col("median")))
    spread = off.groupBy(*SOURCE).agg((F.percentile("off", F.lit(0.5), F.col("n")) * SPREAD).alias("spread"), F.first("median").alias("median"), F.first("readings").alias("readings"))
    rows = add(split, spread)
    usable = rows.where("median is not null")
    sums = _sorted(usable).mapInArrow(_partial("season"), group + "k long, a double, b double").groupBy(*SOURCE, "k").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    raw = sums.groupBy(*SOURCE).agg(F.array_sort(F.collect_list(F.struct("k", "a", "b"))).alias("s"))
    season = add(raw, spread.select(*SOURCE, "spread")).select(*SOURCE, F.transform("s", lambda s: F.greatest(F.least(s["a"] / (s["b"] + 32), F.col("spread")), -F.col("spread"))).alias("season"))
    seasonal = add(rows, season)
    tails = _sorted(seasonal.where("median is not null")).mapInArrow(_partial("tail"), group + "k long, a double, b double").groupBy(*SOURCE, "k").agg(F.sum("a").alias("a"))
    tails = tails.groupBy(*SOURCE).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "a"))), lambda s: s["a"]).alias("tails"))
    return add(seasonal, tails)


def implausible(segments: DataFrame, master: DataFrame, recordings: DataFrame, chunk_segments: int = CHUNK_SEGMENTS) -> DataFrame:
    """(segment_id, kind), once per distinct segment and kind.

    impossible: a reading that is not finite or outside the recording's range (a millionth
    allowed); spike: 1 to 5 consecutive readings within range further than ten spreads from the
    source's median, between readings that are not, or an edge, null or impossible reading;
    stuck: 32 or more consecutive readings within one resolution of each other. A null reading
    is no case and ends a run. Null or empty segments have no kind. A recording without header
    row has an open range and no resolution; a segment without master row belongs to the
    source of its path without channel. Rows that share a segment_id count once; rows without
    segment_id are left out. With a spread of 0 every reading off the median is far.
    """
    full, any_split = _placed(segments, master, recordings, chunk_segments)
    whole = _sorted(full.where(~F.col("split"))).mapInArrow(_flag_whole, FOUND)
    if not any_split:
        return whole
    parts = _with_statistics(full.where("split"))
    return whole.unionByName(_sorted(parts).mapInArrow(_flag_chunks, FOUND)).distinct()


def tail_fits(segments: DataFrame, master: DataFrame, recordings: DataFrame, chunk_segments: int = CHUNK_SEGMENTS) -> DataFrame:
    """Median, spread, tail fits and cutoffs of each source, once."""
    full, any_split = _placed(segments, master, recordings, chunk_segments)
    whole = _sorted(full.where(~F.col("split"))).mapInArrow(_fit_whole, FITS)
    if not any_split:
        return whole
    stats = ["median", "spread", "readings", "season", "tails"]
    sources = _with_statistics(full.where("split")).groupBy(*SOURCE).agg(*[F.first(c).alias(c) for c in stats])
    return whole.unionByName(sources.mapInArrow(_fit_sums, FITS))


def exceedances(segments: DataFrame, master: DataFrame, recordings: DataFrame, chunk_segments: int = CHUNK_SEGMENTS) -> DataFrame:
    """(segment_id, side, first_sample, readings, peak, cutoff, probability): runs of readings beyond their source's fitted cutoffs.

    Here the fits alone decide: a run is consecutive usable readings whose residual (reading
    less median and season) lies further on one side than the tail's cutoff at RISK. peak is the
    run's furthest residual, probability that of a reading further out under the fit. Sources
    with fewer than two excesses on a side have no fit there and no run.
    """
    full, any_split = _placed(segments, master, recordings, chunk_segments)
    whole = _sorted(full.where(~F.col("split"))).mapInArrow(_runs(SOURCE, lambda part, r, rows, flat: _fit(r, flat)), RUNS)
    if not any_split:
        return whole
    parts = _with_statistics(full.where("split"))
    given = lambda part, r, rows, flat: Fit.of_row(lambda c: part[c][rows.start].as_py())
    return whole.unionByName(_sorted(parts).mapInArrow(_runs([*SOURCE, "chunk"], given), RUNS))
