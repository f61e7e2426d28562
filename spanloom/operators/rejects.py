"""Lines of annotation files as typed rows, and the lines that can't be, with the reason (problem 3).

A batch of lines is indexed as one byte buffer: a quote mask and its running parity tell which
commas lie outside quotes, from which record and field bounds follow; counts and types of the
fields then decide each line. Nothing looks at a line by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the file format.
FIELDS = 5
HEADER_LINES = 6
DURATION_LINE = 3
NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
DURATION = rf"duration[ \t]*=[ \t]*(?P<secs>{NUMBER})[ \t]*secs[ \t]*\r?$"

PARSED = "line_id long, csv_bi_path string, line_no int, channel string, start_time double, end_time double, label string, confidence string, duration double, reason string"


def _numbers(texts: pa.Array) -> np.ndarray:
    """Doubles of those texts that are one plain decimal number, else NaN."""
    plain = pc.fill_null(pc.match_substring_regex(texts, rf"^[ \t]*{NUMBER}[ \t]*$"), False)
    bare = pc.replace_substring_regex(pc.utf8_trim(texts, " \t"), r"^\+", "")
    bare = pc.if_else(plain, bare, pa.scalar(None, pa.string()))
    return pc.fill_null(pc.cast(bare, pa.float64()), np.nan).to_numpy(zero_copy_only=False)


def structural_index(lines: pa.Array) -> dict[str, np.ndarray]:
    """Field bounds and quoting of each line of a string array (nulls count as empty lines).

    fields: number of fields parted by commas outside quotes; broken: whether a quote is open
    at the end, stands inside an unquoted field, or single within a quoted one; first: index of
    the line's first field; begin, end: bytes of each field, without an outer carriage return.
    """
    lines = pc.fill_null(lines, "").cast(pa.large_binary())
    _, offsets, data = lines.buffers()
    offset = np.frombuffer(offsets, np.int64)[lines.offset : lines.offset + len(lines) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    begin, end = offset[:-1], offset[1:].copy()
    last = np.maximum(end - 1, 0)
    if len(data):
        end -= (end > begin) & (data[last] == 13)
    quote = data == 34
    parity = np.concatenate(([0], np.cumsum(quote)))
    comma = np.flatnonzero(data == 44)
    comma = comma[(comma >= offset[0]) & (comma < offset[-1])]
    line = np.searchsorted(offset, comma, "right") - 1
    outside = (parity[comma] - parity[begin[line]]) % 2 == 0
    comma, line = comma[outside], line[outside]
    fields = 1 + np.bincount(line, minlength=len(begin))
    first = np.concatenate(([0], np.cumsum(fields)))[:-1].astype(np.int64)
    start = np.empty(int(fields.sum()), np.int64)
    stop = np.empty_like(start)
    start[first], stop[first + fields - 1] = begin, end
    at = np.arange(len(comma)) + line  # index of the field that ends at each comma
    stop[at], start[at + 1] = comma, comma + 1
    count = parity[stop] - parity[start]
    has = count > 0
    safe = np.minimum(start, max(len(data) - 1, 0))
    tail = np.maximum(stop - 1, 0)
    bad = np.zeros(len(start), bool)
    if len(data):
        bad = has & ((data[safe] != 34) | (data[tail] != 34) | (count % 2 == 1))
        where = np.flatnonzero(quote)
        inner = np.flatnonzero(has & ~bad & (count > 2))
        if len(inner):  # quotes between the outer two must stand in adjacent pairs
            many = count[inner] - 2
            base = np.repeat(parity[start[inner]] + 1, many // 2)
            step = np.arange(int((many // 2).sum())) - np.repeat(np.cumsum(many // 2) - many // 2, many // 2)
            k = base + 2 * step
            apart = where[k + 1] != where[k] + 1
            bad[inner] |= np.add.reduceat(apart, np.concatenate(([0], np.cumsum(many // 2)[:-1]))) > 0
    broken = np.add.reduceat(bad, first) > 0 if len(first) else np.zeros(0, bool)
    return {"fields": fields, "broken": broken, "first": first, "begin": start, "end": stop, "data": data}


def _field(index: dict[str, np.ndarray], rows: np.ndarray, k: int) -> pa.Array:
    """Texts of field k of the given lines, outer quotes removed and inner ones undoubled."""
    at = index["first"][rows] + k
    begin, end, data = index["begin"][at], index["end"][at], index["data"]
    quoted = (end > begin) & (data[np.minimum(begin, max(len(data) - 1, 0))] == 34) if len(data) else np.zeros(len(at), bool)
    begin, size = begin + quoted, end - begin - 2 * quoted
    edge = np.concatenate(([0], np.cumsum(size)))
    inner = data[np.arange(int(edge[-1])) + np.repeat(begin - edge[:-1], size)]
    texts = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(inner)))
    return pc.replace_substring(texts, '""', '"').cast(pa.string()) if quoted.any() else texts.cast(pa.string())


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        text, no = batch["line_text"], pc.fill_null(batch["line_no"], HEADER_LINES + 1).to_numpy(zero_copy_only=False)
        filled = pc.fill_null(text, "")
        blank = pc.match_substring_regex(filled, r"^\s*$").to_numpy(zero_copy_only=False)
        remark = pc.starts_with(filled, "#").to_numpy(zero_copy_only=False)
        body = (no > HEADER_LINES) & ~blank & ~remark
        rows = np.flatnonzero(body)
        reason = np.full(n, None, object)
        out = {k: np.full(n, None, object) for k in ("channel", "label", "confidence")}
        start, stop, duration = (np.full(n, np.nan) for _ in range(3))
        if len(rows):
            index = structural_index(filled.take(pa.array(rows)))
            broken, wrong = index["broken"], index["fields"] != FIELDS
            reason[rows[wrong]] = "wrong_column_count"
            reason[rows[broken]] = "broken_quoting"
            good = np.flatnonzero(~broken & ~wrong)
            a, b = _numbers(_field(index, good, 1)), _numbers(_field(index, good, 2))
            valid = np.isfinite(a) & np.isfinite(b) & (a >= 0) & (b >= a)
            reason[rows[good[~valid]]] = "invalid_value"
            kept = good[valid]
            start[rows[kept]], stop[rows[kept]] = a[valid], b[valid]
            for k, name in ((0, "channel"), (3, "label"), (4, "confidence")):
                out[name][rows[kept]] = _field(index, kept, k).to_numpy(zero_copy_only=False)
        heads = np.flatnonzero(no == DURATION_LINE)
        if len(heads):
            value = _numbers(pc.struct_field(pc.extract_regex(filled.take(pa.array(heads)), DURATION), "secs"))
            valid = np.isfinite(value) & (value > 0)
            duration[heads[valid]] = value[valid]
            reason[heads[~valid]] = "invalid_value"
        real = lambda x: pa.array(x, pa.float64(), mask=np.isnan(x))
        text_of = lambda x: pa.array(x, pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch["line_id"], batch["csv_bi_path"], batch["line_no"], text_of(out["channel"]), real(start), real(stop), text_of(out["label"]), text_of(out["confidence"]), real(duration), text_of(reason)],
            names=[x.split()[0] for x in PARSED.split(", ")],
        )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Every line with its parsed values or its reason.

    lines: line_id, csv_bi_path, line_no, line_text (further columns are left out). reason is
    the first of broken_quoting, wrong_column_count, invalid_value that holds, else null. Header
    lines but the third, blank lines and lines beginning with # are never rejected and have no
    values; so does a null text, which counts as blank. A null line_no counts as a line after
    the header. A number too large for a double is an invalid value. An empty table gives an
    empty one; repeated lines are each judged.
    """
    wanted = lines.select(F.col("line_id").cast("long"), F.col("csv_bi_path").cast("string"), F.col("line_no").cast("int"), F.col("line_text").cast("string"))
    return wanted.mapInArrow(_parse, PARSED)


def rows_and_durations(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The valid rows, and (csv_bi_path, duration) of files whose third line holds one; each line is parsed once."""
    heads = parse_lines(lines.where(F.col("line_no") == DURATION_LINE))
    durations = heads.where("duration is not null").groupBy("csv_bi_path").agg(F.max("duration").alias("duration"))
    body = parse_lines(lines.where((F.col("line_no") > HEADER_LINES) | F.col("line_no").isNull()))
    return body.where("start_time is not null").drop("duration", "reason"), durations


def rejected_lines(lines: DataFrame) -> DataFrame:
    """(line_id, csv_bi_path, line_no, reason) of the lines that can't be loaded."""
    return parse_lines(lines).where("reason is not null").select("line_id", "csv_bi_path", "line_no", "reason")


def loaded_rows(lines: DataFrame) -> DataFrame:
    """The valid rows with start_time, end_time and their file's duration.

    A file whose third line is rejected or missing gives its rows with a null duration. Of
    several duration lines of one path (a file delivered twice) the greatest value counts.
    """
    rows, durations = rows_and_durations(lines)
    same = rows["csv_bi_path"].eqNullSafe(durations["csv_bi_path"])
    return rows.join(durations, same, "left").select(*[rows[c] for c in rows.columns], durations["duration"])
