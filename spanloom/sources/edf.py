"""European Data Format files as a Spark data source.

    spark.dataSource.register(EdfSource)
    spark.read.format("edf").option("mode", "header").load(path)
    spark.read.format("edf").option("mode", "signal").option("channels", "FP1,F7").load(path)

A partition is a file, or several of very many, read record by record, so a task holds one block of one file. The
path may be a file, a folder (searched in depth) or a pattern, on any file system that pyarrow
opens. Signals come in physical units of the file. Channels are compared by their normalised
names. mode header reads headers only; a file that can't be read gives a row with its error.
"""

from __future__ import annotations

import fnmatch
import posixpath
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from spanloom.functions.channels import KIND, REFERENCE, normalized

HEADER = "path string, channel string, sfreq double, n_times long, duration_s double, physical_dim string, physical_min double, physical_max double, digital_min int, digital_max int, error string"
SIGNAL = "path string, channel string, sfreq double, block int, start_sample long, samples array<float>"
#: Partitions of a read at most; of more files each partition reads several, one after another.
MOST_PARTITIONS = 10_000
#: Seconds of signal in a block, about.
BLOCK_SECONDS = 60


def plain_name(name: str) -> str:
    return re.sub(r"\s+", "", re.sub(REFERENCE, "", re.sub(KIND, "", name.strip().upper())))


@dataclass
class Header:
    """The fixed ASCII header: 256 bytes, then 256 bytes a signal, field by field."""

    records: int
    seconds: float
    labels: list[str]
    dims: list[str]
    physical: np.ndarray
    digital: np.ndarray
    counts: list[int]
    size: int

    @classmethod
    def read(cls, f) -> Header:
        head = f.read(256).decode("latin-1")
        if len(head) < 256:
            raise ValueError("header is cut short")
        signals = int(head[252:256])
        body = f.read(256 * signals).decode("latin-1")
        if len(body) < 256 * signals:
            raise ValueError("header is cut short")
        at = 0
        fields = []
        for width in (16, 80, 8, 8, 8, 8, 8, 80, 8, 32):
            fields.append([body[at + i * width : at + (i + 1) * width].strip() for i in range(signals)])
            at += width * signals
        label, _, dim, pmin, pmax, dmin, dmax, _, count, _ = fields
        number = lambda a, b: np.array([[float(x) for x in a], [float(x) for x in b]])
        return cls(int(head[236:244]), float(head[244:252]), label, dim, number(pmin, pmax), number(dmin, dmax), [int(x) for x in count], 256 * (signals + 1))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.mode = options["path"], options.get("mode", "header")
        chosen = options.get("channels")
        self.channels = {plain_name(c) for c in chosen.split(",")} if chosen else None

    def _files(self) -> list[str]:
        from pyarrow import fs

        pattern = None
        path = self.path
        if any(c in posixpath.basename(path) for c in "*?["):
            path, pattern = posixpath.split(path)
        system, root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        info = system.get_file_info(root)
        if info.type == fs.FileType.File:
            return [root]
        found = [x.path for x in system.get_file_info(fs.FileSelector(root, recursive=True)) if x.type == fs.FileType.File]
        return sorted(x for x in found if (fnmatch.fnmatch(posixpath.basename(x), pattern) if pattern else x.lower().endswith(".edf")))

    def partitions(self) -> list[InputPartition]:
        files = self._files()
        size = max(1, -(-len(files) // MOST_PARTITIONS))
        return [InputPartition(files[i : i + size]) for i in range(0, len(files), size)] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for path in partition.value:
            yield from self._read(path)

    def _read(self, path: str) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path else fs.LocalFileSystem()
        with system.open_input_stream(path, compression=None) as f:
            try:
                h = Header.read(f)
            except ValueError as e:
                if self.mode == "header":
                    yield pa.RecordBatch.from_pylist([{"path": path, "error": str(e)}], schema=_arrow(HEADER))
                    return
                raise
            chosen = [i for i, name in enumerate(h.labels) if not name.startswith("EDF Annotations") and (self.channels is None or plain_name(name) in self.channels)]
            rate = [c / h.seconds if h.seconds else float(c) for c in h.counts]
            if self.mode == "header":
                rows = [{"path": path, "channel": h.labels[i], "sfreq": rate[i], "n_times": h.counts[i] * h.records, "duration_s": h.records * h.seconds, "physical_dim": h.dims[i], "physical_min": h.physical[0, i], "physical_max": h.physical[1, i], "digital_min": int(h.digital[0, i]), "digital_max": int(h.digital[1, i]), "error": None} for i in chosen]
                yield pa.RecordBatch.from_pylist(rows, schema=_arrow(HEADER))
                return
            width = sum(h.counts)
            edge = np.concatenate(([0], np.cumsum(h.counts)))
            scale = (h.physical[1] - h.physical[0]) / (h.digital[1] - h.digital[0])
            per_block = max(1, int(BLOCK_SECONDS / h.seconds)) if h.seconds else 1
            block = 0
            while raw := f.read(2 * width * per_block):
                data = np.frombuffer(raw[: len(raw) // (2 * width) * 2 * width], "<i2").reshape(-1, width)
                if not len(data):
                    break
                rows = []
                for i in chosen:
                    x = (data[:, edge[i] : edge[i + 1]].reshape(-1) - h.digital[0, i]) * scale[i] + h.physical[0, i]
                    rows.append({"path": path, "channel": h.labels[i], "sfreq": rate[i], "block": block, "start_sample": block * per_block * h.counts[i], "samples": x.astype(np.float32)})
                yield pa.RecordBatch.from_pylist(rows, schema=_arrow(SIGNAL))
                block += 1


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "double": pa.float64(), "long": pa.int64(), "int": pa.int32(), "array<float>": pa.list_(pa.float32())}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


class EdfSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "edf"

    def schema(self) -> str:
        return HEADER if self.options.get("mode", "header") == "header" else SIGNAL

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def recordings_of(blocks: DataFrame) -> DataFrame:
    """(edf_path, channel, sfreq, samples): whole signals from the blocks of mode signal, channels by their plain names.

    A recording's channel is bounded by its duration. Of two channels that plain names make
    alike the first by label counts. Blocks given twice count once.
    """
    named = blocks.select("path", "channel", "sfreq", "start_sample", "samples").dropDuplicates(["path", "channel", "start_sample"])
    whole = named.groupBy("path", "channel").agg(F.first("sfreq").alias("sfreq"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start_sample", "samples"))), lambda b: b["samples"])).alias("samples"))
    plain = whole.withColumn("_plain", normalized(F.col("channel")))
    one = plain.groupBy("path", "_plain").agg(F.min_by(F.struct("sfreq", "samples"), "channel").alias("_s"))
    return one.select(F.col("path").alias("edf_path"), F.col("_plain").alias("channel"), "_s.sfreq", "_s.samples")
