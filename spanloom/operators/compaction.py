"""Many tiny files into few files of good size by joining their bytes (problem 4).

A tiny file is a newline-delimited payload, or a zstandard frame of one. Frames are complete
and carry their length and checksum, so a large file is the concatenation of frames: nothing is
parsed. Which copy of a record stays is decided on the index of keys alone; the other copies'
lines are dropped where their file's frame is made.

Each task appends what it is given to one file after another, begins a new one before a file
would grow beyond the target, reads every file back against its length and checksum, and only
then moves it in place. A retried task writes the same files again.
"""

from __future__ import annotations

import posixpath
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions.arrow_groups import boundaries, whole_groups
from spanloom.session import materialize, scratch

#: Bytes that a consolidated file should have.
TARGET_BYTES = 64 << 20
#: Lines of one file that are held together, and bytes of lines that make a frame; a file of more becomes several frames.
FRAME_LINES, FRAME_BYTES = 20_000, 8 << 20
#: Files of more lines than that are broadcast up to this number, else joined by shuffle.
BROADCAST_FILES = 10_000

FRAMES = "file_id long, part int, records long, raw_bytes long, crc long, frame binary, dropped array<long>"
MANIFEST = "name string, file_id long, part int, at long, bytes long, records long, raw_bytes long, crc long, dropped array<long>"
JOINED = "name string, sources long, bytes long, lines long, crc long"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frames from rows sorted by file, part and key; a row without line marks its key's lines in the file as copies."""
    packer = zstandard.ZstdCompressor(level=1, write_checksum=True, write_content_size=True)
    for table in whole_groups(batches, ["file_id", "part"]):
        starts = boundaries(table, ["file_id", "part"])
        again = np.ones(table.num_rows, bool)
        again[boundaries(table, ["file_id", "part", "key"])] = False
        again &= pc.is_valid(table["key"]).to_numpy()
        kept = ~again & pc.is_valid(table["line"]).to_numpy()
        size = np.where(kept, pc.fill_null(pc.binary_length(table["line"]), 0).to_numpy() + 1, 0)
        rows = []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
            piece = (np.cumsum(size[a:b]) - size[a:b]) // FRAME_BYTES  # a line lies whole in one frame
            edges = [a, *(a + np.flatnonzero(np.diff(piece)) + 1).tolist(), b]
            for x, y in zip(edges, edges[1:], strict=False):
                lines = table["line"].slice(x, y - x).filter(pa.array(kept[x:y])).to_pylist()
                raw = b"".join(line.encode() + b"\n" for line in lines)
                dropped = table["key"].slice(x, y - x).filter(pa.array(again[x:y])).to_pylist()
                rows.append((table["file_id"][x].as_py(), table["part"][x].as_py(), len(lines), len(raw), zlib.crc32(raw), packer.compress(raw) if lines else b"", dropped))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _schema(FRAMES), strict=True)], schema=_schema(FRAMES))


def frames_of_records(records: DataFrame, key: str, file_id: str, written_at: str, body: list[str], tasks: int) -> DataFrame:
    """One zstandard frame per tiny file (and part, where a file holds very many lines).

    Of the rows that share a key the earliest by (written_at, file_id) stays, once; the keys of
    the others are listed in dropped. A null key is no identity: such rows all stay. Rows of a
    null file_id count as one file. The line of a record is the JSON text of body. Records are
    shuffled once, to one of the tasks by their file; what to drop comes as marks by file and
    key, made from the keys alone.
    """
    at = F.struct(F.col(written_at).alias("at"), F.col(file_id).alias("file"))
    ids = records.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(file_id).alias("file_id"), at.alias("_at"))
    first = ids.groupBy("key").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key", F.col("_first.file").alias("_stays"))
    marks = ids.join(first, "key").where(~F.col("file_id").eqNullSafe(F.col("_stays"))).select("file_id", "key").distinct()

    large = records.groupBy(F.col(file_id).alias("file_id")).agg(F.ceil(F.count(F.lit(1)) / FRAME_LINES).cast("int").alias("_parts")).where("_parts > 1")
    large = materialize(large, "large-files")
    many = large.count()

    def with_part(rows: DataFrame, spread: Column) -> DataFrame:
        if not many:
            return rows.withColumn("part", F.lit(0))
        parts = F.broadcast(large) if many <= BROADCAST_FILES else large
        return rows.join(parts, "file_id", "left").withColumn("part", F.pmod(spread, F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")

    wide = records.select(F.col(file_id).alias("file_id"), F.col(key).alias("key"), F.col(written_at).alias("at"), F.struct(key, *body).alias("body"))
    wide = with_part(wide, F.coalesce(F.xxhash64("key"), F.xxhash64("body")) if many else F.lit(0))
    marked = with_part(marks, F.xxhash64("key")).select("file_id", "key", F.lit(None).cast(wide.schema["at"].dataType).alias("at"), F.lit(None).cast(wide.schema["body"].dataType).alias("body"), "part")
    rows = wide.unionByName(marked).repartition(tasks, "file_id", "part")
    # a mark has no time and sorts before the lines of its key; equal rows are the same in any order
    rows = rows.select("file_id", "part", "key", "at", F.to_json("body").alias("line"))
    rows = rows.sortWithinPartitions("file_id", "part", "key", F.col("line").isNotNull(), "at", "line").select("file_id", "part", "key", "line")
    return rows.mapInArrow(_frames, FRAMES)


class Roll:
    """Files below a folder, each written under a hidden name, read back and moved in place when it is full."""

    def __init__(self, target: str, suffix: str, target_bytes: int):
        from pyarrow import fs

        self.system, self.root = fs.FileSystem.from_uri(target)
        self.suffix, self.most = suffix, target_bytes
        task = TaskContext.get()
        self.stem, self.attempt = f"part-{task.partitionId():06d}", task.taskAttemptId()
        self.number, self.out = 0, None
        self.size = self.crc = 0

    def full(self, more: int) -> bool:
        """Whether more bytes would make the open file too large."""
        return self.out is not None and self.size > 0 and self.size + more > self.most

    @property
    def name(self) -> str:
        return f"{self.stem}-{self.number:06d}{self.suffix}"

    @property
    def hidden(self) -> str:
        return posixpath.join(self.root, f".{self.name}.{self.attempt}")

    def write(self, content: bytes) -> None:
        if self.out is None:
            self.out, self.size, self.crc = self.system.open_output_stream(self.hidden, compression=None), 0, 0
        self.out.write(content)
        self.size, self.crc = self.size + len(content), zlib.crc32(content, self.crc)

    def close(self) -> tuple[str, int, int]:
        """Name, bytes and checksum of the file now in place; OSError if what was written reads otherwise."""
        self.out.close()
        crc, size = 0, 0
        with self.system.open_input_stream(self.hidden, compression=None) as back:
            while chunk := back.read(1 << 22):
                crc, size = zlib.crc32(chunk, crc), size + len(chunk)
        if (size, crc) != (self.size, self.crc):
            raise OSError(f"{self.name}: written bytes differ")
        self.system.move(self.hidden, posixpath.join(self.root, self.name))
        told = self.name, size, crc
        self.out, self.number = None, self.number + 1
        return told


def _joined(target: str, target_bytes: int):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, reader = Roll(target, ".ndjson.zst", target_bytes), zstandard.ZstdDecompressor()
        rows: list[tuple] = []

        def done() -> pa.RecordBatch:
            name = roll.close()[0] if roll.out is not None else None
            out = [(name if r[3] else None, *r) for r in rows]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _schema(MANIFEST), strict=True)], schema=_schema(MANIFEST))

        for batch in batches:
            for r in batch.to_pylist():
                frame = r["frame"]
                if frame:
                    raw = reader.decompress(frame)  # fails on a wrong checksum
                    if len(raw) != r["raw_bytes"] or zlib.crc32(raw) != r["crc"]:
                        raise OSError(f"file {r['file_id']}: the frame does not hold what was put in")
                    if roll.full(len(frame)):
                        yield done()
                at = roll.size if roll.out is not None else 0
                if frame:
                    roll.write(frame)
                rows.append((r["file_id"], r["part"], at, len(frame), r["records"], r["raw_bytes"], r["crc"], r["dropped"]))
        if rows:
            yield done()

    return join


def consolidate_segments(segments: DataFrame, files: DataFrame, target: str | None = None, target_bytes: int = TARGET_BYTES) -> tuple[str, DataFrame]:
    """The records of segments from their tiny files into few below target, each segment_id once.

    Returns the folder and the manifest, a written table with a row for each frame: file name,
    place and length of the frame in it, tiny file, records, and keys of the copies dropped.
    target unset is a new folder of this application. Files are at most target_bytes, or one
    frame, long; there are at most as many smaller ones as tasks, one for target_bytes of the
    index. Rows lost or gained raise ValueError. An empty table gives no file.
    """
    from pyarrow import fs

    target = target or f"{scratch(segments.sparkSession)}/consolidated-{uuid.uuid4().hex}"
    system, root = fs.FileSystem.from_uri(target)
    system.create_dir(root, recursive=True)
    total = files.agg(F.sum("n_bytes")).first()[0] or 0
    body = [c for c in segments.columns if c not in ("segment_id", "file_id", "written_at")]
    frames = frames_of_records(segments, "segment_id", "file_id", "written_at", body, max(1, -(-int(total) // target_bytes)))
    manifest = materialize(frames.mapInArrow(_joined(target, target_bytes), MANIFEST), "manifest")
    kept, dropped = manifest.agg(F.coalesce(F.sum("records"), F.lit(0)), F.coalesce(F.sum(F.size("dropped")), F.lit(0))).first()
    given = segments.count()
    if kept + dropped != given:
        raise ValueError(f"of {given} records {kept} were kept and {dropped} dropped")
    return target, manifest


def file_sizes(manifest: DataFrame) -> DataFrame:
    """(name, frames, records, raw_bytes, bytes, copies_dropped) of each consolidated file; a null name for frames of which nothing was left."""
    total = lambda c: F.sum(c).alias(c)
    return manifest.groupBy("name").agg(F.count(F.lit(1)).alias("frames"), total("records"), total("raw_bytes"), total("bytes"), F.sum(F.size("dropped")).alias("copies_dropped"))


def repeated_keys(manifest: DataFrame) -> DataFrame:
    """Keys of which consolidation dropped further copies, each once."""
    return manifest.select(F.explode("dropped").alias("key")).where("key is not null").distinct()


def read_consolidated(target: str, manifest: DataFrame) -> DataFrame:
    """(line) of all records in the consolidated files, read from the files frame after frame."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(target)
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for name in batch[0].to_pylist():
                with system.open_input_stream(posixpath.join(root, name), compression=None) as f, reader.stream_reader(f, read_across_frames=True) as lines:
                    rest = b""
                    while chunk := lines.read(1 << 22):
                        *whole, rest = (rest + chunk).split(b"\n")
                        yield pa.RecordBatch.from_arrays([pa.array(whole, pa.binary()).cast(pa.string())], names=["line"])
                    if rest:
                        raise OSError(f"{name}: the last line is cut")

    names = manifest.where("name is not null").select("name").distinct()
    return names.mapInArrow(read, "line string")


def _pieces(stream, size: int = 1 << 22) -> Iterator[bytes]:
    while chunk := stream.read(size):
        yield chunk


def _without_header(pieces: Iterable[bytes], lines: int) -> tuple[bytes, Iterator[bytes]]:
    """The first lines of a stream, and what follows them."""
    pieces = iter(pieces)
    held = b""
    for piece in pieces:
        held += piece
        if held.count(b"\n") >= lines:
            break
    cut = 0
    for _ in range(lines):
        cut = held.find(b"\n", cut) + 1 or len(held)

    def rest() -> Iterator[bytes]:
        if held[cut:]:
            yield held[cut:]
        yield from pieces

    return held[:cut], rest()


def _write(target: str, header_lines: int, suffix: str, target_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        roll, text = Roll(target, suffix, target_bytes), suffix != ".zst"
        sources = lines = 0
        head: bytes | None = None

        def done() -> pa.RecordBatch:
            name, size, crc = roll.close()
            return pa.RecordBatch.from_pylist([{"name": name, "sources": sources, "bytes": size, "lines": lines, "crc": crc}], schema=_schema(JOINED))

        for batch in batches:
            for path, length in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                if roll.full(length):
                    yield done()
                    sources = lines = 0
                    head = None
                system, place = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
                sources += 1
                with system.open_input_stream(place, compression=None) as f:
                    pieces: Iterable[bytes] = _pieces(f)
                    if text and header_lines:
                        own, pieces = _without_header(pieces, header_lines)
                        if head is None:
                            head = own
                            pieces = _chained(own, pieces)
                        elif own != head:
                            raise ValueError("files with different headers can't be joined")
                    last, read = b"\n", 0
                    for piece in pieces:
                        roll.write(piece)
                        read, last = read + len(piece), piece[-1:]
                        lines += piece.count(b"\n") if text else 0
                    if text and last != b"\n":  # a line that lacks its end
                        roll.write(b"\n")
                        lines += 1
        if roll.out is not None:
            yield done()

    return write


def _chained(first: bytes, rest: Iterable[bytes]) -> Iterator[bytes]:
    if first:
        yield first
    yield from rest


def compact_directory(spark: SparkSession, source: str, target: str, glob: str = "*", suffix: str = ".ndjson", header_lines: int = 0, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Join the files below source into files of about target_bytes below target; lazily, a manifest.

    suffix .zst joins complete zstandard frames; any other suffix joins newline-delimited text,
    adding a missing last newline and keeping header_lines lines once per file. Only paths and
    lengths are shuffled; the bytes are streamed by the task that writes them, so files may be
    of any length. Empty files add nothing. Files are read back after writing and moved in
    place only when length and checksum agree. Sources stay.
    """
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(target)
    system.create_dir(root, recursive=True)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(source).select("path", "length")
    total = files.select(F.sum("length")).first()[0] or 0
    placed = files.where("length > 0").repartition(max(1, -(-int(total) // target_bytes)), "path").sortWithinPartitions("path")
    return placed.mapInArrow(_write(target, header_lines, suffix, target_bytes), JOINED)
