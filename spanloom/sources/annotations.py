"""Annotation files and inventories of recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import labels

REQUIRED = ("label", "start_time", "stop_time", "channel")


def inventory(spark: SparkSession, root: str, glob: str = "*.{edf,csv,csv_bi}") -> DataFrame:
    """path of every file below root that matches; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root).select(F.regexp_replace("path", "^file:/+", "/").alias("path"))


def index_files(files: DataFrame) -> DataFrame:
    """(session_key, split, patient_id, session_id, montage_type, path, kind) of files in known splits.

    files: path. Files of unknown splits or with a path too short are left out.
    """
    parts = labels.path_parts(F.col("path"))
    out = files.select("path", *[c.alias(n) for n, c in parts.items()]).where("split <> 'unknown' and folder is not null")
    out = out.withColumn("montage_type", labels.montage_type(F.col("folder")))
    key = labels.session_key(F.col("split"), F.col("patient"), F.col("session"), F.col("montage_type"))
    return out.select(key.alias("session_key"), "split", F.col("patient").alias("patient_id"), F.col("session").alias("session_id"), "montage_type", "path", F.regexp_extract("path", r"\.([^./]+)$", 1).alias("kind"))


def index_sessions(files: DataFrame) -> DataFrame:
    """A row per session with the sorted paths of its recordings and annotations; folders of one key are one."""
    paths = lambda kind: F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.col("path")))).alias(f"{kind}_paths")
    return index_files(files).groupBy("session_key").agg(F.min("split").alias("split"), F.min("patient_id").alias("patient_id"), F.min("session_id").alias("session_id"), F.min("montage_type").alias("montage_type"), *[paths(k) for k in ("edf", "csv", "csv_bi")])


def read_annotations(spark: SparkSession, root: str) -> DataFrame:
    """Rows of all .csv files below root: csv_path, channel, start_time, stop_time, label, confidence.

    Each file's own header line says where its columns are; # begins a comment anywhere in a
    line. Files without a required column give nothing, rows whose times don't parse neither.
    """
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root, wholetext=True)
    return annotation_rows(whole.select(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("csv_path"), "value"))


def _annotation_fields(texts: DataFrame) -> DataFrame:
    files = texts.select("csv_path", "value", F.split("value", r"\r?\n").alias("_lines"))
    lines = F.filter(F.transform("_lines", lambda x: F.regexp_replace(x, r"#.*$", "")), lambda x: F.trim(x) != "")
    files = files.withColumn("_lines", lines).withColumn("_head", F.transform(F.split(F.try_element_at("_lines", F.lit(1)), ","), lambda x: F.lower(F.trim(x))))
    good = F.size(F.array_intersect("_head", F.array(*[F.lit(c) for c in REQUIRED]))) == len(REQUIRED)
    field = lambda f, name: F.trim(F.try_element_at(f, F.nullif(F.array_position("_head", F.lit(name)), F.lit(0)).cast("int")))

    def row(line):
        f = F.split(line, ",")
        return F.struct(field(f, "channel").alias("channel"), field(f, "start_time").try_cast("double").alias("start_time"), field(f, "stop_time").try_cast("double").alias("stop_time"), field(f, "label").alias("label"), field(f, "confidence").try_cast("double").alias("confidence"))

    body = F.transform(F.slice("_lines", F.lit(2), F.greatest(F.size("_lines") - 1, F.lit(0))), row)
    montage = F.nullif(F.trim(F.regexp_extract("value", r"(?m)^#[ \t]*montage_file[ \t]*=[ \t]*(.*)$", 1)), F.lit(""))
    return files.where(good).select("csv_path", montage.alias("montage_file"), body.alias("_rows"))


def annotation_rows(texts: DataFrame) -> DataFrame:
    """The rows of annotation files from (csv_path, value), the whole text of each; as of read_annotations."""
    return _annotation_fields(texts).select("csv_path", F.inline("_rows")).where("start_time is not null and stop_time is not null")


def annotation_files(texts: DataFrame) -> DataFrame:
    """(csv_path, montage_file, rows, skipped) of annotation files: the montage named in a comment, and rows that do not parse."""
    parses = F.filter("_rows", lambda r: r["start_time"].isNotNull() & r["stop_time"].isNotNull())
    return _annotation_fields(texts).select("csv_path", "montage_file", F.size(parses).cast("long").alias("rows"), (F.size("_rows") - F.size(parses)).cast("long").alias("skipped"))


def montage_paths(named: DataFrame, files: DataFrame) -> DataFrame:
    """named (csv_path, montage_file) with montage_path: of the files (path) of that base name, in any case, the least."""
    base = lambda c: F.lower(F.regexp_extract(c, r"([^/\\\\]*)$", 1))
    by_name = files.groupBy(base("path").alias("_base")).agg(F.min("path").alias("montage_path"))
    return named.join(by_name, base("montage_file") == F.col("_base"), "left").drop("_base")


def session_status(sessions: DataFrame, recordings: DataFrame) -> DataFrame:
    """(session_key, files, readable, status) of every session: no_edf, unreadable, no_rate or success.

    recordings: session_key, edf_path, duration, native_sfreq. A file is readable with a
    duration; of several rows of a file one suffices.
    """
    there = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
    count = lambda c: F.count_distinct(F.when(c, F.col("edf_path")))
    by = recordings.where("edf_path is not null").groupBy("session_key").agg(F.count_distinct("edf_path").alias("files"), count(there("duration")).alias("readable"), count(~there("native_sfreq")).alias("_no_rate"))
    status = F.when(F.col("files").isNull(), "no_edf").when(F.col("readable") < F.col("files"), "unreadable").when(F.col("_no_rate") > 0, "no_rate").otherwise("success")
    return sessions.join(by, "session_key", "left").select("session_key", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("readable", F.lit(0)).alias("readable"), status.alias("status"))


def master_rows(annotations: DataFrame, recordings: DataFrame, tags: tuple[str, ...] | None = None) -> DataFrame:
    """Annotation rows whose recording is there, with edf_path, split, is_valid true and status -1.

    recordings: path of the .edf files. tags: labels to keep; unset, all.
    """
    rows = annotations if tags is None else annotations.where(F.col("label").isin(*tags))
    rows = rows.withColumn("edf_path", labels.recording_of(F.col("csv_path")))
    there = recordings.select(F.col("path").alias("edf_path")).distinct()
    rows = rows.join(there, "edf_path", "left_semi")
    return rows.withColumns({"split": labels.split_of_path(F.col("csv_path")), "is_valid": F.lit(True), "status": F.lit(-1), "session_key": F.lit(None).cast("string")})


def without_recording(annotations: DataFrame, recordings: DataFrame) -> DataFrame:
    """Annotation files that have no recording."""
    files = annotations.select("csv_path").distinct().withColumn("edf_path", labels.recording_of(F.col("csv_path")))
    return files.join(recordings.select(F.col("path").alias("edf_path")), "edf_path", "left_anti")


def session_events(lines: DataFrame, session_of: DataFrame, label: str = "seiz") -> DataFrame:
    """Events of .csv_bi files on their session's time line (C11), in order of path.

    lines: line_id, csv_bi_path, line_no, line_text; session_of: csv_bi_path, session_key. A file
    whose duration does not parse is left out and does not advance the clock; so are bad rows.
    """
    from pyspark.sql import Window

    from spanloom.operators.rejects import rows_and_durations

    parsed, durations = rows_and_durations(lines)
    durations = durations.withColumnRenamed("duration", "duration_s")
    order = Window.partitionBy("session_key").orderBy("csv_bi_path")
    ahead = F.coalesce(F.sum("duration_s").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    clock = durations.join(session_of.select("csv_bi_path", "session_key").distinct(), "csv_bi_path").withColumn("offset_s", F.round(ahead, 6))
    rows = parsed.where(F.trim("label") == label).select("csv_bi_path", "start_time", "end_time").distinct()
    return rows.join(clock, "csv_bi_path").select("session_key", "csv_bi_path", "start_time", "end_time", (F.col("offset_s") + F.col("start_time")).alias("session_start"), (F.col("offset_s") + F.col("end_time")).alias("session_end"))


def read_montage(spark: SparkSession, path: str) -> DataFrame:
    """(name, source_a, source_b) of montage files: lines like montage = 0, FP1-F7: EEG FP1-REF -- EEG F7-REF."""
    text = spark.read.text(path).where(F.lower(F.trim(F.split_part("value", F.lit("="), F.lit(1)))) == "montage")
    told = text.select(F.split(F.split("value", "=", 2)[1], ",", 2).alias("_p")).where("size(_p) = 2 and trim(_p[0]) rlike '^[0-9]+$'")
    named = told.select(F.split(F.col("_p")[1], ":", 2).alias("_n")).where("size(_n) = 2")
    sides = named.select(F.trim(F.col("_n")[0]).alias("name"), F.split(F.col("_n")[1], "--", 2).alias("_s")).where("size(_s) = 2")
    return sides.select("name", F.trim(F.col("_s")[0]).alias("source_a"), F.trim(F.col("_s")[1]).alias("source_b")).where("name <> '' and source_a <> '' and source_b <> ''")
