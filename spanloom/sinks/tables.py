"""Master tables, session signals and their offsets written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.operators.annotate import in_order


def write_master(df: DataFrame, path: str, form: str = "csv") -> None:
    """The master table in canonical order, as CSV with header or as Parquet by split."""
    rows = in_order(df.select(*schema.MASTER.fieldNames()))
    if form == "csv":
        rows.write.mode("overwrite").option("header", True).csv(path)
    else:
        rows.write.mode("overwrite").partitionBy("split").parquet(path)


def read_master(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.MASTER).option("header", True).csv(path)


def write_checkpoint(df: DataFrame, path: str, stage: str) -> None:
    """Signals of sessions as 32-bit floats by stage and session; only the sessions in df are replaced."""
    rows = df.withColumns({"stage": F.lit(stage), "samples": F.col("samples").cast("array<float>")})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("stage", "session_key").parquet(path)


def read_checkpoint(spark: SparkSession, path: str, stage: str, session_key: str | None = None) -> DataFrame:
    """Signals of a stage; FileNotFoundError where a named session has none."""
    rows = spark.read.option("basePath", path).parquet(path).where(F.col("stage") == stage)
    if session_key is not None:
        rows = rows.where(F.col("session_key") == session_key)
        if rows.isEmpty():
            raise FileNotFoundError(f"{stage} of {session_key}")
    return rows


def to_resume(sessions: DataFrame, checkpoints: DataFrame, with_montage: bool = False) -> DataFrame:
    """Sessions without a raw checkpoint, or, with montage, without a processed one.

    checkpoints: session_key, stage.
    """
    need = ["raw", "proc"] if with_montage else ["raw"]
    done = checkpoints.where(F.col("stage").isin(*need)).groupBy("session_key").agg(F.count_distinct("stage").alias("n")).where(F.col("n") == len(need))
    return sessions.join(done, "session_key", "left_anti")


def offsets_json(offsets: DataFrame) -> DataFrame:
    """(session_key, offsets): a JSON list of edf_path, start_sample and end_sample in order."""
    item = F.struct("start_sample", "edf_path", "end_sample")
    ordered = F.transform(F.array_sort(F.collect_list(item)), lambda x: F.struct(x["edf_path"].alias("edf_path"), x["start_sample"].alias("start_sample"), x["end_sample"].alias("end_sample")))
    return offsets.groupBy("session_key").agg(F.to_json(ordered).alias("offsets"))


def offsets_from_json(texts: DataFrame) -> DataFrame:
    kind = "array<struct<edf_path:string,start_sample:bigint,end_sample:bigint>>"
    return texts.select("session_key", F.explode(F.from_json("offsets", kind)).alias("o")).select("session_key", "o.*")


def convert_verified(df: DataFrame, path: str, keys: list[str], column: str, codec: str = "zstd", relative: float = 1e-5, absolute: float = 1e-6) -> DataFrame:
    """Write df as Parquet, read it again, and compare: one row with rows, same_shape and differing.

    keys tell rows apart. Samples differ beyond absolute + relative * |value|. Sources are never deleted.
    """
    df.withColumn(column, F.col(column).cast("array<float>")).write.mode("overwrite").option("compression", codec).parquet(path)
    back = df.sparkSession.read.parquet(path).select(*keys, F.col(column).alias("_back"))
    both = df.join(back, keys, "full_outer")
    near = lambda p: (p["a"].cast("float") == p["b"]) | (F.abs(p["a"] - p["b"]) <= absolute + relative * F.abs(p["b"]))
    far = F.exists(F.arrays_zip(F.col(column).alias("a"), F.col("_back").alias("b")), lambda p: ~near(p))
    differs = (F.coalesce(F.size(column), F.lit(-1)) != F.coalesce(F.size("_back"), F.lit(-1))) | F.coalesce(far, F.lit(False))
    return both.agg(F.count(F.lit(1)).alias("rows"), (F.coalesce(F.sum(differs.cast("long")), F.lit(0)) == 0).alias("verified"), F.coalesce(F.sum(differs.cast("long")), F.lit(0)).alias("differing"))


def write_wide(df: DataFrame, path: str, keys: list[str], channels: tuple[str, ...] = schema.CHANNELS, codec: str = "zstd", row_group_bytes: int = 128 << 20) -> DataFrame:
    """Signals (keys, channel, samples) as Parquet with a column a channel and a row a sample; what is read back of it.

    Shorter channels of a key are null at their end, missing ones throughout. Raises OSError if
    the rows read back are not as many as written.
    """
    none = F.array().cast(df.schema["samples"].dataType)
    own = df.where(F.col("channel").isin(*channels)).groupBy(*keys).agg(*[F.coalesce(F.max(F.when(F.col("channel") == c, F.col("samples"))), none).alias(c) for c in channels])
    rows = own.select(*keys, F.posexplode(F.arrays_zip(*channels)).alias("sample", "_r")).select(*keys, F.col("sample").cast("long").alias("sample"), *[F.col(f"_r.{c}").alias(c) for c in channels])
    counted = Observation()
    rows.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("compression", codec).option("parquet.block.size", row_group_bytes).parquet(path)
    back = df.sparkSession.read.schema(rows.schema).parquet(path)
    if back.count() != (counted.get.get("n") or 0):
        raise OSError(f"{path} does not hold what was written")
    return back


def write_by_label(df: DataFrame, path: str, codec: str = "zstd") -> None:
    """Segments in a folder for each label."""
    df.write.mode("overwrite").option("compression", codec).partitionBy("label").parquet(path)
