"""Schemas and fixed values of the interval annotations."""

from __future__ import annotations

from pyspark.sql import types as T

#: Labels, splits, priorities and sizes that results depend on.
SPLITS = ("train", "dev", "eval")
SPLIT_PREFIX = {"train": "trn", "dev": "vld", "eval": "tst"}
ICTAL = ("fnsz", "gnsz", "cpsz", "spsz", "tnsz", "tcsz", "absz", "mysz", "cnsz", "atsz", "seiz", "sz", "nesz")
UNRELIABLE = ("bckg",)
PREFIXES = ("EEG", "EKG", "ECG")
SUFFIXES = ("REF", "LE", "AR", "AVG", "CZ")
BUFFER_SUFFIX = "_sopbuffer"
BACKGROUND = "bg"
INTERICTAL = "interictal"
EPSILON = 1e-9
TARGET_RATE = 256.0
DETECTOR_SECONDS = 2.0
ARTIFACT_CLASSES = (1, 2)
CHANNELS = ("FP1", "F7", "T3", "T5", "O1", "FP2", "F8", "T4", "T6", "O2", "F3", "C3", "P3", "F4", "C4", "P4", "CZ")
PAIRS = (
    ("FP1", "F7"), ("F7", "T3"), ("T3", "T5"), ("T5", "O1"),
    ("FP2", "F8"), ("F8", "T4"), ("T4", "T6"), ("T6", "O2"),
    ("FP1", "F3"), ("F3", "C3"), ("C3", "P3"), ("P3", "O1"),
    ("FP2", "F4"), ("F4", "C4"), ("C4", "P4"), ("P4", "O2"),
    ("T3", "C3"), ("C3", "CZ"), ("CZ", "C4"), ("C4", "T4"),
)

MASTER = T.StructType(
    [
        T.StructField("edf_path", T.StringType()),
        T.StructField("csv_path", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("session_key", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("start_time", T.DoubleType()),
        T.StructField("stop_time", T.DoubleType()),
        T.StructField("label", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("is_valid", T.BooleanType()),
        T.StructField("status", T.IntegerType()),
    ]
)
