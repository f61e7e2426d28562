"""Column expressions over paths and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanloom import schema


def split_of_path(path: Column) -> Column:
    """train, dev or eval, the first of them that is a component of the path, else unknown."""
    parts = F.split(F.lower(F.replace(path, F.lit("\\"), F.lit("/"))), "/")
    out = F.lit("unknown")
    for name in reversed(schema.SPLITS):
        out = F.when(F.array_contains(parts, name), name).otherwise(out)
    return F.when(path.isNull(), F.lit("unknown")).otherwise(out)


def montage_type(folder: Column) -> Column:
    """Kind of reference and number of a recording folder: 01_tcp_ar is ar1."""
    head = F.split_part(folder, F.lit("_"), F.lit(1))
    number = F.when(head.rlike("^[0-9]+$"), head.cast("long").cast("string")).otherwise("0")
    low = F.lower(folder)
    kind = F.when(low.contains("tcp_ar"), "ar").when(low.contains("tcp_le"), "le").otherwise("unk")
    return F.concat(kind, number)


def path_parts(path: Column) -> dict[str, Column]:
    """split, patient, session and folder of a file's path; nulls where the path is too short.

    The three parts after the last component that spells the split count.
    """
    parts = F.split(path, "/")
    split = split_of_path(path)
    low = F.transform(parts, F.lower)
    at = F.size(parts) - F.array_position(F.reverse(low), split).cast("int") + 1
    take = lambda k: F.when((split != "unknown") & (at + k < F.size(parts)), F.try_element_at(parts, at + F.lit(k)))
    return {"split": split, "patient": take(1), "session": take(2), "folder": take(3)}


def session_key(split: Column, patient: Column, session: Column, montage: Column) -> Column:
    """prefix_patient_session_montage; null where a part is."""
    prefix = F.create_map(*[F.lit(x) for p in schema.SPLIT_PREFIX.items() for x in p])[split]
    return F.concat(prefix, F.lit("_"), patient, F.lit("_"), session, F.lit("_"), montage)


def recording_of(csv_path: Column) -> Column:
    """Path of the recording an annotation file belongs to: every .csv in the file's name becomes .edf."""
    name = F.regexp_extract(csv_path, r"([^/]*)$", 1)
    folder = F.regexp_extract(csv_path, r"^(.*/)?[^/]*$", 1)
    return F.concat(F.coalesce(folder, F.lit("")), F.replace(name, F.lit(".csv"), F.lit(".edf")))


def is_ictal(label: Column) -> Column:
    return F.coalesce(label.isin(*schema.ICTAL), F.lit(False))


def is_buffer(label: Column) -> Column:
    return F.coalesce(label.endswith(schema.BUFFER_SUFFIX), F.lit(False))


def priority(label: Column) -> Column:
    """Rank of a label where intervals overlap; the higher keeps its time."""
    return (
        F.when(is_ictal(label), 1)
        .when(label.startswith("x"), 6)
        .when(label.startswith("c"), 5)
        .when(label.startswith("p"), 2)
        .when(label == schema.INTERICTAL, 0)
        .otherwise(1)
    )


def is_preictal(label: Column) -> Column:
    return F.coalesce(label.startswith("p") & ~label.endswith(schema.BUFFER_SUFFIX), F.lit(False))


def is_reliable(label: Column, unreliable: tuple[str, ...] = schema.UNRELIABLE) -> Column:
    """Whether a row counts as reliable cover; null labels do not."""
    return F.coalesce(~label.isin(*unreliable), F.lit(False))


def is_active(is_valid: Column, label: Column) -> Column:
    """Rows that take and lose time: valid ones and buffers."""
    return F.coalesce(is_valid, F.lit(False)) | is_buffer(label)
