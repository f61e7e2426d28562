"""Column expressions over channel names."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from spanloom import schema

#: What a name may begin and end with, from the fixed prefixes and suffixes.
KIND = rf"^({'|'.join(schema.PREFIXES)})\s+"
REFERENCE = rf"-({'|'.join(schema.SUFFIXES)})\d*$"


def normalized(name: Column) -> Column:
    """Upper case without kind prefix, reference suffix and blanks; C3-CZ loses its -CZ."""
    upper = F.upper(F.regexp_replace(name, r"^\s+|\s+$", ""))
    bare = F.regexp_replace(F.regexp_replace(upper, KIND, ""), REFERENCE, "")
    return F.regexp_replace(bare, r"\s+", "")


def bipolar_sides(name: Column) -> Column:
    """Both sides of the first hyphen as a struct (a, b); null unless both are there."""
    parts = F.split(F.regexp_replace(name, r"^\s+|\s+$", ""), "-", 2)
    a, b = (F.regexp_replace(F.try_element_at(parts, F.lit(i)), r"^\s+|\s+$", "") for i in (1, 2))
    return F.when((a != "") & (b != ""), F.struct(a.alias("a"), b.alias("b")))


@F.pandas_udf(DoubleType())
def likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks of two names, the second one taken as the searched."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, y, x).ratio() for x, y in zip(a, b, strict=True)])
