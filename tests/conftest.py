import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from spanloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = local_session("4", "tests")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as a sorted list of tuples."""
    return lambda df, *columns: sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)
