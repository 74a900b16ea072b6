import os
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmill.session import drop_scratch, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", partitions=4)
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{tmp_path.name}".replace("-", "_").replace("[", "_").replace("]", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    return name


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a sorted list of tuples (NULLs first)."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])

    return collect


@pytest.fixture
def shuffles_left(spark):
    """Shuffle files on the session's disks that were not there before the test, after some time to delete them."""

    def found():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {name for name in names if name.startswith("shuffle_")}

    before = found()

    def left():
        ends = time.monotonic() + 5
        while found() - before and time.monotonic() < ends:
            time.sleep(0.2)
        return found() - before

    return left
