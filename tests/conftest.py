import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from frames import RAW, settings  # noqa: E402

from tillroll.session import local_session  # noqa: E402

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        4,
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    yield session
    session.stop()


@pytest.fixture
def sliced(spark):
    """Several slices, however small the data."""
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        yield


@pytest.fixture
def raw_frame(spark):
    return lambda *lines: spark.createDataFrame(list(lines), RAW)
