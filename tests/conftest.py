import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kpiloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4",
        spark__sql__adaptive__coalescePartitions__enabled="true",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


def table(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
