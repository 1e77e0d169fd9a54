import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session, drop_paths  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", master="local[4]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g", spark__log__level="ERROR",
    )
    yield session
    drop_paths(session)
    session.stop()


def rows(df, *columns):
    """All rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture
def as_rows():
    return rows


@pytest.fixture
def plan_of():
    def text(df, mode="formatted"):
        return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)

    return text
