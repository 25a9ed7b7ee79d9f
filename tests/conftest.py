from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="6g",
                            spark__sql__warehouse__dir=str(home / "warehouse"),
                            spark__checkpoint__dir=str(home / "checkpoints"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def rows(df, *columns):
    """Plain tuples, for comparison with expected rows."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


@pytest.fixture(name="rows")
def _rows():
    return rows
