from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shopfloor.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples; nulls first."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in chosen.collect()),
            key=lambda r: tuple((v is not None, str(v) if v is not None else "") for v in r),
        )

    return collect
