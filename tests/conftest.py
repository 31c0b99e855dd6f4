from __future__ import annotations

import datetime as dt
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from dayledger.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
HEADER = "a,b,c,d,e,f,g,h,i"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="6g", name="dayledger-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def landing(tmp_path):
    """A folder of daily files and a function that adds one."""
    root = tmp_path / "landing"
    root.mkdir()

    def add(day: str, rows: list[str] | None, header: str = HEADER) -> Path:
        file = root / f"{day}.txt"
        file.write_text("" if rows is None else "\n".join([header, *rows]) + "\n")
        return file

    add.root = str(root)
    return add


def row(
    i: int,
    day: str,
    amount: str = "10.5",
    customer: str = "5",
    terminal: str = "6",
    fraud: str | None = None,
) -> str:
    label = str(i % 2) if fraud is None else fraud
    return f"{i},{day} 10:00:00,{customer},{terminal},{amount},{i},{i % 7},{label},0"


def days_from(start: str, n: int) -> list[str]:
    first = dt.date.fromisoformat(start)
    return [str(first + dt.timedelta(days=i)) for i in range(n)]
