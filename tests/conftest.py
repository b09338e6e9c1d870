import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from pondside.session import build_session  # noqa: E402
from small import small_survey  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        spark__master="local[4]",
        spark__driver__memory="4g",
        spark__sql__shuffle__partitions="3",
        spark__ui__showConsoleProgress="false",
        spark__sql__adaptive__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def no_views_left():
    """Views that a module's tests publish are gone before the next module lists tables."""
    yield
    session = SparkSession.getActiveSession()
    for table in session.catalog.listTables() if session else ():
        if table.isTemporary:
            session.catalog.dropTempView(table.name)


@pytest.fixture
def db(spark):
    """The hand-made survey of `small.py`; a fresh one per test, so sizes are measured anew."""
    return small_survey(spark)


@pytest.fixture
def tight(monkeypatch):
    """No lookup fits a broadcast, and any key with a large share of the rows is hot."""
    from pondside.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(joins, "HOT_ROWS", 1)
    monkeypatch.setattr(joins, "HOT_SHARE", 0.05)
