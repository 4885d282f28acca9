from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import oracle  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = oracle.local_session()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def db(folder):
    return oracle.connect(folder)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def executed_plan(df) -> str:
    """The physical plan; after a run, the one that AQE ended with."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
