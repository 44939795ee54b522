import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="tidemark-tests")
    yield s
    s.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df, *order):
    """Collect as a list of dicts, sorted by the given columns (None sorts first)."""
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[c] is not None, r[c]) for c in order))
    return out
