import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("orderloom-tests")


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(str(v) for v in t))
