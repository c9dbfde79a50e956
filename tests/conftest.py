import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siteweave.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return get_session("tests", "*", 8)


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
