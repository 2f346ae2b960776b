import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from bourse.session import get_session
    s = get_session("local[*]", shuffle_partitions=8, app="bourse-tests")
    yield s


def rows(df, *cols):
    """Collected rows as tuples, sorted."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
