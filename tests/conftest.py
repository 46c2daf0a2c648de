import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from starloom.session import local_session

    session = local_session(app="starloom-tests", cores=4, shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


def rows(df, *cols):
    """Sorted tuples of the selected columns, for order-free comparisons."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
