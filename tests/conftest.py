import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="tidemark-tests")
    # tests run without a cluster: the checkpoint root is a local temp folder
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted plain tuples of the given (or all) columns."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple(str(x) for x in t))


def srt(items):
    """Expected rows in the order ``rows`` returns them."""
    return sorted(items, key=lambda t: tuple(str(x) for x in t))
