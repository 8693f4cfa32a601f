import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app="tessera-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="tessera-test-")


def rows(df, *cols):
    """Sorted plain tuples of the given columns."""
    cols = cols or df.columns
    key = lambda t: tuple((x is None, x if x is not None else 0) for x in t)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=key)
