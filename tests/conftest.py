import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session

    s = get_session("local[*]", app="tessera-tests", shuffle_partitions=8)
    # Tests set their own checkpoint folder only when the session has none.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (for order-insensitive comparison)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, v) for v in t))


def plan_text(df, mode="formatted"):
    """The text that ``df.explain(mode)`` prints."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
