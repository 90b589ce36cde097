import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cxpulse.session import checkpoint_dir, get_session

    s = get_session("local[4]", app_name="cxpulse-tests", shuffle_partitions=4,
                    conf={"spark.sql.maxMetadataStringLength": "10000"})
    # tests only: a local checkpoint folder when the session names none
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="cxpulse-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def duck_sf01():
    from cxpulse.testbed.compare import duck

    return duck(SF01)


def rows(df, *cols):
    """Collected rows as sorted tuples (of the given columns)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
