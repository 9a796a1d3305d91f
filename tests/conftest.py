import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sigshape.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # SIGSHAPE_TEST_ANSI=false runs the suite with ANSI mode off: the library
    # must not depend on it (its guards raise explicitly).
    ansi = os.environ.get("SIGSHAPE_TEST_ANSI", "true")
    s = local_session(cores="*", shuffle_partitions=8, app="sigshape-tests",
                      extra={"spark.sql.ansi.enabled": ansi})
    if s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sigshape-test-ckpt-"))
    yield s


def records(spark, rows, batch_id=0, topic="t", partition=0):
    """Record-table rows from (offset, value) pairs or (offset, value, batch, partition)."""
    out = []
    for r in rows:
        off, val = r[0], r[1]
        b = r[2] if len(r) > 2 else batch_id
        p = r[3] if len(r) > 3 else partition
        out.append((topic, p, off, None, None, val, b))
    from sigshape.sources.records import RECORD_SCHEMA
    return spark.createDataFrame(out, RECORD_SCHEMA)
