import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opslog.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="opslog-test-ckpt-")
    wh = tempfile.mkdtemp(prefix="opslog-test-warehouse-")
    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
