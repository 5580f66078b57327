import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quire.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="quire-tests-")
    s = get_session(
        "local[4]",
        app="quire-tests",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": f"{scratch}/ckpt",
            "spark.local.dir": f"{scratch}/local",
        },
    )
    yield s
    s.stop()


def rows(df, *cols):
    return [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]
