import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from restock.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4, extra={
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="restock-test-ckpt-")})
    yield s


def rows(df):
    return [r.asDict() for r in df.collect()]
