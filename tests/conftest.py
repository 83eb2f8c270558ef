import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopmarts.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8, app="shopmarts-tests",
                      conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="wh-")})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
