import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from blogscope.session import checkpoint_dir, get_session
    s = get_session("local[4]", 4, extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="bs-wh-")})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
