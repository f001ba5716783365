import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airshed.session import build_session, checkpoint_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8, app_name="airshed-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="airshed-wh-")})
    checkpoint_root(s)  # tests set their own shared folder: the setting is unset here
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="airshed-test-")
