import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from playlake.config import RunWindow  # noqa: E402

#: the days of the driver's events
WINDOW = RunWindow(dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.datetime(2024, 1, 31))


@pytest.fixture(scope="session")
def spark():
    from playlake.session import build_session
    from playlake.plans.catalog import Inputs
    s = build_session("local[4]", shuffle_partitions=4, app_name="playlake-tests")
    Inputs.shared = {}      # the staging tables are built once for all tests
    yield s
    Inputs.shared = None
    s.stop()
