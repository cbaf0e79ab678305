import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from bazaar.session import local_session
    s = local_session(4, shuffle_partitions=4, app="bazaar-tests", driver_memory="8g")
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


def col_values(df, col):
    return [r[col] for r in df.collect()]
