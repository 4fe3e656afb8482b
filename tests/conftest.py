import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from blockwise.session import get_session
    s = get_session("local[*]", shuffle_partitions=8, app_name="blockwise-tests")
    yield s


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
