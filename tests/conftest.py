import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from visitflow.config import local_session, shared_dir
    s = local_session(cores="*", shuffle_partitions=8, app_name="visitflow-tests")
    shared_dir(s)  # tests only: a scratch checkpoint folder when none is configured
    yield s
