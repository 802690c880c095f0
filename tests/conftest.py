import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ruleweave.session import ensure_checkpoint_dir, local_session

    s = local_session(4, app="ruleweave-tests", shuffle_partitions=8, driver_memory="4g")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
