import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerfleet.session import build_session, ensure_checkpoint_dir
    s = build_session(master="local[4]", app="ledgerfleet-tests", shuffle_partitions=4)
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="ledgerfleet-test-ckpt-"))
    yield s


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="ledgerfleet-test-")
