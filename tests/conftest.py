import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("LEDGERFORGE_CHECKPOINT", "/tmp/ledgerforge-test-checkpoint")

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from ledgerforge.session import local_session

    s = local_session(cpus=4, shuffle=4, memory="4g")
    yield s
    from ledgerforge.session import clear_cuts

    clear_cuts(s)
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
