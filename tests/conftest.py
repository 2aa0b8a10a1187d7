from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cinepulse.session import local_session, shared_dir

    session = local_session("*", shuffle_partitions=8, app="cinepulse-tests")
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)  # tests: a fresh temporary shared folder when none is set
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
