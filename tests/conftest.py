from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.session import local_session  # noqa: E402

SMALL_SF = os.environ.get("KESTREL_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="kestrel-tests")
    # tests only: the cluster names a shared checkpoint folder; locally take a scratch one
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kestrel-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL_SF
