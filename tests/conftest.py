import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))

SF = os.environ.get("QUARRY_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session
    s = build_session("local[*]", shuffle_partitions=8,
                      extra={"spark.ui.enabled": "false"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def con(sf_dir):
    from harness import duck
    return duck(sf_dir)
