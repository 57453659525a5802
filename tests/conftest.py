import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="tessera-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh sub-folder of the shared checkpoint folder."""
    from tessera.session import scratch_path

    return lambda name: scratch_path(spark, name)
