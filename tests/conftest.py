import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.path.join(ROOT, "tests"), os.environ.get("PYTHONPATH", "")])  # for the workers
SF = os.environ.get("FOLIANT_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from foliant.session import local_session

    return local_session(cores=4, shuffle_partitions=4, memory="4g")


@pytest.fixture(scope="session")
def sf():
    return SF
