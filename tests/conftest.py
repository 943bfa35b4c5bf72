import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from skyloom.session import local_session  # noqa: E402


# Started on import: test modules build columns at module level.
SPARK = local_session(cores="8", partitions=8, memory="6g")


@pytest.fixture(scope="session")
def spark():
    return SPARK


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
