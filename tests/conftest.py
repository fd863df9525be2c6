import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from punctual import session


@pytest.fixture(scope="session")
def spark():
    return session.local(cores=4, partitions=4, memory="4g")
