import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tokenloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.cpu_count() or 4, shuffle_partitions=4, app="tests")
    session.sparkContext.setLogLevel("OFF")
    return session
