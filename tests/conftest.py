import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from boardtide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[8]", shuffle_partitions=8, app="boardtide-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session
