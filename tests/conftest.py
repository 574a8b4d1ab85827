import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from obsmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", 8)
    yield session
    session.stop()
