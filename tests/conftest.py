import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark():
    from quarrylight.session import build_session

    session = build_session("tests", cpus=min(4, os.cpu_count() or 4), partitions=4)
    yield session
    from quarrylight import storage

    storage.release(session)
    session.stop()
