import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from hustings.session import local_session

    session = local_session("tests", cores=4, checkpoints=f"file://{tmp_path_factory.mktemp('checkpoints')}")
    yield session
    session.stop()
