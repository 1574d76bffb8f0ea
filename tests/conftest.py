import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("OMP_NUM_THREADS", "1")


@pytest.fixture(scope="session")
def spark():
    from tessella.session import local_session

    session = local_session("tests", cores="4", memory="4g")
    yield session
    session.stop()
