from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidepool.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidepool-tests", "local[8]", spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="tidepool-warehouse-"),
        spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
