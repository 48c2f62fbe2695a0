import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from daybook.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "daybook-tests",
        "local[8]",
        8,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake_root():
    return tempfile.mkdtemp(prefix="run-lake-")
