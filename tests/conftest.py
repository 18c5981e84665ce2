from __future__ import annotations

import pytest

from tinta.session import build_session


@pytest.fixture(scope="session")
def spark():
    quiet = {"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    session = build_session("tests", "local[8]", 8, quiet)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
