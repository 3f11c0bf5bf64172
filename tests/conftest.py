import pytest

from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        8, "tidemark-tests", **{"spark.ui.showConsoleProgress": "false",
                                "spark.driver.memory": "8g"})
    yield session
    session.stop()
