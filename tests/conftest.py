import os

import pytest

from skilltide.session import local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    settings = {
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.maxMetadataStringLength": "10000",  # plan tests read pushed filters
    }
    session = local_session(4, "tests", **settings)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
