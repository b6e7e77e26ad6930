import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from profilelake.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def store(spark, sf_dir):
    from profilelake.sources.lake import fixture_store

    return fixture_store(spark, sf_dir)


@pytest.fixture(scope="session")
def lake(store):
    from profilelake.sources.lake import Lake

    return Lake.of(store)
