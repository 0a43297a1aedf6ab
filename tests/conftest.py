from __future__ import annotations

import pytest

from clickloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Frame from literal rows and a schema text."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make
