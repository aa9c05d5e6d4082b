"""Registered queries give the rows that their SQL gives."""

import pytest

from checks.compare import database, differences
from checks.queries import ORACLES
from conftest import SF_DIR

@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_rows(spark, con, name):
    assert differences(spark, con, name, SF_DIR) is None
