"""Queries against their SQL."""

import pytest

from checks.compare import differences, open_tables
from fieldpulse.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALLEST


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALLEST), open_tables(SMALLEST), ORACLES[name]) is None


def test_names_follow_the_numbers():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
