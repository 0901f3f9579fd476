"""Every registered query against its oracle on the smallest test folder."""

import pytest

from checks import compare, registry

SF_DIR = "/root/testdata/sf0.001"

registry.load_all()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    found = registry.QUERIES[name](spark, SF_DIR)
    assert compare.differences(duck, found, registry.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_oracle_has_rows(spark, name):
    assert not registry.QUERIES[name](spark, SF_DIR).isEmpty()
