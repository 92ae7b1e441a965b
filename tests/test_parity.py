"""Every registered query against its SQL twin, on the smallest given tables."""

import os

import parity
import pytest

from paritas.workload.catalogue import QUERIES, TWINS

SF = os.path.join(parity.DATA, "sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")


@pytest.fixture(scope="module")
def con():
    return parity.connect(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_twin(spark, con, key):
    assert parity.difference(spark, con, key, QUERIES[key], TWINS.get(key), SF) is None


def test_every_query_has_a_twin():
    assert not sorted(set(QUERIES) - set(TWINS))
