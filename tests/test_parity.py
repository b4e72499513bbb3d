"""Registered queries against their SQL on the smallest tables.

By default a sample that touches every module; STARMART_PARITY=all runs every query.
"""

import os

import pytest

from parity import compare, connect
from starmart import registry

registry.load()
FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "p11", "p15", "p16", "j11", "j18", "a16", "a19_median", "a24", "a27", "w01", "w02", "w03", "w09", "o05", "o07", "f01",
    "f03", "f07", "f08", "f34", "c03", "c05", "c08", "v07", "v08", "q04", "b01", "b06", "b08", "s01", "s05", "s12", "rv1",
    "rv6", "rq", "rp1", "ri02", "ri09", "x", "m08", "m12", "m17", "m20", "m24", "m40",
)
NAMES = [n for n in registry.QUERIES if os.environ.get("STARMART_PARITY") == "all" or n.startswith(SAMPLE)]


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    df = registry.QUERIES[name](spark, FOLDER)
    rows = df.collect()
    if name in registry.ORACLES:
        assert compare(rows, df.schema, con, registry.ORACLES[name]) == []


def test_every_oracle_has_a_query():
    assert set(registry.ORACLES) <= set(registry.QUERIES)
