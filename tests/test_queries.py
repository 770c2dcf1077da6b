import pytest

import __spark_entry__ as entry_module
from checks.compare import check
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["chunk_id", "doc_uri", "text", "embedding"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert QUERIES.keys() <= queries.keys() and oracles.keys() <= queries.keys()
    assert {name: oracles[name] for name in ORACLES} == ORACLES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    status, n, _ = check(spark, SF_DIR, name)
    assert status in ("equal", "rows only"), status
    assert n > 0 or name in ORACLES
