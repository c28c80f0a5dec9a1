import __spark_entry__ as entry
from ledgerloom.plans.catalog import ORACLES, QUERIES


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["contract_address", "holder_address", "timestamp", "block_number", "amount"]
    assert df.count() > 0
