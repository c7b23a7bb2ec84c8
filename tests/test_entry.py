import os

import pytest

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_entry_and_registry(spark):
    import __spark_entry__ as e

    rows = e.entry(spark).collect()
    assert 0 < len(rows) <= 10
    assert set(e.oracle_sql()) <= set(e.queries())
