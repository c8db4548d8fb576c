import os

import pytest
from harness import DATA

import __spark_entry__ as entry


def test_names_and_sql():
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0 and DATA
