import os

import pytest
from harness import DATA, compare

from quarrylight.plans import pipeline, repository

assert pipeline.QUERIES is repository.QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", repository.SQL)
def test_same_rows_as_sql(spark, name):
    compare(spark, repository.QUERIES[name], repository.SQL[name])


def test_queries_without_sql_run(spark):
    for name in repository.QUERIES.keys() - repository.SQL.keys():
        assert repository.QUERIES[name](spark, DATA).columns
