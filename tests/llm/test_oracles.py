import pytest
from tests.oracle import compare

from crosslink.llm import queries
from crosslink.llm.oracles import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    ours, theirs = compare(spark, "/root/testdata/sf0.001", queries.queries()[name], ORACLES[name])
    assert ours == theirs and ours
