"""Inputs of the registered queries: dealt over tasks, and put together once."""

import pytest
from tests.llm.conftest import DATA

from rungworks.catalog import roles
from rungworks.catalog.queries import QUERIES


def test_member_documents_are_built_and_parsed_by_several_tasks(spark):
    assert roles.legacy_documents(spark, DATA).rdd.getNumPartitions() == 4


@pytest.mark.parametrize("name", ["q24_match_inference", "q24_match_inference_boosted"])
def test_match_reports_are_put_together_once(spark, name):
    assert not [f for f in QUERIES[name](spark, DATA).inputFiles() if "lineitem" in f]
