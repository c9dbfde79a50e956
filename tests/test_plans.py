"""What the plans of all queries must not do, with broadcasts switched off."""

import os

import pytest
from conftest import SMALL

from siteweave.plans.registry import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")

# These bring together one row per sort range or one row per label, nothing else.
NUMBERED = {
    "assign_uid",
    "company_chain",
    "company_us_view",
    "company_first_pages",
    "stage_companies",
    "persona_prompts_rows",
    "persona_upsert",
}
COLOURED = {"colour_index", "schema_graph", "subgraph_nodes"}
# One row: the names of the schema.
SPELT = {"canonical_text"}
# These hand text to a text function; other queries read texts that were told before.
ENRICHED = {"enrich_skip", "enrich_text", "enrich_value"}


@pytest.fixture(scope="module")
def plans(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield {
            name: query(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
            for name, query in QUERIES.items()
        }
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def having(plans, *signs):
    return {name for name, plan in plans.items() if any(sign in plan for sign in signs)}


def test_no_cross_joins(plans):
    assert having(plans, "CartesianProduct", "BroadcastNestedLoopJoin") == set()


def test_no_single_task_sorts(plans):
    assert having(plans, "SinglePartition") == NUMBERED | COLOURED | SPELT


def test_forced_broadcasts(plans):
    assert having(plans, "BroadcastExchange") == NUMBERED | {"record_nodes", "subgraph_nodes"}


def test_python_only_for_text_functions(plans):
    assert having(plans, "EvalPython", "InPandas") == ENRICHED
