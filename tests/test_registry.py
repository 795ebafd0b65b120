"""The driver contract, and some queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from claimgauge.plans import claim_queries, event_queries

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def test_every_query_has_sql():
    own = {**claim_queries.QUERIES, **event_queries.QUERIES}
    assert set(own) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.FLAGSHIP in own


def answers(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in data)


@needs_data
@pytest.mark.parametrize("name", [
    "postfiltered_share_by_partner", "savings_by_agent_by_partner", "new_provider_pct_by_run",
    "provider_volume_ratio_by_run", "sent_over_received_by_run", "sent_over_accepted_by_run",
    "expired_validation_total_by_run", "event_outcomes", "failure_counts", "metric_log_json",
    "event_mix_points", "table_policy_points", "table_policy_outcomes", "failed_family_points",
    "failure_points", "stream_dedup", "stream_savings"])
def test_query_equals_sql(spark, name):
    frame = entry.queries()[name](spark, SMALL)
    database = duckdb.connect()
    for table in "region nation customer supplier part orders lineitem events".split():
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    result = database.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    expected = answers(columns, result.fetchall())
    assert expected and answers(frame.columns, frame.collect()) == expected


@needs_data
def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
