"""Savings per agent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgauge.functions.expressions import or_zero


def savings_by_agent(savings: DataFrame, keys: Sequence[str] = (),
                     agent: str = "agent_id", value: str = "saving_value") -> DataFrame:
    """Total saving and row count per agent. A NULL agent is a group of its own;
    an empty table gives no rows."""
    return savings.groupBy(*keys, agent).agg(
        or_zero(F.sum(value)).alias("total_saving"),
        F.count(F.lit(1)).alias("row_count"),
    )


def selected_savings_by_agent(selected: DataFrame, keys: Sequence[str] = (),
                              agent: str = "agent_id", value: str = "saving_value") -> DataFrame:
    """Total of the selected savings per agent."""
    return selected.groupBy(*keys, agent).agg(or_zero(F.sum(value)).alias("total_saving"))
