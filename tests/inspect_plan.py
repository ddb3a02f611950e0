"""Helpers for tests: plans as text, and the message of a query that fails."""

import pytest


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def pushed_filters(df) -> str:
    """The filters that reach the scans of a frame, in full."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    lines = df._jdf.queryExecution().explainString(mode).splitlines()
    return "\n".join(line for line in lines if line.startswith("PushedFilters"))


def fails(df) -> str:
    with pytest.raises(Exception) as caught:
        df.collect()
    return str(caught.value)
