"""Several projections in one statement."""

from __future__ import annotations

from pyspark.sql import DataFrame


def steps(df: DataFrame, *stages: list[str] | str) -> DataFrame:
    """Apply SELECT lists one after the other, each seeing the columns of the one before; a plain string is a filter.

    One SQL statement with nested subqueries: it is parsed and analysed once, where a chain of DataFrame calls is analysed
    at every call.
    """
    text = "{df}"
    for stage in stages:
        text = f"(select * from {text} where {stage})" if isinstance(stage, str) else f"(select {', '.join(stage)} from {text})"
    return df.sparkSession.sql(f"select * from {text}", df=df)
