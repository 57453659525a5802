"""SQL-callable functions (UDF-1).

``getTimeMills`` is a SQL function whose body is built-in expressions, so it is
inlined into the plan (codegen, no Python per row), unlike a registered
Python or Scala lambda.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tessera.functions.time import CN_TIME_HEAD
from tessera.schemas import CN_TIME_PATTERN


def register(spark: SparkSession) -> None:
    """Register ``getTimeMills(t STRING) -> BIGINT`` for this session."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION getTimeMills(t STRING) RETURNS BIGINT "
        f"RETURN unix_millis(try_to_timestamp(regexp_extract(regexp_replace(t, ',[^,]*,', ' '), r'{CN_TIME_HEAD}', 1), "
        f"'{CN_TIME_PATTERN}'))"
    )
