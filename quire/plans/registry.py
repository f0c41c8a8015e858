"""All queries outside the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries as base
from . import files, runs, temporal  # noqa: F401  they register their queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)
