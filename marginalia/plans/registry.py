"""Registered queries of the operators, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import q_aggregates, q_joins, q_review, q_text, q_windows  # noqa: F401
from .base import QUERIES, SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["confidence_board"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return SQL
