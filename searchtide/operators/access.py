"""What each role may see of the curated table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from searchtide.vocab import HIDDEN_COLUMNS


def hidden_columns(role: str) -> tuple[str, ...]:
    if role not in HIDDEN_COLUMNS:
        raise ValueError(f"unknown role: {role}")
    return HIDDEN_COLUMNS[role]


def visible_to(rows: DataFrame, role: str) -> DataFrame:
    return rows.drop(*hidden_columns(role))


def create_role_view(rows: DataFrame, role: str, name: str | None = None) -> str:
    """Register the visible part of the table as a view and return its name."""
    view = name or f"curated_for_{role}"
    visible_to(rows, role).createOrReplaceTempView(view)
    return view


def seen_columns(spark: SparkSession, view: str) -> set[str]:
    """Columns of a view as the catalog has them."""
    return {column.name for column in spark.catalog.listColumns(view)}


def exclusion_matches(full: DataFrame, view: str, role: str) -> bool:
    """Are exactly the columns missing from the role's view that it must not see?"""
    return set(full.columns) - seen_columns(full.sparkSession, view) == set(hidden_columns(role))
