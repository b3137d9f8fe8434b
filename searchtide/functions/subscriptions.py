"""Column expressions on the list of subscription plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from searchtide.functions.text import strip


def plan_names(plans: Column) -> Column:
    """Name of each ``"name:detail"`` entry, in order. A null entry is named ``None``."""
    return F.transform(plans, lambda entry: strip(F.substring_index(F.coalesce(entry, F.lit("None")), ":", 1)))


def has_premium(plans: Column, premium: Sequence[str]) -> Column:
    return F.coalesce(F.arrays_overlap(plan_names(plans), F.array(*map(F.lit, premium))), F.lit(False))


def plan_count(plans: Column) -> Column:
    return F.when(plans.isNotNull(), F.size(plans))
