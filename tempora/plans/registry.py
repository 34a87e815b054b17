"""Registered checks: one Spark query per operator and its oracle SQL.

Each check is a callable ``(spark, sf_dir) -> DataFrame`` that runs the
library operator over the whole driver tables, paired with an ANSI SQL text
(DuckDB dialect) computing the same rows, or ``None`` where the operator
has no SQL equivalent.  Computed doubles are rounded in both, since engines
add floats in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKS: dict[str, tuple[Callable, str | None]] = {}


def check(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with its oracle ``sql``."""
    def deco(fn):
        if name in CHECKS:
            raise ValueError(f"duplicate check {name}")
        CHECKS[name] = (fn, sql)
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column to ``digits`` places."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def load_all() -> dict[str, tuple[Callable, str | None]]:
    # importing the modules fills CHECKS
    from tempora.plans import (checks_products, checks_relational, checks_series,  # noqa: F401
                               checks_forecast, checks_sources)
    return CHECKS
