"""Sort, first rows, unions and set differences (G1-G4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def sort(df: DataFrame, *order: str | Column) -> DataFrame:
    """Final-output ordering (a range shuffle; use only at the end)."""
    return df.orderBy(*order)


def first_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """Top ``n`` by ``order``; Spark runs this as a per-partition top-n then
    one merge of at most ``n`` rows per partition.  ``order`` must be a total
    order (add a tie-break column)."""
    return df.orderBy(*order).limit(n)


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns missing on one side become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows in exactly one of ``a`` and ``b``."""
    return a.subtract(b).union(b.subtract(a))
