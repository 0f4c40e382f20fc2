"""Sorting, top-k and bounded exports, all with an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered(
    df: DataFrame, by: str | Sequence[str], desc: bool = False, limit: int | None = None
) -> DataFrame:
    """Rows in order, and only the first ``limit`` of them when it is given."""
    names = [by] if isinstance(by, str) else list(by)
    out = df.orderBy(*[F.desc(n) if desc else F.asc(n) for n in names])
    return out if limit is None else out.limit(limit)


def top_k(df: DataFrame, k: int, metric: str, tiebreak: str | Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest metric; ties go by ``tiebreak``. NULL metrics do not rank.

    Planned as a take-ordered: each task keeps ``k`` rows.
    """
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    return (
        df.filter(F.col(metric).isNotNull())
        .orderBy(F.desc(metric), *[F.asc(t) for t in ties])
        .limit(k)
    )
