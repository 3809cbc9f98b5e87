"""Conditional-max pivot of code rows into 0/1 flags."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def code_flags(df: DataFrame, keys: Sequence[str], code_col: str, codes: Mapping[str, str]) -> DataFrame:
    """One row per key with an INT 0/1 column per ``flag name -> code``.

    Planned as partial + final ``HashAggregate``: map-side combine collapses a
    hot key before the shuffle.
    """
    code = F.col(code_col)
    return df.groupBy(*keys).agg(
        *[F.max(F.when(code == F.lit(v), F.lit(1)).otherwise(F.lit(0))).alias(k) for k, v in codes.items()]
    )


def any_flag(flags: Sequence[str]) -> Column:
    """1 when any of ``flags`` is 1 (NULL counts as 0), else 0."""
    return F.greatest(*[F.coalesce(F.col(f), F.lit(0)) for f in flags], F.lit(0)).cast("int")
