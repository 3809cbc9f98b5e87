"""Deterministic one-row-per-key selection.

``dropDuplicates(subset)`` keeps whichever row its ``first()`` meets, so the
survivor depends on row order.  Every pick here ranks rows by the caller's
order, then by every remaining column (ascending, NULLs last), which is a
total order: equal rank means identical rows, so any retry, partitioning or
engine gives the same survivor.

Plan shape: ``row_number() == 1`` is planned as a partial ``WindowGroupLimit``
before the exchange and a final one after it, so each map task forwards at
most one row per key and a key holding a third of all rows is already
collapsed before the shuffle.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

Order = Sequence[tuple[str, str]]  # (column, "asc" | "desc"); NULLs always last


def _sort_col(name: str, direction: str) -> Column:
    if direction == "asc":
        return F.col(name).asc_nulls_last()
    if direction == "desc":
        return F.col(name).desc_nulls_last()
    raise ValueError(f"direction must be 'asc' or 'desc', not {direction!r}")


def total_order(df: DataFrame, keys: Sequence[str], order: Order) -> list[Column]:
    named = set(keys) | {c for c, _ in order}
    rest = [(c, "asc") for c in df.columns if c not in named]
    return [_sort_col(c, d) for c, d in list(order) + rest]


def first_by(df: DataFrame, keys: Sequence[str], order: Order, rank_col: str = "_rank") -> DataFrame:
    """One row per ``keys``: the first under ``order`` completed to a total order."""
    w = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)


def latest_by(df: DataFrame, keys: Sequence[str], version: str, tiebreak: Order = ()) -> DataFrame:
    """Highest ``version`` per key (NULL versions last), ties by ``tiebreak``."""
    return first_by(df, keys, [(version, "desc"), *tiebreak])


def pick_by_priority(df: DataFrame, keys: Sequence[str], priority: str, tiebreak: Order = ()) -> DataFrame:
    """Lowest ``priority`` per key (1 beats 2), ties by ``tiebreak``."""
    return first_by(df, keys, [(priority, "asc"), *tiebreak])
