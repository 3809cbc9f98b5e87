"""Skew-safe equi-joins.

A many-to-many join on a report or study key multiplies rows inside each key,
and one key may hold a third of all rows.  A plain sort-merge join sends that
key to one task.  ``SaltPlan`` splits such keys over a grid of tasks:

* rows per key are counted on both sides (partial + final aggregate: a hot key
  is combined map-side, so the count itself is not skewed), and keys that would
  give more than ``pairs_per_cell`` pairs are hot; every other key takes the
  ordinary path, exactly;
* a hot key with ``a`` left and ``b`` right rows gets a p x q grid with
  ``(a / p) * (b / q) <= pairs_per_cell``: the smaller side is split down to
  the square root of that bound, the larger as far as the bound then asks;
* a left row goes to split ``hash(row) mod p`` and is copied to all ``q`` right
  splits, a right row to ``hash(row) mod q`` and copied to all ``p``; each
  (key, i, j) cell joins its share and every pair meets in exactly one cell.

A hot key has more rows than the square root of that bound on one side.  Keys
that do are found first, behind a shuffle of their own: where there are none,
AQE sees it empty and drops the joins that look the splits up, with their sorts.

Nothing runs while a plan is built: the hot keys are a DataFrame, without a
limit on their number or on the splits, and part of the one query.  They carry
no broadcast hint, as their number grows with the data: AQE broadcasts them
when their measured size is small.  The split is a content hash, not
``rand()``, so a recomputed partition after executor loss lands in the same
cells; rows that are identical hash alike, so make inputs distinct first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SALT_I = "_salt_i"
SALT_J = "_salt_j"
_P = "_salt_p"
_Q = "_salt_q"


@dataclass(frozen=True)
class SkewSpec:
    """``pairs_per_cell``: pairs of one key that one task may join; a key with
    more is split.  0 leaves the joins plain."""

    pairs_per_cell: int = 4_000_000


class SaltPlan:
    """Salt assignment for joins on ``keys`` between a left and a right input.

    ``hot`` holds a row (keys, splits of the left side, splits of the right
    side) per hot key; ``None`` leaves every frame as it is."""

    def __init__(self, keys: Sequence[str], hot: DataFrame | None):
        self.keys = list(keys)
        self.hot = hot

    @classmethod
    def detect(cls, left: DataFrame, right: DataFrame, keys: Sequence[str], spec: SkewSpec = SkewSpec()) -> SaltPlan:
        if spec.pairs_per_cell <= 0:
            return cls(keys, None)
        most = spec.pairs_per_cell
        edge = max(1, int(most**0.5))
        a, b = F.col("_a").cast("double"), F.col("_b").cast("double")
        counts_a, counts_b = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_a")), right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_b"))
        large = counts_a.filter(F.col("_a") > edge).select(*keys).unionByName(counts_b.filter(F.col("_b") > edge).select(*keys))
        # by a hash: a repartition by the keys, as the union has it, would be dropped
        large = large.repartition(F.xxhash64(*keys)).distinct()
        counts = large.join(counts_a, list(keys)).join(counts_b, list(keys))
        less, more = F.least(a, b), F.greatest(a, b)
        few = F.ceil(less / edge)
        many = F.ceil(more * F.ceil(less / few) / most)
        hot = counts.filter(a * b > most).select(
            *keys,
            F.when(a <= b, few).otherwise(many).cast("int").alias(_P),
            F.when(a <= b, many).otherwise(few).cast("int").alias(_Q),
        )
        return cls(keys, hot)

    @property
    def join_keys(self) -> list[str]:
        return self.keys if self.hot is None else [*self.keys, SALT_I, SALT_J]

    def _place(self, df: DataFrame, i, j) -> DataFrame:
        if self.hot is None:
            return df
        hashed = F.xxhash64(*[F.col(c) for c in df.columns])
        one = F.lit(1)
        s = df.withColumn("_salt_h", hashed).join(self.hot, self.keys, "left").withColumns({_P: F.coalesce(_P, one), _Q: F.coalesce(_Q, one)})
        return s.withColumn(SALT_I, i(_P)).withColumn(SALT_J, j(_Q)).drop(_P, _Q, "_salt_h")

    @staticmethod
    def _share(n: str) -> Column:
        return F.pmod(F.col("_salt_h"), F.col(n).cast("long")).cast("int")

    @staticmethod
    def _every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def left(self, df: DataFrame) -> DataFrame:
        """Split on the left axis, copy across the right axis."""
        return self._place(df, self._share, self._every)

    def right(self, df: DataFrame) -> DataFrame:
        """Copy across the left axis, split on the right axis."""
        return self._place(df, self._every, self._share)

    def both(self, df: DataFrame) -> DataFrame:
        """Copy to every cell: for inputs with one row per key."""
        return self._place(df, self._every, self._every)

    def unsalt(self, df: DataFrame) -> DataFrame:
        return df if self.hot is None else df.drop(SALT_I, SALT_J)


def skew_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", spec: SkewSpec = SkewSpec()) -> DataFrame:
    """``left.join(right, keys, how)`` with hot keys split over several tasks.

    ``how`` is ``inner`` or ``left``.  The rows of a left join that match are
    those of the inner join, so keys hot on either side are split; the others
    are added from an anti join, since copies of an unmatched row would each
    give a row of nulls.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports how='inner' or 'left'")
    plan = SaltPlan.detect(left, right, keys, spec)
    if plan.hot is None:
        return left.join(right, list(keys), how)
    matched = plan.unsalt(plan.left(left).join(plan.right(right), plan.join_keys))
    if how == "inner":
        return matched
    alone = left.join(right.select(*keys).distinct(), list(keys), "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)
