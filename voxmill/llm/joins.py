"""Joins that hold up when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than 1/HOT_SHARE of the rows is joined by broadcast; there are fewer than
#: HOT_SHARE such keys, whatever the size of the data.
HOT_SHARE = 1000
#: Rows that a narrow side may have to be broadcast whole; above this both sides are shuffled.
BROADCAST_ROWS = 200_000
#: Rows up to which ``weighted_join`` broadcasts its right side whole.
FEW_ROWS = 10_000


def weighted_join(left: DataFrame, right: DataFrame, keys: list[str], weight: str, how: str = "left") -> DataFrame:
    """Join ``left`` to ``right``, which has one row per key and in ``weight`` its rows in ``left``.

    ``right`` is counted: up to FEW_ROWS rows it is broadcast. Beyond that the hot keys' rows are
    (fewer than HOT_SHARE by arithmetic), and all others meet in a shuffle in which no key has
    more than 1/HOT_SHARE of the rows. Keys must not be null.
    """
    total, rows = right.agg(F.coalesce(F.sum(weight), F.lit(0)), F.count("*")).first()
    if rows <= FEW_ROWS:
        return left.join(F.broadcast(right), keys, how)
    is_hot = F.col(weight) * HOT_SHARE > F.lit(total)
    hot, cold = right.filter(is_hot), right.filter(~is_hot)
    met = left.join(F.broadcast(hot), keys, "inner")
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, how)
    return met.unionByName(rest.select(*met.columns))


def keyed_filter(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join with a narrow written table ``right``.

    ``right`` is counted: up to BROADCAST_ROWS rows it is broadcast, so the wide side stays
    where it is; beyond that both sides are shuffled by the keys.
    """
    small = right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return left.join(F.broadcast(right) if small else right.hint("merge"), keys, how)
