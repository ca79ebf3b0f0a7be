"""Left joins that hold when one key carries a large share of the rows.

AQE splits an oversized partition of a left join only on the left side, and only
where the join reads both shuffles directly. The two cases it cannot help with are
routed around it: keys that are frequent on the right, and frequent left keys
against a right side that comes out of an aggregation. Frequent keys are found by
a mergeable one-column sketch, and only for inputs large enough to matter; small
inputs keep the plain join and cost no extra job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelmill.session import fits_broadcast, input_bytes

CHECK_BYTES = 1 << 30       # inputs smaller than this are never checked
HOT_ROWS = 1_000_000        # a key with fewer rows does not trouble one task
SUPPORT = 0.001             # share of rows that makes a candidate; at most 1/SUPPORT keys


def hot_keys(
    df: DataFrame, key: str, hot_rows: int = HOT_ROWS, support: float = SUPPORT
) -> list:
    """Non-NULL keys with at least ``hot_rows`` rows: at most ``1 / support`` of them.

    Two passes over one column. The result only decides which plan a row takes, so
    a key the sketch misses costs time and never rows.
    """
    keys = df.select(F.col(key).alias("k")).where("k is not null")
    candidates = keys.stat.freqItems(["k"], support).first()[0]
    if not candidates:
        return []
    counts = keys.where(F.col("k").isin(candidates)).groupBy("k").count()
    return sorted(row["k"] for row in counts.where(F.col("count") >= hot_rows).collect())


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    right_unique: bool = False,
    check_bytes: float = CHECK_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``left`` left-joined to ``right`` on ``key``, all rows of both multiplicities.

    ``right_unique`` states that the right side has one row per key, as after an
    aggregation by it. A right side that Spark broadcasts needs no care: nothing is
    shuffled then.
    """
    watched = left if right_unique else right
    if input_bytes(watched) < check_bytes or fits_broadcast(right):
        return left.join(right, key, "left")
    hot = hot_keys(watched, key, hot_rows)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False)) if hot else F.lit(False)
    if right_unique:
        return _broadcast_hot(left, right, key, is_hot)
    if not hot:
        return left.join(right, key, "left")
    # A hot key exists on the right, so for its rows the left join is an inner join,
    # where AQE may split both sides.
    plain = left.where(~is_hot).join(right.where(~is_hot), key, "left")
    return plain.unionByName(left.where(is_hot).join(right.where(is_hot), key, "inner"))


def _broadcast_hot(left: DataFrame, right: DataFrame, key: str, is_hot: Column) -> DataFrame:
    """Hot and NULL left keys meet the few right rows they can match map-side.

    The broadcast holds at most one row per hot key, and their number is bounded.
    """
    aside = F.col(key).isNull() | is_hot
    plain = left.where(~aside).join(right, key, "left")
    few = F.broadcast(right.where(is_hot))
    return plain.unionByName(left.where(aside).join(few, key, "left"))
