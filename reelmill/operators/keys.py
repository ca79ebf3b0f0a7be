"""Key handling: newest row per key, one row per key, no NULL keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_by: str, ties: Sequence[str] | None = None
) -> DataFrame:
    """The newest row of every key; an undated row counts as newest.

    Ties are settled by the remaining columns, so the choice does not depend on how
    the input is partitioned. Spark keeps one row per key in every map task before
    the shuffle, so a key with very many rows sends few of them.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c != newest_by]
    order = [F.desc_nulls_first(newest_by), *[F.asc_nulls_last(c) for c in ties]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; reading them fails if one of ``columns`` is NULL."""
    for name in columns:
        check = F.assert_true(F.col(name).isNotNull(), f"NULL in required column {name}")
        df = df.where(check.isNull())
    return df


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """The same rows; reading them fails if a key repeats or is NULL.

    Counts are combined map-side, so a key that repeats very often is found without
    bringing its rows together.
    """
    others = [c for c in df.columns if c != key]
    counted = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.first(c).alias(c) for c in others]
    )
    single = F.col(key).isNotNull() & (F.col("_rows") == 1)
    check = F.assert_true(single, f"NULL or repeated {key} in merge source")
    return counted.where(check.isNull()).select(*df.columns)


def one_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) with one row per key: the least non-NULL value."""
    return df.groupBy(key).agg(F.min(value).alias(value))
