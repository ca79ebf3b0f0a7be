"""Staging projections, the fact table and the genre marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelmill.functions.casts import numeric
from reelmill.functions.genres import genre_tokens
from reelmill.operators.joins import left_join
from reelmill.sources.schemas import FCT_MOVIES, GENRE_EXPLODED


def stg_basics(basics: DataFrame) -> DataFrame:
    return basics.select(
        "tconst",
        "primaryTitle",
        "originalTitle",
        numeric(basics, "startYear", whole=True).alias("start_year"),
        numeric(basics, "runtimeMinutes", whole=True).alias("runtime_minutes"),
        "genres",
    )


def stg_ratings(ratings: DataFrame) -> DataFrame:
    return ratings.select(
        "tconst",
        F.col("averageRating").alias("average_rating"),
        F.col("numVotes").alias("num_votes"),
    )


def fct_movies(staged_basics: DataFrame, staged_ratings: DataFrame, **route) -> DataFrame:
    """Every title with its rating, if any; ``route`` as for ``left_join``."""
    joined = left_join(staged_basics, staged_ratings, "tconst", **route)
    return joined.select(*FCT_MOVIES.names)


def genre_exploded(fct: DataFrame) -> DataFrame:
    """One row per title and listed genre, blanks around the genre removed."""
    return fct.withColumn("genre", F.explode(genre_tokens(F.col("genres")))).select(
        *GENRE_EXPLODED.names[:-1], F.trim("genre").alias("genre")
    )


def _rated(exploded: DataFrame) -> DataFrame:
    return exploded.where(F.col("average_rating").isNotNull())


def genre_partials(exploded: DataFrame) -> DataFrame:
    """Counts and sums by year and genre, from which both genre marts follow."""
    return _rated(exploded).groupBy("start_year", "genre").agg(
        F.count(F.lit(1)).alias("num_movies"),
        F.sum("average_rating").alias("sum_rating"),
        F.sum("num_votes").alias("total_votes"),
    )


def yearly_from_partials(partials: DataFrame) -> DataFrame:
    average = F.col("sum_rating") / F.col("num_movies")
    return partials.select(
        "start_year", "genre", "num_movies", average.alias("avg_rating"), "total_votes"
    )


def summary_from_partials(partials: DataFrame) -> DataFrame:
    return partials.groupBy("genre").agg(
        F.sum("num_movies").alias("num_movies"),
        (F.sum("sum_rating") / F.sum("num_movies")).alias("avg_rating"),
        F.sum("total_votes").alias("total_votes"),
    )


def order_summary(summary: DataFrame) -> DataFrame:
    """Reading order: most films first."""
    return summary.orderBy(F.desc_nulls_first("num_movies"), F.asc_nulls_last("genre"))


def order_yearly(yearly: DataFrame) -> DataFrame:
    """Reading order: by year and genre, unknown years last."""
    return yearly.orderBy(F.asc_nulls_last("start_year"), F.asc_nulls_last("genre"))
