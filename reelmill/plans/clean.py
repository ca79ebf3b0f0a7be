"""Raw files to typed rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from reelmill.functions.casts import (
    NULL_TOKENS, coerce_date, coerce_double, coerce_int, normalize_nulls, strict_int,
)
from reelmill.functions.genres import join_ids
from reelmill.operators.lookups import external_ids, genre_names
from reelmill.sources.schemas import BASICS, NOW_PLAYING, RATINGS

FIRST_YEAR = 2000


def typed_basics(raw: DataFrame, tokens=NULL_TOKENS, fractions: str = "error") -> DataFrame:
    """Title rows with NULL tokens removed and figures typed.

    The lenient casts already give NULL for every token, so their columns skip the
    token check; the year's cast sits in the filter too and stays short.
    """
    lenient = {"startYear", "runtimeMinutes"}
    texts = [c for c in raw.columns if c not in lenient]
    return normalize_nulls(raw, tokens, texts).withColumns(
        {
            "isAdult": strict_int(F.col("isAdult")),
            "startYear": coerce_int(F.col("startYear"), fractions),
            "runtimeMinutes": coerce_int(F.col("runtimeMinutes"), fractions),
        }
    )


def keep_movies(typed: DataFrame, first_year: int = FIRST_YEAR) -> DataFrame:
    """Films that are not adult, from ``first_year`` on; an unknown value drops the row."""
    return typed.where(
        (F.col("isAdult") == 0)
        & (F.col("startYear") >= first_year)
        & (F.col("titleType") == "movie")
    )


def basics_clean(raw: DataFrame, tokens=NULL_TOKENS, fractions: str = "error") -> DataFrame:
    return keep_movies(typed_basics(raw, tokens, fractions)).select(*BASICS.names)


def ratings_clean(raw: DataFrame, tokens=NULL_TOKENS, fractions: str = "error") -> DataFrame:
    typed = normalize_nulls(raw, tokens, ["tconst"]).withColumns(
        {
            "averageRating": coerce_double(F.col("averageRating")),
            "numVotes": coerce_int(F.col("numVotes"), fractions),
        }
    )
    return typed.select(*RATINGS.names)


def now_playing_clean(
    films: DataFrame,
    genre_dim: DataFrame,
    crosswalk: DataFrame,
    run_date: date,
    fractions: str = "error",
) -> DataFrame:
    """Listed films of one snapshot in the shape of the now-playing table.

    ``run_date`` is the UTC day of the run; it is passed in so that a rerun of an
    earlier day gives the same rows.
    """
    keyed = films.withColumnRenamed("id", "tmdb_id")
    typed = genre_names(external_ids(keyed, crosswalk), genre_dim).withColumns(
        {
            "release_date": coerce_date(F.col("release_date")),
            "popularity": coerce_double(F.col("popularity")),
            "vote_average": coerce_double(F.col("vote_average")),
            "vote_count": coerce_int(F.col("vote_count"), fractions),
            "genre_ids": join_ids(F.col("genre_ids")),
            "snapshot_date": F.lit(run_date),
        }
    )
    return typed.select(*NOW_PLAYING.names)
