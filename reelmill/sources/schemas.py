"""Declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}


def _struct(**columns: str | T.DataType) -> T.StructType:
    """``name='type'``, or ``name='type!'`` for a column that may not be NULL."""
    schema = T.StructType()
    for name, kind in columns.items():
        if isinstance(kind, str):
            schema.add(name, _TYPES[kind.rstrip("!")], nullable=not kind.endswith("!"))
        else:
            schema.add(name, kind)
    return schema


TITLE_BASICS_FILE = _struct(
    tconst="string", titleType="string", primaryTitle="string", originalTitle="string",
    isAdult="string", startYear="string", endYear="string", runtimeMinutes="string",
    genres="string",
)

TITLE_RATINGS_FILE = _struct(tconst="string", averageRating="string", numVotes="string")

BASICS = _struct(
    tconst="string!", primaryTitle="string", originalTitle="string",
    startYear="bigint", runtimeMinutes="bigint", genres="string",
)

RATINGS = _struct(tconst="string!", averageRating="double", numVotes="bigint")

# Figures and dates are read as text so that a bad one becomes NULL by our own
# rule instead of failing, or silently emptying, the whole page.
LISTED_FILM = _struct(
    id="bigint", title="string", original_title="string", original_language="string",
    release_date="string", popularity="string", vote_average="string", vote_count="string",
    genre_ids="string", adult="boolean",
)

PAGE = _struct(page="bigint", total_pages="bigint", results=T.ArrayType(LISTED_FILM))

GENRE_LIST = _struct(genres=T.ArrayType(_struct(id="bigint", name="string")))

EXTERNAL_IDS = _struct(tmdb_id="bigint", imdb_id="string")

NOW_PLAYING = _struct(
    tmdb_id="bigint!", imdb_id="string", title="string", original_title="string",
    original_language="string", release_date="date", popularity="double",
    vote_average="double", vote_count="bigint", genre_ids="string", genre_names="string",
    adult="boolean", snapshot_date="date",
)

FCT_MOVIES = _struct(
    tconst="string", primaryTitle="string", originalTitle="string", start_year="bigint",
    runtime_minutes="bigint", genres="string", average_rating="double", num_votes="bigint",
)

GENRE_EXPLODED = _struct(
    tconst="string", primaryTitle="string", originalTitle="string", start_year="bigint",
    runtime_minutes="bigint", average_rating="double", num_votes="bigint", genre="string",
)

GENRE_SUMMARY = _struct(
    genre="string", num_movies="bigint", avg_rating="double", total_votes="bigint"
)

GENRE_YEARLY_METRICS = _struct(
    start_year="bigint", genre="string", num_movies="bigint", avg_rating="double",
    total_votes="bigint",
)

PREDICTIONS = _struct(
    tconst="string", primaryTitle="string", startYear="bigint", genres="string",
    numVotes="bigint", averageRating="double", predictedRating="double",
)

TRENDS = _struct(
    year="bigint", genre="string", averageRating="double", predictedRating="double",
    movieCount="bigint",
)

TABLES = {
    "imdb_title_basics": BASICS,
    "imdb_title_ratings": RATINGS,
    "tmdb_now_playing": NOW_PLAYING,
    "fct_movies": FCT_MOVIES,
    "genre_exploded": GENRE_EXPLODED,
    "genre_summary": GENRE_SUMMARY,
    "genre_yearly_metrics": GENRE_YEARLY_METRICS,
    "imdb_rating_predictions": PREDICTIONS,
    "imdb_genre_rating_trends": TRENDS,
}
