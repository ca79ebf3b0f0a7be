"""The daily jobs, each runnable on its own, and their sequence.

Tables are read from and published to a ``TableStore``. A job that fails publishes
nothing: readers keep the previous version.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame

from reelmill.functions.casts import null_tokens
from reelmill.operators.forest import ForestParams
from reelmill.plans import clean, marts, ratings_model, upsert
from reelmill.plans.ratings_model import ModelRun
from reelmill.session import written_once
from reelmill.sources import schemas
from reelmill.sources.files import (
    films_of_pages, read_pages, require_all_pages, scan_external_ids, scan_genre_dim, scan_tsv,
)
from reelmill.sources.store import PinnedTables, TableStore, Version

BASICS_TABLE = "imdb_title_basics"
RATINGS_TABLE = "imdb_title_ratings"
NOW_PLAYING_TABLE = "tmdb_now_playing"


@dataclass(frozen=True)
class Landed:
    """Folders of one day's landed files."""

    basics: str
    ratings: str
    pages: str
    genres: str
    external_ids: str
    multi_line: bool = False
    pandas_na: bool = False
    quote: str = ""
    fractions: str = "error"
    partitions: int | None = None       # of cleaned titles and ratings, for few large files


def _spread(df: DataFrame, landed: Landed) -> DataFrame:
    """Rows of few unsplittable files dealt out, after the cleaning has dropped most."""
    return df.repartition(landed.partitions) if landed.partitions else df


def basics_of(store: TableStore, landed: Landed) -> DataFrame:
    raw = scan_tsv(store.spark, landed.basics, schemas.TITLE_BASICS_FILE, landed.quote)
    cleaned = clean.basics_clean(raw, null_tokens(landed.pandas_na), landed.fractions)
    return _spread(cleaned, landed)


def ratings_of(store: TableStore, landed: Landed) -> DataFrame:
    raw = scan_tsv(store.spark, landed.ratings, schemas.TITLE_RATINGS_FILE, landed.quote)
    cleaned = clean.ratings_clean(raw, null_tokens(landed.pandas_na), landed.fractions)
    return _spread(cleaned, landed)


def now_playing_of(store: TableStore, landed: Landed, run_date: date) -> DataFrame:
    """The landed snapshot; fails if pages of it are missing."""
    pages = read_pages(store.spark, landed.pages, landed.multi_line)
    require_all_pages(pages)
    return clean.now_playing_clean(
        films_of_pages(pages),
        scan_genre_dim(store.spark, landed.genres, landed.multi_line),
        scan_external_ids(store.spark, landed.external_ids),
        run_date,
        landed.fractions,
    )


def refresh_titles(store: TableStore, landed: Landed) -> None:
    """Full refresh of the title and ratings tables, each in its own commit."""
    store.full_refresh(BASICS_TABLE, basics_of(store, landed))
    store.full_refresh(RATINGS_TABLE, ratings_of(store, landed))


def refresh_now_playing(store: TableStore, landed: Landed, run_date: date) -> bool:
    """Full refresh of the snapshot table; an empty snapshot keeps the old rows."""
    films = now_playing_of(store, landed, run_date)
    return store.full_refresh(NOW_PLAYING_TABLE, films, skip_if_empty=True)


def stage_upserts(
    store: TableStore,
    basics: DataFrame,
    ratings: DataFrame,
    snapshots: DataFrame,
    on_duplicate: str = "error",
) -> dict[str, str]:
    """Write both merged tables, unpublished.

    The newest-per-film rows feed both merges, and each merge reads its source twice, so
    they are written once below the store and deleted at the end.
    """
    with store.scratch() as scratch:
        latest = written_once(upsert.latest_titled(snapshots), f"{scratch}/latest")
        new_basics = upsert.merge_basics(basics, latest, on_duplicate, f"{scratch}/basics")
        new_ratings = upsert.merge_ratings(ratings, latest, on_duplicate, f"{scratch}/ratings")
        return {
            BASICS_TABLE: store.stage(BASICS_TABLE, new_basics),
            RATINGS_TABLE: store.stage(RATINGS_TABLE, new_ratings),
        }


def upsert_titles(store: TableStore, on_duplicate: str = "error") -> None:
    """Merge the snapshot table into titles and ratings: one commit for both.

    Fails, and changes nothing, if one of the three tables is published meanwhile.
    """
    base = store.version()
    tables = store.pinned(base)
    raw = (tables.read(name) for name in (BASICS_TABLE, RATINGS_TABLE, NOW_PLAYING_TABLE))
    with store.attempt():
        staged = stage_upserts(store, *raw, on_duplicate)
        store.publish(staged, base, [NOW_PLAYING_TABLE])


def publish_or_discard(
    store: TableStore, staged: dict[str, str], base: Version, reads: Iterable[str] = ()
) -> None:
    """Publish folders staged outside an ``attempt``; they go if that fails."""
    try:
        store.publish(staged, base, reads)
    except Exception:
        store.discard(*staged.values())
        raise


def create_staging_views(store: TableStore, prefix: str = "") -> None:
    """Temporary staging views over the raw tables as of one commit, for SQL by name."""
    basics, ratings = staging(store.pinned())
    basics.createOrReplaceTempView(f"{prefix}stg_imdb_title_basics")
    ratings.createOrReplaceTempView(f"{prefix}stg_imdb_title_ratings")


def staging(tables: PinnedTables) -> tuple[DataFrame, DataFrame]:
    """The staging views of both raw tables, read at one version."""
    return marts.stg_basics(tables.read(BASICS_TABLE)), marts.stg_ratings(tables.read(RATINGS_TABLE))


def laid_out(facts: DataFrame) -> DataFrame:
    """The fact table in ranges of year and title: each file holds few years, a large year
    lies in several files, and readers of some years skip the other files."""
    ranged = facts.repartitionByRange("start_year", "tconst")
    return ranged.sortWithinPartitions("start_year", "tconst")


def build_marts(store: TableStore) -> None:
    """Fact table and genre marts: one commit for all four.

    Each mart reads the one written before it, so the join runs once; both genre
    marts come from one pass over the exploded rows.
    """
    base = store.version()
    with store.attempt(), store.scratch() as scratch:
        joined = written_once(marts.fct_movies(*staging(store.pinned(base))), f"{scratch}/facts")
        fct = store.stage("fct_movies", laid_out(joined))
        exploded = store.stage(
            "genre_exploded", marts.genre_exploded(store.read_staged("fct_movies", fct))
        )
        rows = store.read_staged("genre_exploded", exploded)
        partials = written_once(marts.genre_partials(rows), f"{scratch}/partials")
        staged = {
            "fct_movies": fct,
            "genre_exploded": exploded,
            "genre_yearly_metrics": store.stage(
                "genre_yearly_metrics", marts.yearly_from_partials(partials)
            ),
            "genre_summary": store.stage("genre_summary", marts.summary_from_partials(partials)),
        }
        store.publish(staged, base, [BASICS_TABLE, RATINGS_TABLE])


def publish_model_results(
    store: TableStore, run: ModelRun | None, base: Version | None = None
) -> bool:
    """Publish predictions and trends together; without a run nothing changes.

    Trends are computed from the written predictions, so rows are scored once.
    """
    if run is None:
        return False
    with store.attempt():
        predictions = store.stage("imdb_rating_predictions", run.predictions)
        trends = ratings_model.genre_rating_trends(
            store.read_staged("imdb_rating_predictions", predictions)
        )
        staged = {
            "imdb_rating_predictions": predictions,
            "imdb_genre_rating_trends": store.stage("imdb_genre_rating_trends", trends),
        }
        store.publish(staged, base or store.version(), ["fct_movies"] if base else [])
    return True


def train_and_publish(
    store: TableStore, params: ForestParams = ForestParams(), rated_only: bool = True
) -> ModelRun | None:
    """Train, evaluate and publish; the run's predictions are the published ones."""
    base = store.version()
    with store.scratch() as scratch:
        fct = store.read("fct_movies", base)
        run = ratings_model.train_and_evaluate(fct, scratch, params, rated_only)
        if not publish_model_results(store, run, base):
            return None
    published = ratings_model.with_rated_flag(store.read("imdb_rating_predictions"))
    return replace(run, predictions=published)


def daily_run(
    store: TableStore,
    landed: Landed,
    run_date: date,
    params: ForestParams = ForestParams(),
    on_duplicate: str = "error",
    rated_only: bool = True,
) -> ModelRun | None:
    """The whole day. Readers see titles and snapshot change in one step, never the
    refreshed titles without the upserts. What was staged on the way is deleted."""
    base = store.version()
    with store.attempt():
        snapshot = store.stage(NOW_PLAYING_TABLE, now_playing_of(store, landed, run_date))
        snapshots = store.read_staged(NOW_PLAYING_TABLE, snapshot)
        fresh = {NOW_PLAYING_TABLE: snapshot}
        if snapshots.isEmpty():
            store.discard(snapshot)
            snapshots = store.read(NOW_PLAYING_TABLE, base)
            fresh = {}
        cleaned = {
            BASICS_TABLE: store.stage(BASICS_TABLE, basics_of(store, landed)),
            RATINGS_TABLE: store.stage(RATINGS_TABLE, ratings_of(store, landed)),
        }
        raw = (store.read_staged(table, location) for table, location in cleaned.items())
        merged = stage_upserts(store, *raw, snapshots, on_duplicate)
        store.discard(*cleaned.values())
        store.publish({**fresh, **merged}, base, [NOW_PLAYING_TABLE])
    build_marts(store)
    return train_and_publish(store, params, rated_only)
