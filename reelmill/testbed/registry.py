"""One query per operator, over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelmill.functions import casts, eras, genres
from reelmill.operators import encode, keys, lookups, statistics
from reelmill.operators.forest import ForestParams
from reelmill.plans import clean, jobs, marts, ratings_model as rm, upsert
from reelmill.session import written_once
from reelmill.sources import files, schemas
from reelmill.sources.store import TableStore
from reelmill.streaming.now_playing import follow_pages
from reelmill.testbed import inputs, landing

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = date(2024, 6, 2)

QUERIES: dict[str, Query] = {}
SHARED: dict = {}           # results that several queries look at; clear it to time them


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def once_per_session(make: Callable) -> Callable:
    """Queries that look at one result of a long job share it within a session."""

    def shared(spark: SparkSession, sf_dir: str):
        key = (make.__name__, spark.sparkContext.applicationId, sf_dir)
        if key not in SHARED:
            SHARED[key] = make(spark, sf_dir)
        return SHARED[key]

    return shared


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def steady_means(df: DataFrame, count: str, *means: str) -> DataFrame:
    """Means free of summation-order noise: their sums are whole thousandths."""
    return df.withColumns({m: F.round(F.col(m) * F.col(count), 3) / F.col(count) for m in means})


def dates_as_text(df: DataFrame) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.col(c).cast("string") for c in kinds if kinds[c] == "date"})


def new_store(spark: SparkSession) -> TableStore:
    return TableStore(spark, landing.workspace(spark))


def clean_basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.basics_clean(inputs.basics_raw(spark, sf_dir))


def clean_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.ratings_clean(inputs.ratings_raw(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fct_movies(
        marts.stg_basics(clean_basics(spark, sf_dir)),
        marts.stg_ratings(clean_ratings(spark, sf_dir)),
    )


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rm.prepare(rm.training_rows(fact(spark, sf_dir)))


def stored_fact(spark: SparkSession, sf_dir: str) -> TableStore:
    """A store with the fact table written, as the model's several passes read it."""
    store = new_store(spark)
    store.full_refresh("fct_movies", fact(spark, sf_dir))
    return store


def stored_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rm.prepare(rm.training_rows(stored_fact(spark, sf_dir).read("fct_movies")))


#: Trees of bounded depth, for the checks of published predictions against what was planted, film by
#: film. Fully grown ones also follow the titles of unknown running time, which count as ones of the
#: median running time, so there single predictions are off by more than the checks allow.
BOUNDED = ForestParams(depth=15)


@once_per_session
def trained(spark: SparkSession, sf_dir: str) -> rm.ModelRun:
    """The default forest, grown until it fits."""
    fct = stored_fact(spark, sf_dir).read("fct_movies")
    return rm.train_and_evaluate(fct, landing.workspace(spark), ForestParams())


def stand_in() -> Column:
    """A fixed formula in place of a trained model, so that results can be checked."""
    return 5.0 + (F.col("startYear") % 7) / 4.0 - (F.col("numVotes") % 3) / 8.0


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.latest_titled(inputs.snapshots(spark, sf_dir))


def now_playing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.now_playing_clean(
        inputs.listed_films(spark, sf_dir),
        inputs.genre_dim(spark, sf_dir),
        inputs.crosswalk(spark, sf_dir),
        RUN_DATE,
    )


# Sources


@query
def scan_tsv_basics(spark, sf_dir):
    path = landing.write_tsv(inputs.basics_raw(spark, sf_dir), f"{landing.workspace(spark)}/basics")
    return files.scan_tsv(spark, path, schemas.TITLE_BASICS_FILE)


@query
def scan_tsv_ratings(spark, sf_dir):
    path = landing.write_tsv(inputs.ratings_raw(spark, sf_dir), f"{landing.workspace(spark)}/ratings")
    return files.scan_tsv(spark, path, schemas.TITLE_RATINGS_FILE)


@query
def null_tokens(spark, sf_dir):
    raw = inputs.null_marks(spark, sf_dir)
    plain = casts.normalize_nulls(raw, columns=["plain"])
    return casts.normalize_nulls(plain, casts.null_tokens(pandas_na=True), columns=["as_pandas"])


@query
def scan_json_pages(spark, sf_dir):
    path = landing.write_json(inputs.pages(spark, sf_dir), f"{landing.workspace(spark)}/pages")
    films = files.scan_pages(spark, path)
    return films.withColumn("genre_ids", genres.join_ids(F.col("genre_ids")))


@query
def scan_genre_dim(spark, sf_dir):
    listed = landing.genre_list(inputs.genre_dim(spark, sf_dir))
    path = landing.write_json(listed, f"{landing.workspace(spark)}/genres")
    return files.scan_genre_dim(spark, path)


@query
def external_id_lookup(spark, sf_dir):
    films = inputs.listed_films(spark, sf_dir).select(F.col("id").alias("tmdb_id"), "title")
    repeated = inputs.crosswalk(spark, sf_dir).union(inputs.crosswalk(spark, sf_dir))
    return lookups.external_ids(films, repeated)


@query
def scan_fct_projection(spark, sf_dir):
    store = stored_fact(spark, sf_dir)
    store.create_views("projection_")
    return rm.training_rows(spark.table("projection_fct_movies"))


# Sinks


@query
def full_refresh(spark, sf_dir):
    store = new_store(spark)
    ratings = clean_ratings(spark, sf_dir)
    store.full_refresh("imdb_title_ratings", ratings.withColumn("numVotes", F.lit(0)))
    store.full_refresh("imdb_title_ratings", ratings)
    return store.read("imdb_title_ratings")


@query
def full_refresh_empty(spark, sf_dir):
    store = new_store(spark)
    store.full_refresh("tmdb_now_playing", inputs.snapshots(spark, sf_dir), skip_if_empty=True)
    nothing = inputs.snapshots(spark, sf_dir).where(F.lit(False))
    store.full_refresh("tmdb_now_playing", nothing, skip_if_empty=True)
    return dates_as_text(store.read("tmdb_now_playing"))


@query
def create_if_missing(spark, sf_dir):
    """Merging into tables never loaded: every source row is an insert."""
    store = new_store(spark)
    store.full_refresh("tmdb_now_playing", inputs.snapshots(spark, sf_dir))
    jobs.upsert_titles(store)
    return store.read("imdb_title_basics")


@query
def not_null_key(spark, sf_dir):
    return keys.require_not_null(clean_ratings(spark, sf_dir), ["tconst"])


@query
def merge_basics(spark, sf_dir):
    scratch = landing.workspace(spark)
    return upsert.merge_basics(
        clean_basics(spark, sf_dir), latest(spark, sf_dir), scratch=scratch
    )


@query
def merge_ratings(spark, sf_dir):
    """The full outer route, for sources as large as the target."""
    return upsert.merge_ratings(clean_ratings(spark, sf_dir), latest(spark, sf_dir))


@query
def merge_latest_duplicate(spark, sf_dir):
    """Merge whose source repeats every key; the newest repeat wins."""
    source = latest(spark, sf_dir)
    older = source.withColumns(
        {"snapshot_date": F.date_sub("snapshot_date", 30), "title": F.lit("outdated")}
    )
    return upsert.merge_basics(
        clean_basics(spark, sf_dir),
        source.unionByName(older),
        on_duplicate="latest",
        scratch=landing.workspace(spark),
    )


@query
def upsert_job(spark, sf_dir):
    """Both merges through the store; the ratings as then published."""
    store = new_store(spark)
    store.full_refresh("imdb_title_basics", clean_basics(spark, sf_dir))
    store.full_refresh("imdb_title_ratings", clean_ratings(spark, sf_dir))
    store.full_refresh("tmdb_now_playing", inputs.snapshots(spark, sf_dir), skip_if_empty=True)
    jobs.upsert_titles(store)
    return store.read("imdb_title_ratings")


# Projections, casts, filters


@query
def project_basics(spark, sf_dir):
    return inputs.basics_raw(spark, sf_dir).select(*schemas.BASICS.names)


@query
def rename_columns(spark, sf_dir):
    return rm.training_rows(fact(spark, sf_dir))


@query
def strict_int_cast(spark, sf_dir):
    raw = inputs.basics_raw(spark, sf_dir)
    return raw.select("tconst", casts.strict_int(F.col("isAdult")).alias("is_adult"))


@query
def coerce_int(spark, sf_dir):
    raw = inputs.messy_numbers(spark, sf_dir)
    return raw.select("k", casts.coerce_int(F.col("txt")).alias("value"))


@query
def coerce_double(spark, sf_dir):
    raw = inputs.messy_numbers(spark, sf_dir)
    return raw.select("k", casts.coerce_double(F.col("txt")).alias("value"))


@query
def coerce_date(spark, sf_dir):
    films = inputs.listed_films(spark, sf_dir)
    return films.select("id", casts.coerce_date(F.col("release_date")).cast("string").alias("day"))


@query
def stg_basics(spark, sf_dir):
    """Staging cast on text columns, as the figures arrive untyped."""
    raw = inputs.basics_raw(spark, sf_dir).withColumn(
        "runtimeMinutes", F.concat("runtimeMinutes", F.lit(".5"))
    )
    return marts.stg_basics(raw)


@query
def stg_ratings(spark, sf_dir):
    return marts.stg_ratings(clean_ratings(spark, sf_dir))


@query
def filter_movies(spark, sf_dir):
    typed = clean.typed_basics(inputs.basics_raw(spark, sf_dir))
    return clean.keep_movies(typed).select("tconst", "titleType", "isAdult", "startYear")


@query
def filter_rated(spark, sf_dir):
    return fact(spark, sf_dir).where(F.col("average_rating").isNotNull())


@query
def filter_prefix(spark, sf_dir):
    films = inputs.crosswalk(spark, sf_dir)
    return films.where(F.col("imdb_id").isNotNull() & F.col("imdb_id").startswith("tt"))


@query
def dropna_year(spark, sf_dir):
    typed = clean.typed_basics(inputs.basics_raw(spark, sf_dir))
    return typed.dropna(subset=["startYear"]).select("tconst", "startYear")


@query
def rated_flag(spark, sf_dir):
    return rm.with_rated_flag(prepared(spark, sf_dir)).select("tconst", "hasActualRating")


@query
def split_train_test(spark, sf_dir):
    return rm.split_sizes(prepared(spark, sf_dir))


@query
def fill_unknown(spark, sf_dir):
    return prepared(spark, sf_dir).select("tconst", "genres")


@query
def tmdb_to_basics(spark, sf_dir):
    return upsert.to_basics(latest(spark, sf_dir)).drop("snapshot_date")


@query
def tmdb_to_ratings(spark, sf_dir):
    return upsert.to_ratings(latest(spark, sf_dir)).drop("snapshot_date")


@query
def latest_per_key(spark, sf_dir):
    newest = keys.latest_per_key(inputs.snapshots(spark, sf_dir), ["tmdb_id"], "snapshot_date")
    return dates_as_text(newest)


# Cleaning pipelines


@query
def basics_clean(spark, sf_dir):
    return clean_basics(spark, sf_dir)


@query
def ratings_clean(spark, sf_dir):
    return clean_ratings(spark, sf_dir)


@query
def tmdb_clean(spark, sf_dir):
    return dates_as_text(now_playing(spark, sf_dir))


@query
def genre_ids_join(spark, sf_dir):
    films = inputs.listed_films(spark, sf_dir)
    return films.select("id", genres.join_ids(F.col("genre_ids")).alias("genre_ids"))


@query
def genre_names(spark, sf_dir):
    films = inputs.listed_films(spark, sf_dir).select("id", "genre_ids")
    return lookups.genre_names(films, inputs.genre_dim(spark, sf_dir)).drop("genre_ids")


@query
def genre_names_large_dim(spark, sf_dir):
    """The same lookup through the join that serves dictionaries too big for a literal."""
    films = inputs.listed_films(spark, sf_dir).select("id", "genre_ids")
    dim = inputs.genre_dim(spark, sf_dir)
    return lookups.genre_names(films, dim, literal_entries=0).drop("genre_ids")


# Marts


def partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.genre_partials(marts.genre_exploded(fact(spark, sf_dir)))


@query
def fct_movies(spark, sf_dir):
    return fact(spark, sf_dir)


@query
def fct_movies_hot_keys(spark, sf_dir):
    """The same table by the route that very frequent keys take."""
    return marts.fct_movies(
        marts.stg_basics(clean_basics(spark, sf_dir)),
        marts.stg_ratings(clean_ratings(spark, sf_dir)),
        check_bytes=0,
        hot_rows=1,
    )


@query
def genre_exploded(spark, sf_dir):
    return marts.genre_exploded(fact(spark, sf_dir))


@query
def genre_summary(spark, sf_dir):
    summary = marts.summary_from_partials(partials(spark, sf_dir))
    return marts.order_summary(steady_means(summary, "num_movies", "avg_rating"))


@query
def genre_yearly_metrics(spark, sf_dir):
    yearly = marts.yearly_from_partials(partials(spark, sf_dir))
    return marts.order_yearly(steady_means(yearly, "num_movies", "avg_rating"))


@query
def genre_summary_from_partials(spark, sf_dir):
    """The summary over stored partials, as the mart job computes it."""
    stored = written_once(partials(spark, sf_dir), landing.workspace(spark))
    return steady_means(marts.summary_from_partials(stored), "num_movies", "avg_rating")


def built_marts(spark: SparkSession, sf_dir: str) -> TableStore:
    store = new_store(spark)
    store.full_refresh("imdb_title_basics", clean_basics(spark, sf_dir))
    store.full_refresh("imdb_title_ratings", clean_ratings(spark, sf_dir))
    jobs.build_marts(store)
    return store


@query
def mart_tables(spark, sf_dir):
    """The genre summary as the mart job publishes it, read by table name."""
    built_marts(spark, sf_dir).create_views("mart_")
    return steady_means(spark.table("mart_genre_summary"), "num_movies", "avg_rating")


@query
def staging_views(spark, sf_dir):
    """The fact table as SQL over the staging views."""
    store = new_store(spark)
    store.full_refresh("imdb_title_basics", clean_basics(spark, sf_dir))
    store.full_refresh("imdb_title_ratings", clean_ratings(spark, sf_dir))
    jobs.create_staging_views(store, "query_")
    return spark.sql(
        """SELECT b.*, r.average_rating, r.num_votes
           FROM query_stg_imdb_title_basics b
           LEFT JOIN query_stg_imdb_title_ratings r ON b.tconst = r.tconst"""
    )


@query
def pinned_reads(spark, sf_dir):
    """The ratings as of the commit that a job began with, after a later one emptied the table."""
    store = new_store(spark)
    store.full_refresh("imdb_title_ratings", clean_ratings(spark, sf_dir))
    tables = store.pinned()
    store.full_refresh("imdb_title_ratings", clean_ratings(spark, sf_dir).where("false"))
    return tables.read("imdb_title_ratings")


@query
def snapshot_stream(spark, sf_dir):
    """The snapshot whose pages land over two triggers, and how many films the first published."""
    landed = landing.land_pages(spark, sf_dir)
    whole = inputs.pages(spark, sf_dir)
    store, checkpoint = new_store(spark), landing.workspace(spark)
    published = []
    for part in (0, 1):
        whole.where(F.col("page") % 2 == part).write.mode("append").json(landed.pages)
        follow_pages(store, landed, checkpoint, lambda: RUN_DATE).awaitTermination()
        published.append(store.read("tmdb_now_playing").count())
    return dates_as_text(store.read("tmdb_now_playing")).withColumn("after_half", F.lit(published[0]))


# Model


@query
def wide_medians(spark, sf_dir):
    """Medians of doubles, of one scale and of many, from intervals narrowed several times."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    scale = F.lit(1.0)
    for k in range(8):          # down to 1e-76, by exact powers of two
        scale = scale * F.when(F.shiftright("l_orderkey", k) % 2 == 1, 2.0 ** -(2**k)).otherwise(1.0)
    figures = lines.select(
        F.col("l_extendedprice").cast("double").alias("price"),
        (F.col("l_extendedprice") / (F.col("l_orderkey") + 1)).cast("double").alias("ratio"),
        (F.col("l_quantity").cast("double") * scale).alias("scales"),
    )
    names = ("price", "ratio", "scales")
    medians = statistics.exact_medians(figures, names, buckets=50, last_rows=100)
    return spark.createDataFrame([medians], ", ".join(f"{name} double" for name in names))


@query
def token_numbers(spark, sf_dir):
    """Titles numbered in order, a thousand to a task."""
    titles = inputs.table(spark, sf_dir, "orders").selectExpr("concat('Film ', o_orderkey) AS title")
    return encode.dense_numbers(titles, "title", at_once=1000)


@query
def max_year(spark, sf_dir):
    spec = rm.fit_features(prepared(spark, sf_dir))
    return spark.createDataFrame([(spec.max_year,)], "max_year bigint")


@query
def feature_medians(spark, sf_dir):
    figures = stored_prepared(spark, sf_dir).select(*rm.NUMERIC_FEATURES)
    medians = statistics.exact_medians(figures, rm.NUMERIC_FEATURES)
    return spark.createDataFrame([medians], "startYear double, runtimeMinutes double, numVotes double")


@query
def era_bucket(spark, sf_dir):
    rows = prepared(spark, sf_dir)
    latest_year = rm.fit_features(rows).max_year
    return rm.with_era(rows, latest_year).select("tconst", "startYear", "era")


@query
def era_onehot(spark, sf_dir):
    rows = prepared(spark, sf_dir)
    latest_year = rm.fit_features(rows).max_year
    return rows.select("tconst", *eras.era_flags(F.col("startYear"), latest_year))


@query
def genre_onehot(spark, sf_dir):
    rows = stored_prepared(spark, sf_dir)
    return rows.select("tconst", *encode.genre_flags(encode.genre_vocabulary(rows)))


@query
def ml_features(spark, sf_dir):
    rows = stored_prepared(spark, sf_dir)
    return rm.feature_matrix(rows, rm.fit_features(rows), encode.genre_vocabulary(rows), "tconst")


@query
def regression_metrics(spark, sf_dir):
    rows = prepared(spark, sf_dir).where(rm.in_test()).withColumn("predictedRating", stand_in())
    metrics = statistics.regression_metrics(rows, "averageRating", "predictedRating")
    return rounded(metrics, "rmse", "mae", "r2")


@query
def genre_rating_trends(spark, sf_dir):
    rows = prepared(spark, sf_dir).where(rm.in_apply()).withColumn("predictedRating", stand_in())
    return steady_means(
        rm.genre_rating_trends(rows), "movieCount", "averageRating", "predictedRating"
    )


def in_range(predictions: DataFrame) -> DataFrame:
    """Predictions as a test whether they lie between the possible ratings."""
    inside = F.col("predictedRating").between(1.0 - 1e-9, 10.0 + 1e-9)
    return predictions.withColumn("in_range", inside).drop("predictedRating")


def film_number() -> Column:
    """Read off the title's id."""
    return F.substring("tconst", 3, 20).cast("bigint")


def near(predictions: DataFrame, number: Column | None = None, apart: Column | None = None) -> DataFrame:
    """Predictions as a test against the rating planted by the running time.

    NULL for titles whose running time is unknown, which nothing else determines. ``number``
    is the title's number, by default read off its id; ``apart`` is the test of titles that
    are not tested one by one, NULL for the others.
    """
    key = film_number() if number is None else number
    close = F.abs(F.col("predictedRating") - planted(key)) <= 2.0
    tested = close if apart is None else F.coalesce(apart, close)
    return predictions.withColumn("near", F.when(known(key), tested)).drop("predictedRating")


def known(key: Column) -> Column:
    return (key % 7 != 2) & (key % 101 != 6)


def planted(key: Column) -> Column:
    return (F.floor(key % 120 * 7 / 10) + 13) / 10


def about_median(run: rm.ModelRun, key: Column) -> Column:
    """Within two minutes of the median running time, which also stands for unknown ones."""
    return F.abs(key % 120 + 60 - F.lit(run.spec.medians["runtimeMinutes"])) <= 2


def near_together(run: rm.ModelRun, number: Column | None = None) -> Column:
    """For titles about the median running time, whose leaves hold the unknown ones as well: whether their
    mean prediction is near the mean planted rating. NULL for the others."""
    key = film_number()
    them = run.predictions.where(known(key) & about_median(run, key))
    off = them.agg(F.abs(F.avg("predictedRating") - F.avg(planted(key))).alias("off")).first()["off"]
    return F.when(about_median(run, key if number is None else number), F.lit(off).cast("double") <= 2.0)


@once_per_session
def fully_grown(spark: SparkSession, sf_dir: str) -> rm.ModelRun:
    fct = stored_fact(spark, sf_dir).read("fct_movies")
    return rm.train_and_evaluate(fct, landing.workspace(spark), ForestParams(depth=None))


def away_from_median(run: rm.ModelRun) -> DataFrame:
    """``near`` for titles away from the median running time, which also stands for unknown ones."""
    tested = near(run.predictions).select("tconst", "startYear", "averageRating", "near")
    return tested.withColumn("near", F.when(~about_median(run, film_number()), F.col("near")))


@query
def rf_fully_grown(spark, sf_dir):
    """Predictions of trees grown until they fit: all near what was planted."""
    return away_from_median(fully_grown(spark, sf_dir))


@query
def rf_large_nodes(spark, sf_dir):
    """The same of trees whose nodes above 500 rows are split by all tasks together, as far as that
    takes fewer sums than rows."""
    fct = stored_fact(spark, sf_dir).read("fct_movies")
    params = ForestParams(trees=40, leaf_rows=500)
    return away_from_median(rm.train_and_evaluate(fct, landing.workspace(spark), params))


@query
def rf_predictions(spark, sf_dir):
    run = trained(spark, sf_dir)
    return near(run.predictions, apart=near_together(run))


@query
def rf_metrics(spark, sf_dir):
    """Set sizes, and whether the forest explains what was planted in the test labels."""
    metrics = trained(spark, sf_dir).metrics
    row = (
        metrics["n_rows"],
        metrics["train_rows"],
        metrics["r2"] > 0.75,       # RMSE below half the labels' standard deviation
        metrics["mae"] <= metrics["rmse"],
    )
    names = "n_rows bigint, train_rows bigint, beats_half_deviation boolean, mae_below_rmse boolean"
    return spark.createDataFrame([row], names)


@query
def prediction_sample(spark, sf_dir):
    """The sample that the job shows; ``near`` fails for a constant, ``in_range`` for nonsense."""
    run = trained(spark, sf_dir)
    sample = rm.prediction_sample(run.predictions)
    number = F.substring("primaryTitle", 6, 20).cast("bigint")
    tested = near(sample.withColumn("shown", F.col("predictedRating")), number, near_together(run, number))
    return in_range(tested.withColumnRenamed("shown", "predictedRating"))


@once_per_session
def published_model(spark: SparkSession, sf_dir: str) -> TableStore:
    store = stored_fact(spark, sf_dir)
    jobs.train_and_publish(store, BOUNDED)
    return store


@query
def publish_predictions(spark, sf_dir):
    return near(published_model(spark, sf_dir).read("imdb_rating_predictions"))


@query
def publish_trends(spark, sf_dir):
    """Trends, and whether the mean prediction of a larger group is near its mean rating."""
    trends = published_model(spark, sf_dir).read("imdb_genre_rating_trends")
    close = F.abs(F.col("predictedRating") - F.col("averageRating")) <= 1.0
    tested = trends.withColumn("near", F.when(F.col("movieCount") >= 30, close))
    return steady_means(tested.drop("predictedRating"), "movieCount", "averageRating")


@query
def publish_gate(spark, sf_dir):
    """Without titles to evaluate on, the predictions published before stay."""
    store = stored_fact(spark, sf_dir)
    earlier = prepared(spark, sf_dir).where(rm.in_apply()).withColumn("predictedRating", stand_in())
    store.full_refresh("imdb_rating_predictions", earlier)
    store.full_refresh("fct_movies", store.read("fct_movies").where("start_year < 2021"))
    jobs.train_and_publish(store)
    return store.read("imdb_rating_predictions")


@query
def missing_feature_column(spark, sf_dir):
    """A numeric feature that the table lacks is NULL in every row."""
    rows = rm.add_missing(rm.training_rows(fact(spark, sf_dir)).drop("numVotes"))
    return rows.select("tconst", "runtimeMinutes", "numVotes")


# The whole day


def ran_day(spark: SparkSession, sf_dir: str) -> TableStore:
    store = new_store(spark)
    jobs.daily_run(store, landing.land_day(spark, sf_dir), RUN_DATE)
    return store


@query
def daily_run(spark, sf_dir):
    """From raw files to the yearly genre mart, upserts and model included."""
    yearly = ran_day(spark, sf_dir).read("genre_yearly_metrics")
    return steady_means(yearly, "num_movies", "avg_rating")
