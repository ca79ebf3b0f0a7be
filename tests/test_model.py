import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from reelmill.__main__ import main
from reelmill.operators import encode
from reelmill.plans import jobs, ratings_model as rm
from reelmill.sources.store import TableStore

SMALL = rm.ForestParams(trees=20, depth=5, bins=32)


def fact(spark, n=2000):
    """Ratings that follow the genre, with unrated films and gaps."""
    return spark.range(n).selectExpr(
        "concat('tt', lpad(id, 7, '0')) AS tconst",
        "concat('F', id) AS primaryTitle",
        "concat('F', id) AS originalTitle",
        "if(id % 40 = 39, NULL, 1998 + id % 28) AS start_year",
        "if(id % 9 = 1, NULL, 80 + id % 60) AS runtime_minutes",
        "CASE id % 4 WHEN 0 THEN 'Drama' WHEN 1 THEN 'War, Drama' WHEN 2 THEN 'Comedy' END AS genres",
        "if(id % 11 = 3, NULL, double(2 + 2 * (id % 4)) + (id % 5) / 10) AS average_rating",
        "if(id % 11 = 3, NULL, id % 300) AS num_votes",
    )


def test_prepare(spark):
    prepared = rm.prepare(rm.training_rows(fact(spark)))
    assert prepared.where("startYear IS NULL").count() == 0
    assert prepared.where("genres IS NULL").count() == 0
    assert prepared.where("genres = 'Unknown'").count() > 0


def test_text_figures_are_typed(spark):
    rows_ = rm.training_rows(fact(spark)).withColumns(
        {"runtimeMinutes": F.lit("n/a"), "numVotes": F.lit("12")}
    )
    first = rm.prepare(rows_).first()
    assert (first["runtimeMinutes"], first["numVotes"]) == (None, 12.0)


def test_missing_column_becomes_null(spark):
    df = spark.createDataFrame([(2001,)], "startYear bigint")
    added = rm.add_missing(df)
    assert tuple(added.first()) == (2001, None, None)
    assert rm.add_missing(added).columns == added.columns


def test_feature_matrix(spark):
    prepared = rm.prepare(rm.training_rows(fact(spark)))
    spec = rm.fit_features(prepared)
    genres = encode.genre_vocabulary(prepared)
    assert genres == [" Drama", "Comedy", "Drama", "Unknown", "War"]
    assert spec.max_year == 2025
    assert spec.medians["runtimeMinutes"] == prepared.selectExpr("median(runtimeMinutes)").first()[0]
    matrix = rm.feature_matrix(prepared, spec, genres, "tconst")
    assert len(matrix.columns) == 1 + 3 + 5 + 9
    assert matrix.where("runtimeMinutes IS NULL OR numVotes IS NULL").count() == 0
    flags = [c for c in matrix.columns if c.startswith("era_")]
    total = sum((F.col(f"`{c}`") for c in flags), F.lit(0))
    assert rows(matrix.select(total.alias("eras")).distinct()) == [(1,)]


def test_stored_vectors_equal_the_wide_matrix(spark, tmp_path):
    prepared = rm.prepare(rm.training_rows(fact(spark)))
    spec, genres = rm.fit_features(prepared), encode.genre_vocabulary(prepared)
    vectors = rm.assemble(prepared, spec, str(tmp_path / "m"))
    wide = rm.feature_matrix(prepared, spec, genres, "tconst")
    numeric, eras = wide.columns[1:4], [c for c in wide.columns if c.startswith("era_")]
    expected = {r["tconst"]: [float(r[c]) for c in (*numeric, *eras, *genres)] for r in wide.collect()}
    found = {r["tconst"]: list(r["features"].toArray()) for r in vectors.collect()}
    assert found == expected
    assert "Python" not in plan_text(vectors)


def test_very_many_genres_train(spark, tmp_path):
    many = fact(spark, 2600).withColumn(
        "genres", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.concat(
            F.lit("g"), ((F.substring("tconst", 3, 7).cast("int") * 4 + k) % 5000).cast("string"))), ",")
    )
    params = rm.ForestParams(trees=2, depth=3, bins=8)
    run = rm.train_and_evaluate(many, str(tmp_path / "m"), params)
    assert run.predictions.count() > 0 and run.model.numFeatures >= 5000


def test_forest_does_not_depend_on_files_or_cores(spark, tmp_path):
    """The same rows in other files and partitions give the same predictions."""
    many, one = str(tmp_path / "many"), str(tmp_path / "one")
    fact(spark).repartition(13).write.parquet(many)
    fact(spark).orderBy(F.desc("primaryTitle")).coalesce(1).write.parquet(one)
    found = []
    for k, path in enumerate((many, one)):
        run = rm.train_and_evaluate(spark.read.parquet(path), str(tmp_path / f"m{k}"), SMALL)
        found.append(rows(run.predictions))
    assert found[0] == found[1]


def test_split_spans(spark):
    years = [1999, 2000, 2020, 2021, 2024, 2025]
    df = spark.createDataFrame([(y, 5.0) for y in years], "startYear bigint, averageRating double")
    df = df.unionByName(df.withColumn("averageRating", F.lit(None).cast("double")))

    def kept(condition):
        return sorted(r["startYear"] for r in df.where(condition).collect())

    assert kept(rm.in_train()) == [2000, 2020]
    assert kept(rm.in_test()) == [2021, 2024]
    assert kept(rm.in_apply()) == [2020, 2021, 2024, 2025]
    assert len(kept(rm.in_apply(rated_only=False))) == 8


def test_forest_learns_and_repeats(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    store.full_refresh("fct_movies", fact(spark))
    run = jobs.train_and_publish(store, SMALL)
    assert run.metrics["r2"] > 0.5
    published = store.read("imdb_rating_predictions")
    assert published.columns == [
        "tconst", "primaryTitle", "startYear", "genres", "numVotes", "averageRating",
        "predictedRating",
    ]
    span = published.selectExpr("min(predictedRating)", "max(predictedRating)").first()
    assert 2.0 <= span[0] and span[1] <= 8.4
    assert rows(run.predictions.select("hasActualRating").distinct()) == [(True,)]
    assert not list((tmp_path / "store" / "_scratch").iterdir())
    again = rm.train_and_evaluate(store.read("fct_movies"), str(tmp_path / "again"), SMALL)
    assert rows(again.predictions.drop("hasActualRating")) == rows(published)

    trends = store.read("imdb_genre_rating_trends")
    assert trends.agg(F.sum("movieCount")).first()[0] == published.select(
        F.explode(F.split("genres", ","))
    ).count()
    assert {" Drama", "War"} <= {r["genre"] for r in trends.collect()}
    assert rm.prediction_sample(run.predictions).count() == 20


def test_unrated_films_on_request(spark, tmp_path):
    run = rm.train_and_evaluate(fact(spark, 600), str(tmp_path / "m"), SMALL, rated_only=False)
    assert len(run.predictions.select("hasActualRating").distinct().collect()) == 2


def test_nothing_to_evaluate_publishes_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    store.full_refresh("fct_movies", fact(spark).where("start_year < 2021"))
    before = store.current()
    assert jobs.train_and_publish(store, SMALL) is None
    assert store.current() == before


def test_missing_year_fallback(spark):
    prepared = rm.prepare(rm.training_rows(fact(spark).where("start_year IS NULL")))
    assert rm.fit_features(prepared).max_year == 2035


@pytest.mark.parametrize("trees", [3])
def test_tree_count(spark, trees, tmp_path):
    params = rm.ForestParams(trees=trees, depth=3)
    run = rm.train_and_evaluate(fact(spark, 400), str(tmp_path / "m"), params)
    assert run.model.getNumTrees == trees


def test_model_job_shows_errors_and_sample(spark, tmp_path, capsys):
    root = str(tmp_path / "store")
    TableStore(spark, root).full_refresh("fct_movies", fact(spark, 400))
    main(["model", "--root", root, "--trees", "5", "--leaf-rows", "100"])
    shown = capsys.readouterr().out
    assert "'rmse'" in shown and "predictedRating" in shown
    assert shown.count("|true           |") == 20
