"""Physical plans stay what they were designed to be."""

import os

from conftest import plan_text
from reelmill.plans import marts
from reelmill.session import input_bytes, sized_shuffles, written_once


def tables(spark, tmp_path):
    basics = spark.range(1000).selectExpr(
        "concat('tt', id) AS tconst", "'t' AS primaryTitle", "'t' AS originalTitle",
        "id % 30 + 1995 AS startYear", "id AS runtimeMinutes", "'Drama, War' AS genres",
    )
    ratings = spark.range(1000).selectExpr(
        "concat('tt', id) AS tconst", "double(id % 10) AS averageRating", "id AS numVotes"
    )
    basics.write.parquet(str(tmp_path / "b"))
    ratings.write.parquet(str(tmp_path / "r"))
    return spark.read.parquet(str(tmp_path / "b")), spark.read.parquet(str(tmp_path / "r"))


def test_genre_partials_read_few_columns_and_joins_inner(spark, tmp_path):
    basics, ratings = tables(spark, tmp_path)
    fct = marts.fct_movies(marts.stg_basics(basics), marts.stg_ratings(ratings))
    text = plan_text(marts.genre_partials(marts.genre_exploded(fct)))
    assert "ReadSchema: struct<tconst:string,startYear:bigint,genres:string>" in text
    assert "PushedFilters: [IsNotNull(averageRating), IsNotNull(tconst)]" in text
    assert "LeftOuter" not in text and "Inner" in text
    assert "partial_count" in text and "Python" not in text


def test_input_size_is_summed(spark, tmp_path):
    basics, ratings = tables(spark, tmp_path)
    joined = basics.join(ratings, "tconst")
    assert input_bytes(joined) == input_bytes(basics) + input_bytes(ratings)


def test_shuffles_start_wide_for_large_inputs_only(spark, tmp_path, monkeypatch):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    basics, _ = tables(spark, tmp_path)
    with sized_shuffles(basics):
        assert spark.conf.get(key, None) is None
    monkeypatch.setattr("reelmill.session.PARTITION_BYTES", 100)
    with sized_shuffles(basics):
        assert int(spark.conf.get(key)) > 4
    assert spark.conf.get(key, None) is None


def test_written_once_reads_back(spark, tmp_path):
    location = str(tmp_path / "once")
    assert written_once(spark.range(5), location).count() == 5
    assert os.path.isdir(location)
