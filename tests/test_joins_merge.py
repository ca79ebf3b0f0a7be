import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from reelmill.operators import joins, keys, lookups
from reelmill.operators.merge import merge_upsert

DAY = datetime.date(2024, 6, 1)


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def skewed(spark, name):
    """A third of the rows on one key, some without a key, the rest spread."""
    return spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("key"),
        F.col("id").alias(name),
    )


def test_hot_keys_are_found(spark):
    assert joins.hot_keys(skewed(spark, "v"), "key", hot_rows=50) == ["hot"]
    assert joins.hot_keys(skewed(spark, "v"), "key", hot_rows=500) == []
    assert joins.hot_keys(skewed(spark, "v").where("false"), "key", hot_rows=1) == []


@pytest.mark.parametrize("hot_rows", [2, 50, 500])
def test_left_join_with_hot_right_key(spark, no_broadcast, hot_rows):
    alone = spark.range(1).selectExpr("'alone' AS key", "id AS l")
    left = skewed(spark, "l").where("l < 90 OR key IS NULL")
    left = left.join(alone, ["key", "l"], "full_outer")
    right = skewed(spark, "r").where("r % 2 = 0")
    routed = joins.left_join(left, right, "key", check_bytes=0, hot_rows=hot_rows)
    assert ("Union" in plan_text(routed)) == (hot_rows <= 50)
    assert rows(routed) == rows(left.join(right, "key", "left"))


@pytest.mark.parametrize("hot_rows", [50, 500])
def test_left_join_with_hot_left_key(spark, no_broadcast, hot_rows):
    left = skewed(spark, "l")
    right = skewed(spark, "r").groupBy("key").agg(F.max("r").alias("r"))
    routed = joins.left_join(
        left, right, "key", right_unique=True, check_bytes=0, hot_rows=hot_rows
    )
    assert routed.count() == 300
    assert "Union" in plan_text(routed)
    assert rows(routed) == rows(left.join(right, "key", "left"))


def test_small_inputs_keep_the_plain_join(spark):
    left, right = skewed(spark, "l"), skewed(spark, "r")
    assert "Union" not in plan_text(joins.left_join(left, right, "key"))


def test_external_ids_one_row_per_film(spark):
    films = spark.createDataFrame([(1,), (2,), (2,), (3,), (4,)], "tmdb_id bigint")
    crosswalk = spark.createDataFrame(
        [(1, "tt1"), (1, "tt1"), (2, None), (3, "tt5"), (3, "tt3")],
        "tmdb_id bigint, imdb_id string",
    )
    assert rows(lookups.external_ids(films, crosswalk)) == rows(
        spark.createDataFrame(
            [(1, "tt1"), (2, None), (2, None), (3, "tt3"), (4, None)],
            "tmdb_id bigint, imdb_id string",
        )
    )


TARGET = "tconst string, title string, minutes bigint"


def target(spark):
    return spark.createDataFrame(
        [("tt1", "One", 90), ("tt2", "Two", 80), ("tt2", "Two again", 81), ("tt3", "Three", None)],
        TARGET,
    )


def merge(spark, source, **options):
    df = spark.createDataFrame(source, TARGET + ", day date")
    return merge_upsert(target(spark), df, "tconst", ["title"], newest_by="day", **options)


def test_merge_updates_inserts_and_keeps(spark, tmp_path):
    source = [("tt2", None, 5, DAY), ("tt9", "Nine", None, DAY)]
    expected = [
        ("tt1", "One", 90), ("tt2", None, 80), ("tt2", None, 81), ("tt3", "Three", None),
        ("tt9", "Nine", None),
    ]
    routes = ({}, {"scratch": str(tmp_path / "a")},
              {"scratch": str(tmp_path / "b"), "check_bytes": 0, "hot_rows": 2})
    for options in routes:
        assert rows(merge(spark, source, **options)) == rows(
            spark.createDataFrame(expected, TARGET)
        )


def test_merge_with_hot_target_key(spark, no_broadcast, tmp_path):
    source = [("tt2", None, 5, DAY), ("tt9", "Nine", None, DAY)]
    plain = rows(merge(spark, source))
    routed = merge(spark, source, check_bytes=0, hot_rows=2, scratch=str(tmp_path / "s"))
    assert rows(routed) == plain and len(plain) == 5


def test_external_ids_of_a_large_snapshot(spark, no_broadcast):
    test_external_ids_one_row_per_film(spark)


def test_merge_of_nothing(spark):
    assert rows(merge(spark, [])) == rows(target(spark))


def test_merge_refuses_repeated_and_missing_keys(spark):
    with pytest.raises(Exception, match="repeated tconst"):
        merge(spark, [("tt1", "a", 1, DAY), ("tt1", "b", 1, DAY)]).collect()
    with pytest.raises(Exception, match="NULL or repeated"):
        merge(spark, [(None, "a", 1, DAY)]).collect()
    with pytest.raises(ValueError):
        merge(spark, [], on_duplicate="first")


def test_merge_latest_duplicate(spark):
    older = DAY - datetime.timedelta(days=1)
    merged = merge(
        spark, [("tt1", "old", 1, older), ("tt1", "new", 1, DAY)], on_duplicate="latest"
    )
    assert ("tt1", "new", 90) in rows(merged)
    assert merged.count() == 4


def test_large_target_is_not_shuffled_whole(spark, tmp_path):
    spark.range(200000).selectExpr(
        "concat('tt', id) AS tconst", "repeat('x', 50) AS title", "id AS minutes"
    ).write.parquet(str(tmp_path / "t"))
    big = spark.read.parquet(str(tmp_path / "t"))
    source = spark.range(3).selectExpr("concat('tt', id) AS tconst", "'x' AS title", "id AS minutes")
    text = plan_text(merge_upsert(big, source, "tconst", ["title"], scratch=str(tmp_path / "s")))
    assert "LeftOuter, BuildRight" in text and "LeftSemi, BuildRight" in text


def test_merge_computes_its_source_once(spark, no_broadcast, tmp_path):
    """Either route: one window over the source, one full-width shuffle of the target."""
    day = F.lit(DAY)
    spark.range(1000).selectExpr("concat('tt', id) AS tconst", "'old' AS title", "id AS minutes").write.parquet(
        str(tmp_path / "t")
    )
    big = spark.read.parquet(str(tmp_path / "t"))
    source = spark.range(900, 1100).selectExpr("concat('tt', id) AS tconst", "'new' AS title", "id AS minutes")
    options = {"on_duplicate": "latest", "newest_by": "day"}
    full = merge_upsert(big, source.withColumn("day", day), "tconst", ["title"], **options)
    text = plan_text(full)
    assert text.count("Window [") == 1 and text.count("SortMergeJoin") == 1
    assert text.count("FileScan") == 1 and "FullOuter" in text
    stored = merge_upsert(
        big, source.withColumn("day", day), "tconst", ["title"], scratch=str(tmp_path / "s"), **options
    )
    text = plan_text(stored)
    assert "Window [" not in text
    assert text.count("minutes#") and rows(stored) == rows(full)
    whole = [line for line in text.splitlines() if "ReadSchema" in line and "title:string,minutes" in line]
    assert sum("/t]" in line for line in whole) <= 1


def snapshot_rows(spark):
    return spark.createDataFrame(
        [(1, "a", DAY), (1, "b", DAY), (1, "z", datetime.date(2024, 5, 1)), (2, "c", DAY),
         (2, "d", None), (None, "e", DAY)],
        "tmdb_id bigint, title string, snapshot_date date",
    )


def test_latest_per_key_ties_and_undated(spark):
    expected = rows(
        spark.createDataFrame(
            [(1, "a", DAY), (2, "d", None), (None, "e", DAY)], snapshot_rows(spark).schema
        )
    )
    for parts in (1, 3, 7):
        shuffled = snapshot_rows(spark).repartition(parts, "title")
        assert rows(keys.latest_per_key(shuffled, ["tmdb_id"], "snapshot_date")) == expected


def test_latest_per_key_prunes_before_the_shuffle(spark):
    text = plan_text(keys.latest_per_key(snapshot_rows(spark), ["tmdb_id"], "snapshot_date"))
    assert text.count("WindowGroupLimit") == 2


def test_not_null_key(spark):
    good = spark.createDataFrame([("a", 1)], "k string, v int")
    assert keys.require_not_null(good, ["k"]).count() == 1
    bad = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    with pytest.raises(Exception, match="NULL in required column k"):
        keys.require_not_null(bad, ["k"]).select("v").collect()
