import gzip
import json
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from reelmill.__main__ import main
from reelmill.plans import clean, jobs, marts
from reelmill.sources import files, schemas
from reelmill.sources.store import ConflictError, TableStore
from reelmill.streaming.now_playing import follow_pages

HEADER = "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres\n"
TITLES = [
    'tt1\tmovie\t"Quoted start\tOne\t0\t2000\t\\N\t90\tDrama,War\n',
    "tt2\tmovie\tNone\t\\N\t0\t2001\t\\N\tbad\t\\N\n",
    "tt3\tmovie\tOld\tOld\t0\t1999\t\\N\t90\tDrama\n",
    "tt4\tshort\tShort\tShort\t0\t2005\t\\N\t9\tDrama\n",
    "tt5\tmovie\tAdult\tAdult\t1\t2005\t\\N\t90\tDrama\n",
    "tt6\tmovie\tNo year\tNo year\t0\t\\N\t\\N\t90\tDrama\n",
    "tt7\tmovie\tMaybe adult\tMaybe\t\\N\t2010\t\\N\t90\tDrama\n",
]


def write_titles(path, lines=TITLES):
    path.mkdir()
    with gzip.open(path / "title.basics.tsv.gz", "wt", encoding="utf-8") as out:
        out.writelines([HEADER, *lines])
    return str(path)


def test_titles_from_gzip(spark, tmp_path):
    raw = files.scan_tsv(spark, write_titles(tmp_path / "b"), schemas.TITLE_BASICS_FILE)
    assert raw.count() == 7
    assert rows(clean.basics_clean(raw)) == [
        ("tt1", '"Quoted start', "One", 2000, 90, "Drama,War"),
        ("tt2", "None", None, 2001, None, None),
    ]
    spread = files.scan_tsv(spark, str(tmp_path / "b"), schemas.TITLE_BASICS_FILE, partitions=3)
    assert rows(spread) == rows(raw)


def test_quotes_and_pandas_tokens_on_request(spark, tmp_path):
    line = 'tt8\tmovie\t"In ""quotes"""\tNone\t0\t2000\t\\N\t90\tDrama\n'
    path = write_titles(tmp_path / "b", [line])
    raw = files.scan_tsv(spark, path, schemas.TITLE_BASICS_FILE, quote='"')
    tokens = clean.NULL_TOKENS + ("None",)
    assert rows(clean.basics_clean(raw, tokens)) == [("tt8", 'In "quotes"', None, 2000, 90, "Drama")]


def test_header_must_match(spark, tmp_path):
    folder = tmp_path / "b"
    folder.mkdir()
    (folder / "x.tsv").write_text("tconst\tnumVotes\taverageRating\ntt1\t5\t7.0\n")
    with pytest.raises(Exception, match="header"):
        files.scan_tsv(spark, str(folder), schemas.TITLE_RATINGS_FILE).collect()


def test_bad_adult_flag_fails_whatever_the_title_type(spark, tmp_path):
    line = "tt9\tshort\tS\tS\tx\t2005\t\\N\t9\tDrama\n"
    raw = files.scan_tsv(spark, write_titles(tmp_path / "b", [line]), schemas.TITLE_BASICS_FILE)
    with pytest.raises(Exception, match="invalid integer"):
        clean.basics_clean(raw).collect()


FILMS = [
    {"id": 1, "title": "A", "original_title": "A", "original_language": "en",
     "release_date": "2024-05-01", "popularity": 3.5, "vote_average": 7, "vote_count": 10,
     "genre_ids": [28, 99], "adult": False},
    {"id": 2, "title": "B", "release_date": "", "popularity": "n/a", "vote_average": 0.0,
     "vote_count": None, "genre_ids": "none", "adult": False},
    {"id": 3, "title": "C", "release_date": "2023-01-02", "genre_ids": []},
]


def land(tmp_path, spark, pages):
    (tmp_path / "pages").mkdir()
    for number, films in enumerate(pages):
        page = {"page": number, "total_pages": len(pages), "results": films}
        (tmp_path / "pages" / f"{number}.json").write_text(json.dumps(page, indent=1))
    (tmp_path / "genres").mkdir()
    genres = {"genres": [{"id": 28, "name": "Action"}, {"id": 7, "name": ""}]}
    (tmp_path / "genres" / "g.json").write_text(json.dumps(genres, indent=1))
    spark.createDataFrame(
        [(1, "tt1"), (2, "nm2"), (3, "tt9")], "tmdb_id bigint, imdb_id string"
    ).write.parquet(str(tmp_path / "ids"))
    return jobs.Landed("", "", str(tmp_path / "pages"), str(tmp_path / "genres"),
                       str(tmp_path / "ids"), multi_line=True)


CLEAN_FILMS = [
    (1, "tt1", "A", "A", "en", date(2024, 5, 1), 3.5, 7.0, 10, "28,99", "Action", False,
     date(2024, 6, 2)),
    (2, "nm2", "B", None, None, None, None, 0.0, None, None, None, False, date(2024, 6, 2)),
    (3, "tt9", "C", None, None, date(2023, 1, 2), None, None, None, "", None, None,
     date(2024, 6, 2)),
]


def test_pages_to_now_playing(spark, tmp_path):
    landed = land(tmp_path, spark, [FILMS[:2], [], FILMS[2:]])
    store = TableStore(spark, str(tmp_path / "store"))
    assert jobs.refresh_now_playing(store, landed, date(2024, 6, 2))
    assert rows(store.read("tmdb_now_playing")) == sorted(CLEAN_FILMS, key=repr)


def test_same_film_on_two_pages_is_kept_twice(spark, tmp_path):
    landed = land(tmp_path, spark, [FILMS[:1], FILMS[:1]])
    assert files.scan_pages(spark, landed.pages, multi_line=True).count() == 2


def test_broken_page_fails(spark, tmp_path):
    landed = land(tmp_path, spark, [FILMS])
    (tmp_path / "pages" / "x.json").write_text('{"page": 1, "results": [')
    with pytest.raises(Exception):
        files.scan_pages(spark, landed.pages, multi_line=True).collect()


def test_empty_snapshot_changes_nothing(spark, tmp_path):
    landed = land(tmp_path, spark, [[]])
    store = TableStore(spark, str(tmp_path / "store"))
    before = spark.createDataFrame(CLEAN_FILMS, schemas.NOW_PLAYING)
    store.full_refresh("tmdb_now_playing", before)
    assert not jobs.refresh_now_playing(store, landed, date(2024, 6, 3))
    assert rows(store.read("tmdb_now_playing")) == rows(before)


def ratings(spark, *data):
    return spark.createDataFrame(list(data), "tconst string, averageRating double, numVotes bigint")


def test_refresh_replaces_and_failure_keeps_the_old_version(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    assert store.read("imdb_title_ratings").count() == 0
    store.full_refresh("imdb_title_ratings", ratings(spark, ("a", 1.0, 1)))
    store.full_refresh("imdb_title_ratings", ratings(spark, ("b", 2.0, 2)))
    assert rows(store.read("imdb_title_ratings")) == [("b", 2.0, 2)]
    with pytest.raises(Exception, match="NULL in required column"):
        store.full_refresh("imdb_title_ratings", ratings(spark, ("c", 1.0, 1), (None, 2.0, 2)))
    assert rows(store.read("imdb_title_ratings")) == [("b", 2.0, 2)]


def test_refresh_may_read_its_own_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    store.full_refresh("imdb_title_ratings", ratings(spark, ("a", 1.0, 1)))
    more = store.read("imdb_title_ratings").withColumn("numVotes", F.col("numVotes") + 1)
    store.full_refresh("imdb_title_ratings", more)
    assert rows(store.read("imdb_title_ratings")) == [("a", 1.0, 2)]


def test_concurrent_publish_is_refused(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "store"))
    store.full_refresh("imdb_title_ratings", ratings(spark, ("a", 1.0, 1)))
    seen = store._latest()
    store.full_refresh("imdb_title_ratings", ratings(spark, ("b", 1.0, 1)))
    staged = store.stage("imdb_title_ratings", ratings(spark, ("c", 1.0, 1)))
    monkeypatch.setattr(store, "_latest", lambda: seen)
    with pytest.raises(Exception, match="[Ee]xist"):
        store.publish({"imdb_title_ratings": staged})
    monkeypatch.undo()
    assert rows(store.read("imdb_title_ratings")) == [("b", 1.0, 1)]


def test_vacuum_keeps_current_versions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    for key in "abc":
        store.full_refresh("imdb_title_ratings", ratings(spark, (key, 1.0, 1)))
    store.vacuum()
    assert len(list((tmp_path / "store" / "imdb_title_ratings").iterdir())) == 1
    assert rows(store.read("imdb_title_ratings")) == [("c", 1.0, 1)]


def test_vacuum_leaves_young_folders(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    for key in "ab":
        store.full_refresh("imdb_title_ratings", ratings(spark, (key, 1.0, 1)))
    store.vacuum(older_than_hours=1)
    assert len(list((tmp_path / "store" / "imdb_title_ratings").iterdir())) == 2


def test_missing_pages_fail_and_keep_the_old_snapshot(spark, tmp_path):
    landed = land(tmp_path, spark, [FILMS[:1], FILMS[1:2], FILMS[2:]])
    store = TableStore(spark, str(tmp_path / "store"))
    assert jobs.refresh_now_playing(store, landed, date(2024, 6, 2))
    again = json.loads((tmp_path / "pages" / "0.json").read_text())
    (tmp_path / "pages" / "again.json").write_text(json.dumps(again))
    assert jobs.refresh_now_playing(store, landed, date(2024, 6, 2))
    before = store.current()
    (tmp_path / "pages" / "2.json").unlink()
    with pytest.raises(ValueError, match="2 of 3 pages"):
        jobs.refresh_now_playing(store, landed, date(2024, 6, 3))
    assert store.current() == before


def test_jobs_pass_on_quote_and_partitions(spark, tmp_path):
    lines = ['tt8\tmovie\t"In ""quotes"""\tNone\t0\t2000\t\\N\t90\tDrama\n']
    lines += [f"tt{k}\tmovie\tT\tT\t0\t2001\t\\N\t90\tDrama\n" for k in range(100, 160)]
    path = write_titles(tmp_path / "b", lines)
    landed = jobs.Landed(path, "", "", "", "", quote='"', partitions=5)
    store = TableStore(spark, str(tmp_path / "store"))
    location = store.stage(jobs.BASICS_TABLE, jobs.basics_of(store, landed))
    assert len([f for f in (tmp_path / location).iterdir() if f.suffix == ".parquet"]) == 5
    assert store.read_staged(jobs.BASICS_TABLE, location).where("primaryTitle = 'In \"quotes\"'").count() == 1


def test_upsert_fails_if_a_refresh_commits_between_read_and_publish(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    store.full_refresh("imdb_title_basics", basics(spark, ("tt1", "Old", "Old", 1990, 95, "X")))
    store.full_refresh("imdb_title_ratings", ratings(spark, ("tt1", 1.0, 1)))
    store.full_refresh("tmdb_now_playing", spark.createDataFrame(CLEAN_FILMS, schemas.NOW_PLAYING))
    base = store.version()
    staged = jobs.stage_upserts(
        store,
        *[store.read(t, base) for t in ("imdb_title_basics", "imdb_title_ratings", "tmdb_now_playing")],
    )
    store.full_refresh("imdb_title_ratings", ratings(spark, ("tt1", 9.0, 9)))
    with pytest.raises(ConflictError, match="imdb_title_ratings"):
        jobs.publish_or_discard(store, staged, base, ["tmdb_now_playing"])
    assert rows(store.read("imdb_title_ratings")) == [("tt1", 9.0, 9)]
    assert rows(store.read("imdb_title_basics")) == [("tt1", "Old", "Old", 1990, 95, "X")]
    assert len(list((tmp_path / "store" / "imdb_title_basics").iterdir())) == 1
    assert not list((tmp_path / "store" / "_scratch").iterdir())
    other = store.version()
    store.full_refresh("tmdb_now_playing", spark.createDataFrame(CLEAN_FILMS, schemas.NOW_PLAYING))
    new = store.stage("imdb_title_ratings", ratings(spark, ("tt2", 2.0, 2)))
    store.publish({"imdb_title_ratings": new}, other)
    assert store.read("tmdb_now_playing").count() == 3


def basics(spark, *data):
    return spark.createDataFrame(list(data), schemas.BASICS)


def test_upsert_publishes_both_tables_or_none(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    store.full_refresh("imdb_title_basics", basics(spark, ("tt1", "Old", "Old", 1990, 95, "X")))
    store.full_refresh("imdb_title_ratings", ratings(spark, ("tt1", 1.0, 1)))
    films = spark.createDataFrame(CLEAN_FILMS, schemas.NOW_PLAYING)
    store.full_refresh("tmdb_now_playing", films)
    jobs.upsert_titles(store)
    assert rows(store.read("imdb_title_basics")) == [
        ("tt1", "A", "A", 2024, 95, "Action"), ("tt9", "C", None, 2023, None, None),
    ]
    assert rows(store.read("imdb_title_ratings")) == [("tt1", 7.0, 10), ("tt9", None, None)]

    twice = films.unionByName(films.where("tmdb_id = 1").withColumn("tmdb_id", F.lit(77)))
    store.full_refresh("tmdb_now_playing", twice)
    before = store.current()
    with pytest.raises(Exception, match="repeated tconst"):
        jobs.upsert_titles(store)
    assert store.current() == before


def test_two_days_leave_only_published_folders(spark, tmp_path):
    pages = land(tmp_path, spark, [FILMS[:2], FILMS[2:]])
    basics_path = write_titles(tmp_path / "b")
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "x.tsv").write_text("tconst\taverageRating\tnumVotes\ntt1\t5.0\t7\n")
    landed = replace(pages, basics=basics_path, ratings=str(tmp_path / "r"))
    store = TableStore(spark, str(tmp_path / "store"))
    for day in (2, 3):
        assert jobs.daily_run(store, landed, date(2024, 6, day)) is None
    published = store.current()
    assert len(published) == 7
    for table in published:
        assert len(list((tmp_path / "store" / table).iterdir())) == 2, table
    assert not list((tmp_path / "store" / "_scratch").iterdir())
    main(["vacuum", "--root", str(tmp_path / "store"), "--older-than-hours", "0"])
    assert {t: len(list((tmp_path / "store" / t).iterdir())) for t in published} == dict.fromkeys(published, 1)
    assert [r["title"] for r in store.read("tmdb_now_playing").orderBy("tmdb_id").collect()] == ["A", "B", "C"]


def test_stream_takes_each_page_once(spark, tmp_path):
    landed = land(tmp_path, spark, [FILMS])
    store = TableStore(spark, str(tmp_path / "store"))
    checkpoint = str(tmp_path / "checkpoint")

    def run(day):
        follow_pages(store, landed, checkpoint, lambda: day).awaitTermination()

    run(date(2024, 6, 2))
    assert rows(store.read("tmdb_now_playing")) == sorted(CLEAN_FILMS, key=repr)
    before = store.current()
    run(date(2024, 6, 3))
    assert store.current() == before
    newer = {"page": 1, "results": [dict(FILMS[0], title="A2")]}
    (tmp_path / "pages" / "later.json").write_text(json.dumps(newer))
    run(date(2024, 6, 4))
    assert [r["title"] for r in store.read("tmdb_now_playing").collect()] == ["A2"]
    assert rows(store.read("imdb_title_basics").select("tconst", "primaryTitle")) == [
        ("tt1", "A2"), ("tt9", "C"),
    ]


def test_half_a_snapshot_publishes_nothing_and_the_rest_publishes_once(spark, tmp_path):
    """Three pages land over three triggers; a page that lands again replaces the held one."""
    landed = land(tmp_path, spark, [[]])
    folder = tmp_path / "pages"
    (folder / "0.json").unlink()
    store = TableStore(spark, str(tmp_path / "store"))

    def run(day, **pages):
        for name, (number, total, films) in pages.items():
            page = {"page": number, "total_pages": total, "results": films}
            (folder / f"{day}{name}.json").write_text(json.dumps(page))
        follow_pages(store, landed, str(tmp_path / "c"), lambda: date(2024, 6, day)).awaitTermination()
        return store.version().number

    def titles():
        return sorted(r["title"] for r in store.read("tmdb_now_playing").collect())

    assert run(2, a=(1, 3, [FILMS[0]])) == 0
    assert run(3, b=(2, 3, [dict(FILMS[1], title="stale")])) == 0
    published = run(4, c=(2, 3, [FILMS[1]]), d=(3, 3, [FILMS[2]]))
    assert published == 2 and titles() == ["A", "B", "C"]
    assert run(5) == published
    assert run(6, e=(2, 2, [FILMS[1]])) == published and titles() == ["A", "B", "C"]
    assert run(7, f=(1, 2, [FILMS[2]])) == published + 2 and titles() == ["B", "C"]
    assert not (tmp_path / "c" / "held_pages").exists()


def test_views_of_one_version_though_another_is_published_between(spark, tmp_path):
    class Busy(TableStore):
        """Every read is followed by another writer's commit."""

        def read(self, table, version=None):
            found = super().read(table, version)
            TableStore(spark, self.root).full_refresh("imdb_title_ratings", ratings(spark, ("tt1", 9.0, 9)))
            return found

    store = TableStore(spark, str(tmp_path / "store"))
    store.full_refresh("imdb_title_basics", basics(spark, ("tt1", "T", "T", 2000, 95, "X")))
    store.full_refresh("imdb_title_ratings", ratings(spark, ("tt1", 1.0, 1)))
    jobs.create_staging_views(Busy(spark, store.root), "busy_")
    assert rows(spark.table("busy_stg_imdb_title_ratings").select("average_rating")) == [(1.0,)]
    pinned = store.pinned()
    store.full_refresh("imdb_title_ratings", ratings(spark, ("tt2", 2.0, 2)))
    assert rows(pinned.read("imdb_title_ratings")) == [("tt1", 9.0, 9)]
    pinned.create_views("pinned_")
    assert rows(spark.table("pinned_imdb_title_ratings")) == [("tt1", 9.0, 9)]
    assert rows(store.read("imdb_title_ratings")) == [("tt2", 2.0, 2)]


def test_what_a_failed_job_staged_is_deleted(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "store"))
    store.full_refresh("imdb_title_basics", basics(spark, ("tt1", "T", "T", 2000, 95, "X")))
    store.full_refresh("imdb_title_ratings", ratings(spark, ("tt1", 1.0, 1)))
    before = store.current()

    def broken(*_):
        raise RuntimeError("broken")

    monkeypatch.setattr(marts, "summary_from_partials", broken)
    with pytest.raises(RuntimeError, match="broken"):
        jobs.build_marts(store)
    assert store.current() == before
    for table in ("fct_movies", "genre_exploded", "genre_yearly_metrics", "_scratch"):
        assert not list((tmp_path / "store" / table).iterdir()), table


def test_files_of_the_fact_table_hold_few_years(spark, tmp_path):
    """The test years lie in few files, and a year of half the rows lies in several."""
    import pyarrow.parquet as pq

    store = TableStore(spark, str(tmp_path / "store"))
    titles = spark.range(4000).selectExpr(
        "concat('tt', id) AS tconst", "'T' AS primaryTitle", "'T' AS originalTitle",
        "if(id % 2 = 0, 2024, 1990 + id % 30) AS startYear", "90L AS runtimeMinutes", "'X' AS genres",
    )
    store.full_refresh("imdb_title_basics", titles)
    store.full_refresh("imdb_title_ratings", titles.selectExpr("tconst", "5.0d AS averageRating", "3L AS numVotes"))
    keys = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in keys}
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        jobs.build_marts(store)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    spans = []
    for file in (tmp_path / store.current()["fct_movies"]).glob("*.parquet"):
        groups = pq.ParquetFile(file).metadata
        column = groups.schema.names.index("start_year")
        stats = [groups.row_group(k).column(column).statistics for k in range(groups.num_row_groups)]
        spans.append((min(s.min for s in stats), max(s.max for s in stats)))
    assert len(spans) >= 12
    assert sum(high >= 2000 and low <= 2003 for low, high in spans) <= 4
    assert sum(low == high == 2024 for low, high in spans) >= 5
