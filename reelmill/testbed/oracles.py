"""The same results as plain SQL, written separately from the Spark plans."""

from __future__ import annotations

# Building blocks: name -> (blocks it reads, SQL).
BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {
    "basics_raw": ((), """
        SELECT 'tt' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS tconst,
               CASE WHEN o_orderkey % 10 = 3 THEN 'short' ELSE 'movie' END AS titleType,
               'Film ' || CAST(o_orderkey AS VARCHAR) AS primaryTitle,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL
                    ELSE 'Film ' || CAST(o_orderkey AS VARCHAR) END AS originalTitle,
               CASE WHEN o_orderkey % 17 = 5 THEN '1' ELSE '0' END AS isAdult,
               CASE WHEN o_orderkey % 19 = 4 THEN NULL
                    ELSE CAST(1995 + o_orderkey % 31 AS VARCHAR) END AS startYear,
               CAST(NULL AS VARCHAR) AS endYear,
               CASE WHEN o_orderkey % 7 = 2 THEN NULL
                    WHEN o_orderkey % 101 = 6 THEN 'n/x'
                    ELSE CAST(60 + o_orderkey % 120 AS VARCHAR) END AS runtimeMinutes,
               CASE WHEN o_orderkey % 11 = 7 THEN NULL
                    WHEN o_orderkey % 3 = 0 THEN c_mktsegment
                    ELSE c_mktsegment || ', ' || substr(o_orderpriority, 3) END AS genres
        FROM orders JOIN customer ON o_custkey = c_custkey"""),
    "ratings_raw": ((), """
        SELECT 'tt' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS tconst,
               CAST(CAST(l_orderkey % 120 * 7 // 10 + CAST(sum(l_quantity) AS BIGINT) % 7 + 10
                         AS DOUBLE) / 10 AS VARCHAR) AS averageRating,
               CAST(count(*) AS VARCHAR) AS numVotes
        FROM lineitem GROUP BY l_orderkey"""),
    "snapshots": ((), """
        SELECT c_custkey AS tmdb_id,
               CASE WHEN c_custkey % 9 = 0 THEN NULL
                    WHEN c_custkey % 9 = 1 THEN 'nm' || CAST(c_custkey AS VARCHAR)
                    WHEN c_custkey % 9 = 2
                        THEN 'tt9' || lpad(CAST(c_custkey AS VARCHAR), 12, '0')
                    ELSE 'tt' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') END AS imdb_id,
               'Now ' || CAST(c_custkey AS VARCHAR) || ' v' || CAST(k2 AS VARCHAR) AS title,
               'Now ' || CAST(c_custkey AS VARCHAR) || ' v' || CAST(k2 AS VARCHAR)
                   AS original_title,
               'en' AS original_language,
               CASE WHEN c_custkey % 8 = 0 THEN NULL
                    ELSE CAST('2024-0' || CAST(1 + c_custkey % 9 AS VARCHAR) || '-15' AS DATE) END
                   AS release_date,
               CAST(c_custkey % 1000 AS DOUBLE) AS popularity,
               CAST(c_custkey % 100 AS DOUBLE) / 10 AS vote_average,
               c_custkey * 3 + k2 AS vote_count,
               CAST(NULL AS VARCHAR) AS genre_ids,
               CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS genre_names,
               false AS adult,
               CAST('2024-06-0' || CAST(1 + k2 AS VARCHAR) AS DATE) AS snapshot_date
        FROM (SELECT *, 0 AS k2 FROM customer
              UNION ALL
              SELECT *, 1 AS k2 FROM customer WHERE c_custkey % 2 = 0)"""),
    "listed": ((), """
        SELECT c_custkey AS id,
               'Now ' || CAST(c_custkey AS VARCHAR) AS title,
               'Now ' || CAST(c_custkey AS VARCHAR) AS original_title,
               'en' AS original_language,
               CASE WHEN c_custkey % 8 = 0 THEN ''
                    ELSE '2024-0' || CAST(1 + c_custkey % 9 AS VARCHAR) || '-15' END
                   AS release_date,
               CASE WHEN c_custkey % 10 = 4 THEN 'n/a'
                    ELSE CAST(c_custkey % 1000 AS VARCHAR) END AS popularity,
               CAST(c_custkey % 100 AS DOUBLE) / 10 AS vote_average,
               CASE WHEN c_custkey % 15 = 7 THEN NULL ELSE c_custkey * 3 END AS vote_count,
               CASE WHEN c_custkey % 6 = 0 THEN NULL
                    WHEN c_custkey % 12 = 1 THEN CAST([] AS BIGINT[])
                    ELSE [CAST(c_nationkey AS BIGINT), CAST(c_nationkey AS BIGINT) + 1] END
                   AS ids,
               c_custkey % 17 = 5 AS adult
        FROM customer"""),
    "ids_text": (("listed",), """
        SELECT id,
               CASE WHEN ids IS NULL THEN NULL
                    WHEN len(ids) = 0 THEN ''
                    ELSE CAST(ids[1] AS VARCHAR) || ',' || CAST(ids[2] AS VARCHAR) END
                   AS genre_ids
        FROM listed"""),
    "names_text": (("listed",), """
        SELECT l.id,
               string_agg(n.n_name, ',' ORDER BY m.pos)
                   FILTER (WHERE n.n_name IS NOT NULL) AS genre_names
        FROM listed l
        LEFT JOIN (SELECT id, 1 AS pos, ids[1] AS gid FROM listed WHERE len(ids) > 0
                   UNION ALL
                   SELECT id, 2 AS pos, ids[2] AS gid FROM listed WHERE len(ids) > 0) m
          ON m.id = l.id
        LEFT JOIN nation n ON n.n_nationkey = m.gid AND n.n_nationkey % 4 <> 0
        GROUP BY l.id"""),
    "crosswalk": ((), """
        SELECT c_custkey AS tmdb_id,
               CASE WHEN c_custkey % 9 = 0 THEN NULL
                    WHEN c_custkey % 9 = 1 THEN 'nm' || CAST(c_custkey AS VARCHAR)
                    WHEN c_custkey % 9 = 2
                        THEN 'tt9' || lpad(CAST(c_custkey AS VARCHAR), 12, '0')
                    ELSE 'tt' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') END AS imdb_id
        FROM customer"""),
    "messy": ((), """
        SELECT o_orderkey AS k,
               CASE o_orderkey % 8
                    WHEN 0 THEN CAST(o_orderkey AS VARCHAR)
                    WHEN 1 THEN ' ' || CAST(o_orderkey AS VARCHAR) || ' '
                    WHEN 2 THEN CAST(o_orderkey AS VARCHAR) || 'e1'
                    WHEN 3 THEN 'x' || CAST(o_orderkey AS VARCHAR)
                    WHEN 4 THEN '0x' || CAST(o_orderkey AS VARCHAR)
                    WHEN 5 THEN '1_' || CAST(o_orderkey AS VARCHAR)
                    WHEN 6 THEN NULL
                    ELSE '-' || CAST(o_orderkey AS VARCHAR) || '.0' END AS txt
        FROM orders"""),
    "basics": (("basics_raw",), """
        SELECT tconst, primaryTitle, originalTitle,
               TRY_CAST(startYear AS BIGINT) AS startYear,
               TRY_CAST(runtimeMinutes AS BIGINT) AS runtimeMinutes, genres
        FROM basics_raw
        WHERE titleType = 'movie' AND CAST(isAdult AS BIGINT) = 0
          AND TRY_CAST(startYear AS BIGINT) >= 2000"""),
    "ratings": (("ratings_raw",), """
        SELECT tconst, CAST(averageRating AS DOUBLE) AS averageRating,
               CAST(numVotes AS BIGINT) AS numVotes
        FROM ratings_raw"""),
    "newest": (("snapshots",), """
        SELECT s.* FROM snapshots s
        JOIN (SELECT tmdb_id, max(snapshot_date) AS day FROM snapshots GROUP BY tmdb_id) m
          ON m.tmdb_id = s.tmdb_id AND m.day = s.snapshot_date"""),
    "src_basics": (("newest",), """
        SELECT imdb_id AS tconst, title AS primaryTitle, original_title AS originalTitle,
               CAST(EXTRACT(YEAR FROM release_date) AS BIGINT) AS startYear,
               CAST(NULL AS BIGINT) AS runtimeMinutes, genre_names AS genres
        FROM newest WHERE imdb_id LIKE 'tt%'"""),
    "src_ratings": (("newest",), """
        SELECT imdb_id AS tconst, vote_average AS averageRating, vote_count AS numVotes
        FROM newest WHERE imdb_id LIKE 'tt%'"""),
    "merged_basics": (("basics", "src_basics"), """
        SELECT t.tconst, s.primaryTitle, s.originalTitle, s.startYear, t.runtimeMinutes, s.genres
        FROM basics t JOIN src_basics s ON s.tconst = t.tconst
        UNION ALL
        SELECT * FROM basics WHERE tconst NOT IN (SELECT tconst FROM src_basics)
        UNION ALL
        SELECT * FROM src_basics WHERE tconst NOT IN (SELECT tconst FROM basics)"""),
    "merged_ratings": (("ratings", "src_ratings"), """
        SELECT * FROM src_ratings
        UNION ALL
        SELECT * FROM ratings WHERE tconst NOT IN (SELECT tconst FROM src_ratings)"""),
    "fct": (("basics", "ratings"), """
        SELECT b.tconst, b.primaryTitle, b.originalTitle, b.startYear AS start_year,
               b.runtimeMinutes AS runtime_minutes, b.genres,
               r.averageRating AS average_rating, r.numVotes AS num_votes
        FROM basics b LEFT JOIN ratings r ON r.tconst = b.tconst"""),
    "exploded": (("fct",), """
        SELECT tconst, primaryTitle, originalTitle, start_year, runtime_minutes,
               average_rating, num_votes, trim(g) AS genre
        FROM (SELECT *, unnest(string_split(genres, ',')) AS g FROM fct)"""),
    "prepared": (("fct",), """
        SELECT tconst, primaryTitle, originalTitle, start_year AS startYear,
               runtime_minutes AS runtimeMinutes, coalesce(genres, 'Unknown') AS genres,
               average_rating AS averageRating, num_votes AS numVotes
        FROM fct WHERE start_year IS NOT NULL"""),
    "scored": (("prepared",), """
        SELECT *, 5.0::DOUBLE + (startYear % 7)::DOUBLE / 4 - (numVotes % 3)::DOUBLE / 8
                   AS predictedRating
        FROM prepared WHERE averageRating IS NOT NULL"""),
    "eras": (("prepared",), """
        SELECT tconst, startYear,
               CASE WHEN startYear BETWEEN 1900 AND 1949 THEN '1900-1949'
                    WHEN startYear BETWEEN 1950 AND 1969 THEN '1950-1969'
                    WHEN startYear BETWEEN 1970 AND 1989 THEN '1970-1989'
                    WHEN startYear BETWEEN 1990 AND 2004 THEN '1990-2004'
                    WHEN startYear BETWEEN 2005 AND 2009 THEN '2005-2009'
                    WHEN startYear BETWEEN 2010 AND 2014 THEN '2010-2014'
                    WHEN startYear BETWEEN 2015 AND 2019 THEN '2015-2019'
                    WHEN startYear BETWEEN 2020 AND 2024 THEN '2020-2024'
                    WHEN startYear >= 2025 THEN '2025-2025' END AS era
        FROM prepared"""),
}

# Eras and genre tokens present in the benchmark tables.
_ERAS = (
    "1900-1949", "1950-1969", "1970-1989", "1990-2004", "2005-2009",
    "2010-2014", "2015-2019", "2020-2024", "2025-2025",
)
_GENRES = (
    " HIGH", " LOW", " MEDIUM", " NOT SPECIFIED", " URGENT", "AUTOMOBILE", "BUILDING",
    "FURNITURE", "HOUSEHOLD", "MACHINERY", "Unknown",
)

_ERA_FLAGS = ", ".join(f"CAST(era = '{era}' AS INTEGER) AS \"era_{era}\"" for era in _ERAS)
_GENRE_FLAGS = ", ".join(
    f"CAST(list_contains(string_split(genres, ','), '{g}') AS INTEGER) AS \"{g}\"" for g in _GENRES
)

_SNAPSHOT_COLUMNS = """tmdb_id, imdb_id, title, original_title, original_language,
    CAST(release_date AS VARCHAR) AS release_date, popularity, vote_average, vote_count,
    genre_ids, genre_names, adult, CAST(snapshot_date AS VARCHAR) AS snapshot_date"""

_GENRE_METRICS = """count(*) AS num_movies, round(sum(average_rating), 3) / count(*) AS avg_rating,
    CAST(sum(num_votes) AS BIGINT) AS total_votes"""

# Whether a prediction must be near the planted rating: where the running time is known.
_NEAR = """CASE WHEN CAST(substr(tconst, 3) AS BIGINT) % 7 <> 2
              AND CAST(substr(tconst, 3) AS BIGINT) % 101 <> 6 THEN true END"""

_NEAR_AWAY = f"""
        SELECT tconst, startYear, averageRating,
               CASE WHEN abs(CAST(substr(tconst, 3) AS BIGINT) % 120 + 60
                             - (SELECT median(runtimeMinutes) FROM prepared)) > 2
                    THEN {_NEAR} END AS near
        FROM scored WHERE startYear >= 2020"""

# Query name -> (blocks it reads, SQL).
CHECKS: dict[str, tuple[tuple[str, ...], str]] = {
    "scan_tsv_basics": (("basics_raw",), "SELECT * FROM basics_raw"),
    "scan_tsv_ratings": (("ratings_raw",), "SELECT * FROM ratings_raw"),
    "null_tokens": ((), """
        SELECT o_orderkey AS k,
               CASE WHEN o_orderkey % 5 < 2 THEN NULL WHEN o_orderkey % 5 = 2 THEN 'None'
                    ELSE CAST(o_orderkey AS VARCHAR) END AS plain,
               CASE WHEN o_orderkey % 5 < 3 THEN NULL
                    ELSE CAST(o_orderkey AS VARCHAR) END AS as_pandas
        FROM orders"""),
    "scan_json_pages": (("listed", "ids_text"), """
        SELECT l.id, title, original_title, original_language, release_date, popularity,
               CAST(vote_average AS VARCHAR) AS vote_average,
               CAST(vote_count AS VARCHAR) AS vote_count, t.genre_ids, adult
        FROM listed l JOIN ids_text t ON t.id = l.id"""),
    "scan_genre_dim": ((), """
        SELECT CAST(n_nationkey AS BIGINT) AS id,
               CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE n_name END AS name
        FROM nation"""),
    "external_id_lookup": (("listed", "crosswalk"), """
        SELECT id AS tmdb_id, title,
               (SELECT min(imdb_id) FROM crosswalk c WHERE c.tmdb_id = l.id) AS imdb_id
        FROM listed l"""),
    "scan_fct_projection": (("fct",), """
        SELECT tconst, primaryTitle, originalTitle, start_year AS startYear,
               runtime_minutes AS runtimeMinutes, genres, average_rating AS averageRating,
               num_votes AS numVotes
        FROM fct"""),
    "full_refresh": (("ratings",), "SELECT * FROM ratings"),
    "full_refresh_empty": (("snapshots",), f"SELECT {_SNAPSHOT_COLUMNS} FROM snapshots"),
    "create_if_missing": (("src_basics",), "SELECT * FROM src_basics"),
    "not_null_key": (("ratings",), "SELECT * FROM ratings WHERE tconst IS NOT NULL"),
    "merge_basics": (("merged_basics",), "SELECT * FROM merged_basics"),
    "merge_ratings": (("merged_ratings",), "SELECT * FROM merged_ratings"),
    "merge_latest_duplicate": (("merged_basics",), "SELECT * FROM merged_basics"),
    "upsert_job": (("merged_ratings",), "SELECT * FROM merged_ratings"),
    "project_basics": (("basics_raw",), """
        SELECT tconst, primaryTitle, originalTitle, startYear, runtimeMinutes, genres
        FROM basics_raw"""),
    "rename_columns": (("fct",), """
        SELECT tconst, primaryTitle, originalTitle, start_year AS startYear,
               runtime_minutes AS runtimeMinutes, genres, average_rating AS averageRating,
               num_votes AS numVotes
        FROM fct"""),
    "strict_int_cast": (("basics_raw",), """
        SELECT tconst, CAST(isAdult AS BIGINT) AS is_adult FROM basics_raw"""),
    "coerce_int": (("messy",), """
        SELECT k, CASE k % 8 WHEN 0 THEN k WHEN 1 THEN k WHEN 2 THEN 10 * k WHEN 7 THEN -k END
                      AS value
        FROM messy"""),
    "coerce_double": (("messy",), """
        SELECT k, CASE WHEN regexp_matches(
                           txt, '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$')
                       THEN CAST(trim(txt) AS DOUBLE) END AS value
        FROM messy"""),
    "coerce_date": (("listed",), """
        SELECT id, CAST(TRY_CAST(release_date AS DATE) AS VARCHAR) AS day FROM listed"""),
    "stg_basics": (("basics_raw",), """
        SELECT tconst, primaryTitle, originalTitle, TRY_CAST(startYear AS BIGINT) AS start_year,
               TRY_CAST(runtimeMinutes AS BIGINT) + 1 AS runtime_minutes, genres
        FROM basics_raw"""),
    "stg_ratings": (("ratings",), """
        SELECT tconst, averageRating AS average_rating, numVotes AS num_votes FROM ratings"""),
    "filter_movies": (("basics_raw",), """
        SELECT tconst, titleType, CAST(isAdult AS BIGINT) AS isAdult,
               CAST(startYear AS BIGINT) AS startYear
        FROM basics_raw
        WHERE titleType = 'movie' AND isAdult = '0' AND CAST(startYear AS BIGINT) >= 2000"""),
    "filter_rated": (("fct",), "SELECT * FROM fct WHERE average_rating IS NOT NULL"),
    "filter_prefix": (("crosswalk",), "SELECT * FROM crosswalk WHERE imdb_id LIKE 'tt%'"),
    "dropna_year": (("basics_raw",), """
        SELECT tconst, CAST(startYear AS BIGINT) AS startYear
        FROM basics_raw WHERE startYear IS NOT NULL"""),
    "rated_flag": (("prepared",), """
        SELECT tconst, averageRating IS NOT NULL AS hasActualRating FROM prepared"""),
    "split_train_test": (("scored",), """
        SELECT count(*) FILTER (WHERE startYear BETWEEN 2000 AND 2020) AS train_rows,
               count(*) FILTER (WHERE startYear BETWEEN 2021 AND 2024) AS test_rows,
               count(*) FILTER (WHERE startYear >= 2020) AS apply_rows
        FROM scored"""),
    "fill_unknown": (("prepared",), "SELECT tconst, genres FROM prepared"),
    "tmdb_to_basics": (("src_basics",), "SELECT * FROM src_basics"),
    "tmdb_to_ratings": (("src_ratings",), "SELECT * FROM src_ratings"),
    "latest_per_key": (("newest",), f"SELECT {_SNAPSHOT_COLUMNS} FROM newest"),
    "basics_clean": (("basics",), "SELECT * FROM basics"),
    "ratings_clean": (("ratings",), "SELECT * FROM ratings"),
    "tmdb_clean": (("listed", "ids_text", "names_text", "crosswalk"), """
        SELECT l.id AS tmdb_id, c.imdb_id, l.title, l.original_title, l.original_language,
               CAST(TRY_CAST(l.release_date AS DATE) AS VARCHAR) AS release_date,
               TRY_CAST(l.popularity AS DOUBLE) AS popularity, l.vote_average, l.vote_count,
               t.genre_ids, n.genre_names, l.adult, '2024-06-02' AS snapshot_date
        FROM listed l
        JOIN ids_text t ON t.id = l.id
        JOIN names_text n ON n.id = l.id
        LEFT JOIN crosswalk c ON c.tmdb_id = l.id"""),
    "genre_ids_join": (("ids_text",), "SELECT * FROM ids_text"),
    "genre_names": (("names_text",), "SELECT * FROM names_text"),
    "genre_names_large_dim": (("names_text",), "SELECT * FROM names_text"),
    "fct_movies": (("fct",), "SELECT * FROM fct"),
    "genre_exploded": (("exploded",), "SELECT * FROM exploded"),
    "genre_summary": (("exploded",), f"""
        SELECT genre, {_GENRE_METRICS} FROM exploded
        WHERE average_rating IS NOT NULL GROUP BY genre ORDER BY num_movies DESC, genre"""),
    "genre_yearly_metrics": (("exploded",), f"""
        SELECT start_year, genre, {_GENRE_METRICS} FROM exploded
        WHERE average_rating IS NOT NULL GROUP BY start_year, genre ORDER BY start_year, genre"""),
    "genre_summary_from_partials": (("exploded",), f"""
        SELECT genre, {_GENRE_METRICS} FROM exploded
        WHERE average_rating IS NOT NULL GROUP BY genre"""),
    "mart_tables": (("exploded",), f"""
        SELECT genre, {_GENRE_METRICS} FROM exploded
        WHERE average_rating IS NOT NULL GROUP BY genre"""),
    "staging_views": (("fct",), "SELECT * FROM fct"),
    "pinned_reads": (("ratings",), "SELECT * FROM ratings"),
    "snapshot_stream": (("listed", "ids_text", "names_text", "crosswalk"), """
        SELECT l.id AS tmdb_id, c.imdb_id, l.title, l.original_title, l.original_language,
               CAST(TRY_CAST(l.release_date AS DATE) AS VARCHAR) AS release_date,
               TRY_CAST(l.popularity AS DOUBLE) AS popularity, l.vote_average, l.vote_count,
               t.genre_ids, n.genre_names, l.adult, '2024-06-02' AS snapshot_date,
               0 AS after_half
        FROM listed l
        JOIN ids_text t ON t.id = l.id
        JOIN names_text n ON n.id = l.id
        LEFT JOIN crosswalk c ON c.tmdb_id = l.id"""),
    "wide_medians": ((), f"""
        SELECT median(CAST(l_extendedprice AS DOUBLE)) AS price,
               median(CAST(l_extendedprice AS DOUBLE) / (l_orderkey + 1)) AS ratio,
               median(CAST(l_quantity AS DOUBLE) * scale) AS scales
        FROM (SELECT *, {" * ".join(f"CASE WHEN (l_orderkey >> {k}) % 2 = 1 THEN {2.0 ** -(2 ** k)!r}::DOUBLE ELSE 1 END" for k in range(8))} AS scale
              FROM lineitem)"""),
    "token_numbers": ((), """
        SELECT title, CAST(row_number() OVER (ORDER BY title) - 1 AS INTEGER) AS place
        FROM (SELECT 'Film ' || CAST(o_orderkey AS VARCHAR) AS title FROM orders)"""),
    "max_year": (("prepared",), "SELECT coalesce(max(startYear), 2035) AS max_year FROM prepared"),
    "feature_medians": (("prepared",), """
        SELECT CAST(median(startYear) AS DOUBLE) AS startYear,
               CAST(median(runtimeMinutes) AS DOUBLE) AS runtimeMinutes,
               CAST(median(numVotes) AS DOUBLE) AS numVotes
        FROM prepared"""),
    "era_bucket": (("eras",), "SELECT tconst, startYear, era FROM eras"),
    "era_onehot": (("eras",), f"SELECT tconst, {_ERA_FLAGS} FROM eras"),
    "genre_onehot": (("prepared",), f"SELECT tconst, {_GENRE_FLAGS} FROM prepared"),
    "ml_features": (("prepared", "eras"), f"""
        SELECT p.tconst, CAST(p.startYear AS DOUBLE) AS startYear,
               coalesce(CAST(runtimeMinutes AS DOUBLE),
                        (SELECT median(runtimeMinutes) FROM prepared)) AS runtimeMinutes,
               coalesce(CAST(numVotes AS DOUBLE),
                        (SELECT median(numVotes) FROM prepared)) AS numVotes,
               {_GENRE_FLAGS}, {_ERA_FLAGS}
        FROM prepared p JOIN eras e ON e.tconst = p.tconst"""),
    "regression_metrics": (("scored",), """
        SELECT count(*) AS n_rows,
               round(sqrt(avg(pow(averageRating - predictedRating, 2))), 6) AS rmse,
               round(avg(abs(averageRating - predictedRating)), 6) AS mae,
               round(1 - sum(pow(averageRating - predictedRating, 2))
                       / sum(pow(averageRating - mean_rating, 2)), 6) AS r2
        FROM (SELECT *, avg(averageRating) OVER () AS mean_rating FROM scored
              WHERE startYear BETWEEN 2021 AND 2024)"""),
    "genre_rating_trends": (("scored",), """
        SELECT startYear AS year, genre, round(sum(averageRating), 3) / count(*) AS averageRating,
               round(sum(predictedRating), 3) / count(*) AS predictedRating, count(tconst) AS movieCount
        FROM (SELECT *, unnest(string_split(genres, ',')) AS genre FROM scored
              WHERE startYear >= 2020)
        GROUP BY startYear, genre"""),
    "rf_predictions": (("scored",), f"""
        SELECT tconst, primaryTitle, startYear, genres, numVotes, averageRating,
               true AS hasActualRating, {_NEAR} AS near
        FROM scored WHERE startYear >= 2020"""),
    "rf_metrics": (("scored",), """
        SELECT count(*) FILTER (WHERE startYear BETWEEN 2021 AND 2024) AS n_rows,
               count(*) FILTER (WHERE startYear BETWEEN 2000 AND 2020) AS train_rows,
               true AS beats_half_deviation, true AS mae_below_rmse
        FROM scored"""),
    "rf_fully_grown": (("scored",), _NEAR_AWAY),
    "rf_large_nodes": (("scored",), _NEAR_AWAY),
    "prediction_sample": (("scored",), f"""
        SELECT primaryTitle, startYear, genres, averageRating,
               true AS hasActualRating, {_NEAR} AS near, true AS in_range
        FROM scored WHERE startYear >= 2020 ORDER BY tconst LIMIT 20"""),
    "publish_predictions": (("scored",), f"""
        SELECT tconst, primaryTitle, startYear, genres, numVotes, averageRating, {_NEAR} AS near
        FROM scored WHERE startYear >= 2020"""),
    "publish_trends": (("scored",), """
        SELECT startYear AS year, genre, round(sum(averageRating), 3) / count(*) AS averageRating,
               count(tconst) AS movieCount,
               CASE WHEN count(tconst) >= 30 THEN true END AS near
        FROM (SELECT *, unnest(string_split(genres, ',')) AS genre FROM scored
              WHERE startYear >= 2020)
        GROUP BY startYear, genre"""),
    "publish_gate": (("scored",), """
        SELECT tconst, primaryTitle, startYear, genres, numVotes, averageRating, predictedRating
        FROM scored WHERE startYear >= 2020"""),
    "missing_feature_column": (("fct",), """
        SELECT tconst, CAST(runtime_minutes AS BIGINT) AS runtimeMinutes,
               CAST(NULL AS DOUBLE) AS numVotes
        FROM fct"""),
    "fct_movies_hot_keys": (("fct",), "SELECT * FROM fct"),
    "daily_run": (("basics", "ratings", "listed", "names_text", "crosswalk"), """
        , day_src AS (
            SELECT c.imdb_id AS tconst,
                   CAST(EXTRACT(YEAR FROM TRY_CAST(l.release_date AS DATE)) AS BIGINT) AS y,
                   n.genre_names AS g, l.vote_average AS r, l.vote_count AS v
            FROM listed l JOIN names_text n ON n.id = l.id
            JOIN crosswalk c ON c.tmdb_id = l.id WHERE c.imdb_id LIKE 'tt%'),
        titles AS (
            SELECT tconst, y, g FROM day_src
            UNION ALL
            SELECT tconst, startYear, genres FROM basics
            WHERE tconst NOT IN (SELECT tconst FROM day_src)),
        votes AS (
            SELECT tconst, r, v FROM day_src
            UNION ALL
            SELECT tconst, averageRating, numVotes FROM ratings
            WHERE tconst NOT IN (SELECT tconst FROM day_src)),
        listed_genres AS (
            SELECT t.y, trim(unnest(string_split(t.g, ','))) AS genre, r, v
            FROM titles t JOIN votes ON votes.tconst = t.tconst)
        SELECT y AS start_year, genre, count(*) AS num_movies, round(sum(r), 3) / count(*) AS avg_rating,
               CAST(sum(v) AS BIGINT) AS total_votes
        FROM listed_genres WHERE r IS NOT NULL GROUP BY y, genre"""),
}


def _with_blocks(needed: tuple[str, ...]) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for parent in BLOCKS[name][0]:
            add(parent)
        if name not in ordered:
            ordered.append(name)

    for name in needed:
        add(name)
    return ",\n".join(f"{name} AS ({BLOCKS[name][1]})" for name in ordered)


def sql_for(name: str) -> str:
    needed, body = CHECKS[name]
    return f"WITH {_with_blocks(needed)}\n{body}" if needed else body
