"""Movie-shaped inputs derived from the benchmark tables, in full."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns read from each benchmark table.
COLUMNS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_quantity double",
    "nation": "n_nationkey int, n_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def title_id(key: str) -> str:
    return f"concat('tt', lpad(string({key}), 12, '0'))"


def planted(key: str) -> str:
    """Tenths of a rating that follow from the running time alone."""
    return f"({key} % 120 * 7 DIV 10)"


EXTERNAL_ID = f"""CASE c_custkey % 9
    WHEN 0 THEN NULL
    WHEN 1 THEN concat('nm', string(c_custkey))
    WHEN 2 THEN concat('tt9', lpad(string(c_custkey), 12, '0'))
    ELSE {title_id('c_custkey')} END"""

RELEASE_TEXT = "if(c_custkey % 8 = 0, '', concat('2024-0', string(1 + c_custkey % 9), '-15'))"

GENRE_IDS = """CASE
    WHEN c_custkey % 6 = 0 THEN NULL
    WHEN c_custkey % 12 = 1 THEN cast(array() AS array<bigint>)
    ELSE array(bigint(c_nationkey), bigint(c_nationkey) + 1) END"""


def basics_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One title row per order, all text."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return orders.join(table(spark, sf_dir, "customer"), "c_custkey").selectExpr(
        f"{title_id('o_orderkey')} AS tconst",
        "if(o_orderkey % 10 = 3, 'short', 'movie') AS titleType",
        "concat('Film ', string(o_orderkey)) AS primaryTitle",
        "if(o_orderkey % 13 = 0, NULL, concat('Film ', string(o_orderkey))) AS originalTitle",
        "if(o_orderkey % 17 = 5, '1', '0') AS isAdult",
        "if(o_orderkey % 19 = 4, NULL, string(1995 + o_orderkey % 31)) AS startYear",
        "string(NULL) AS endYear",
        """CASE WHEN o_orderkey % 7 = 2 THEN NULL
                WHEN o_orderkey % 101 = 6 THEN 'n/x'
                ELSE string(60 + o_orderkey % 120) END AS runtimeMinutes""",
        """CASE WHEN o_orderkey % 11 = 7 THEN NULL
                WHEN o_orderkey % 3 = 0 THEN c_mktsegment
                ELSE concat(c_mktsegment, ', ', substr(o_orderpriority, 3)) END AS genres""",
    )


def ratings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ratings row per order with lines, all text."""
    lines = table(spark, sf_dir, "lineitem")
    sums = lines.groupBy("l_orderkey").agg({"l_quantity": "sum", "*": "count"})
    return sums.selectExpr(
        f"{title_id('l_orderkey')} AS tconst",
        f"string(double({planted('l_orderkey')} + bigint(`sum(l_quantity)`) % 7 + 10) / 10)"
        " AS averageRating",
        "string(`count(1)`) AS numVotes",
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot history: one row per customer, a second, later one for even keys."""
    rows = table(spark, sf_dir, "customer").selectExpr(
        "*", "explode(if(c_custkey % 2 = 0, array(0, 1), array(0))) AS k2"
    )
    return rows.selectExpr(
        "c_custkey AS tmdb_id",
        f"{EXTERNAL_ID} AS imdb_id",
        "concat('Now ', string(c_custkey), ' v', string(k2)) AS title",
        "concat('Now ', string(c_custkey), ' v', string(k2)) AS original_title",
        "'en' AS original_language",
        f"try_cast({RELEASE_TEXT} AS date) AS release_date",
        "double(c_custkey % 1000) AS popularity",
        "double(c_custkey % 100) / 10 AS vote_average",
        "c_custkey * 3 + k2 AS vote_count",
        "string(NULL) AS genre_ids",
        "if(c_custkey % 6 = 0, NULL, c_mktsegment) AS genre_names",
        "false AS adult",
        "date(concat('2024-06-0', string(1 + k2))) AS snapshot_date",
    )


def listed_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Films as a snapshot page lists them, one per customer."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "concat('Now ', string(c_custkey)) AS title",
        "concat('Now ', string(c_custkey)) AS original_title",
        "'en' AS original_language",
        f"{RELEASE_TEXT} AS release_date",
        "if(c_custkey % 10 = 4, 'n/a', string(c_custkey % 1000)) AS popularity",
        "double(c_custkey % 100) / 10 AS vote_average",
        "if(c_custkey % 15 = 7, NULL, c_custkey * 3) AS vote_count",
        f"{GENRE_IDS} AS genre_ids",
        "c_custkey % 17 = 5 AS adult",
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listed films on pages of up to twenty, each with the number of pages."""
    films = listed_films(spark, sf_dir).selectExpr("id DIV 20 AS page", "struct(*) AS film")
    grouped = films.groupBy("page").agg({"film": "collect_list"})
    total = films.select("page").distinct().count()
    return grouped.toDF("page", "results").selectExpr(
        "page + 1 AS page", f"bigint({total}) AS total_pages", "results"
    )


def genre_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One genre per nation, some with an empty name."""
    return table(spark, sf_dir, "nation").selectExpr(
        "bigint(n_nationkey) AS id", "if(n_nationkey % 4 = 0, '', n_name) AS name"
    )


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS tmdb_id", f"{EXTERNAL_ID} AS imdb_id"
    )


def null_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, plain, as_pandas): every order key, or one of several NULL spellings."""
    mark = """CASE o_orderkey % 5
        WHEN 0 THEN '\\\\N' WHEN 1 THEN '' WHEN 2 THEN 'None' ELSE string(o_orderkey) END"""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", f"{mark} AS plain", f"{mark} AS as_pandas"
    )


def messy_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, txt): every order key in one of eight spellings, some of them no number."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k",
        """CASE o_orderkey % 8
            WHEN 0 THEN string(o_orderkey)
            WHEN 1 THEN concat(' ', string(o_orderkey), ' ')
            WHEN 2 THEN concat(string(o_orderkey), 'e1')
            WHEN 3 THEN concat('x', string(o_orderkey))
            WHEN 4 THEN concat('0x', string(o_orderkey))
            WHEN 5 THEN concat('1_', string(o_orderkey))
            WHEN 6 THEN NULL
            ELSE concat('-', string(o_orderkey), '.0') END AS txt""",
    )
