"""Writes the derived inputs in the landed file formats."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from reelmill.plans.jobs import Landed
from reelmill.testbed import inputs


def workspace(spark: SparkSession) -> str:
    """A new folder for a query's tables: below the session's checkpoint folder, or a
    temporary one where a local session names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = shared or tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/reelmill-{uuid.uuid4().hex}"


def write_tsv(df: DataFrame, path: str) -> str:
    (
        df.write.option("sep", "\t")
        .option("header", True)
        .option("nullValue", "\\N")
        .option("emptyValue", "")
        .option("quote", "")
        .option("compression", "gzip")
        .csv(path)
    )
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.json(path)
    return path


def genre_list(dim: DataFrame) -> DataFrame:
    return dim.selectExpr("array(struct(id, name)) AS genres")


def land_titles(spark: SparkSession, sf_dir: str, root: str) -> tuple[str, str]:
    return (
        write_tsv(inputs.basics_raw(spark, sf_dir), f"{root}/title.basics"),
        write_tsv(inputs.ratings_raw(spark, sf_dir), f"{root}/title.ratings"),
    )


def land_pages(spark: SparkSession, sf_dir: str) -> Landed:
    """What pages are joined to, landed, and a folder for the pages themselves."""
    root = workspace(spark)
    ids = f"{root}/external_ids"
    inputs.crosswalk(spark, sf_dir).write.parquet(ids)
    genres = write_json(genre_list(inputs.genre_dim(spark, sf_dir)), f"{root}/genres")
    return Landed("", "", f"{root}/pages", genres, ids)


def land_day(spark: SparkSession, sf_dir: str) -> Landed:
    landed = land_pages(spark, sf_dir)
    basics, ratings = land_titles(spark, sf_dir, workspace(spark))
    write_json(inputs.pages(spark, sf_dir), landed.pages)
    return replace(landed, basics=basics, ratings=ratings)
