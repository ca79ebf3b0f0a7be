"""Rating model: features, random forest, evaluation, predictions and trends."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from reelmill.functions.casts import numeric
from reelmill.functions.eras import era_flags, era_label
from reelmill.functions.genres import UNKNOWN, genre_tokens
from reelmill.operators import forest
from reelmill.operators.encode import dense_numbers, genre_flags, genre_places, genre_tokens_of
from reelmill.operators.forest import Forest, ForestParams
from reelmill.operators.joins import left_join
from reelmill.operators.statistics import (
    column_ranges, exact_medians, latest_year, regression_metrics,
)
from reelmill.session import written_once
from reelmill.sources.schemas import PREDICTIONS

# Year spans of the split (both ends inclusive).
TRAIN_YEARS = (2000, 2020)
TEST_YEARS = (2021, 2024)
APPLY_FROM = 2020

NUMERIC_FEATURES = ("startYear", "runtimeMinutes", "numVotes")

_RENAMES = {
    "start_year": "startYear",
    "runtime_minutes": "runtimeMinutes",
    "average_rating": "averageRating",
    "num_votes": "numVotes",
}


@dataclass(frozen=True)
class FeatureSpec:
    """What the features learn from the whole table."""

    max_year: int
    medians: dict[str, float | None] = field(default_factory=dict)


@dataclass(frozen=True)
class ModelRun:
    model: Forest
    spec: FeatureSpec
    metrics: dict[str, float]
    predictions: DataFrame


def training_rows(fct: DataFrame) -> DataFrame:
    """The fact table's columns under their model names."""
    return fct.select(
        "tconst", "primaryTitle", "originalTitle", "start_year", "runtime_minutes",
        "genres", "average_rating", "num_votes",
    ).withColumnsRenamed(_RENAMES)


def add_missing(df: DataFrame, columns=NUMERIC_FEATURES) -> DataFrame:
    """Absent numeric columns as all-NULL ones."""
    absent = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("double") for c in absent}) if absent else df


def prepare(rows: DataFrame) -> DataFrame:
    """Typed figures, rows without a year dropped, missing genres named."""
    rows = add_missing(rows)
    figures = (*NUMERIC_FEATURES, "averageRating")
    typed = rows.withColumns({c: numeric(rows, c) for c in figures})
    return typed.dropna(subset=["startYear"]).fillna({"genres": UNKNOWN})


def rated() -> Column:
    return F.col("averageRating").isNotNull()


def with_rated_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("hasActualRating", rated())


def in_train() -> Column:
    return rated() & F.col("startYear").between(*TRAIN_YEARS)


def in_test() -> Column:
    return rated() & F.col("startYear").between(*TEST_YEARS)


def in_apply(rated_only: bool = True) -> Column:
    recent = F.col("startYear") >= APPLY_FROM
    return recent & rated() if rated_only else recent


def split_sizes(prepared: DataFrame) -> DataFrame:
    """One row with the sizes of the three sets."""
    return prepared.agg(
        F.count_if(in_train()).alias("train_rows"),
        F.count_if(in_test()).alias("test_rows"),
        F.count_if(in_apply()).alias("apply_rows"),
    )


def with_era(prepared: DataFrame, latest_year: int) -> DataFrame:
    return prepared.withColumn("era", era_label(F.col("startYear"), latest_year))


def fit_features(prepared: DataFrame) -> FeatureSpec:
    """Latest year and medians of all rows."""
    figures = prepared.select(*NUMERIC_FEATURES)
    ranges = column_ranges(figures, NUMERIC_FEATURES)
    return FeatureSpec(latest_year(ranges), exact_medians(figures, NUMERIC_FEATURES, ranges))


def dense_columns(spec: FeatureSpec) -> list[Column]:
    """Numeric features with medians for gaps, then era flags."""
    filled = []
    for name in NUMERIC_FEATURES:
        value = F.col(name).cast("double")
        median = spec.medians.get(name)
        filled.append((value if median is None else F.coalesce(value, F.lit(median))).alias(name))
    return [*filled, *era_flags(F.col("startYear"), spec.max_year)]


def feature_matrix(
    prepared: DataFrame, spec: FeatureSpec, genres: Sequence[str], *keep: str
) -> DataFrame:
    """The columns in ``keep`` followed by one column per feature, ``genres`` included."""
    dense = dense_columns(spec)
    numeric_ = len(NUMERIC_FEATURES)
    return prepared.select(*keep, *dense[:numeric_], *genre_flags(genres), *dense[numeric_:])


def assemble(prepared: DataFrame, spec: FeatureSpec, location: str) -> DataFrame:
    """The rows with a sparse feature vector, written to ``location`` and read back.

    A vector holds the numeric features, the era flags and the numbers of the row's
    genres; of the genre vocabulary only its size comes to the driver. The parts are
    written as the plain columns that a stored vector consists of, which reads as one.
    A feature NULL in every row counts as zero.
    """
    tokens = written_once(genre_tokens_of(prepared), f"{location}/tokens")
    index = written_once(dense_numbers(tokens, "genre"), f"{location}/genres")
    lists = genre_places(prepared, index)
    rows = left_join(prepared, lists, "genres", right_unique=True)
    dense = [F.coalesce(c.cast("double"), F.lit(0.0)) for c in dense_columns(spec)]
    places = F.coalesce("places", F.array().cast("array<int>"))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(len(dense) + index.count()).alias("size"),
        F.concat(
            F.array(*[F.lit(i) for i in range(len(dense))]),
            F.transform(places, lambda i: i + F.lit(len(dense))),
        ).alias("indices"),
        F.concat(F.array(*dense), F.transform(places, lambda i: F.lit(1.0))).alias("values"),
    )
    plain = rows.select(*prepared.columns, vector.alias("features"))
    written_once(plain, f"{location}/features")
    schema = T.StructType([*prepared.schema.fields, T.StructField("features", VectorUDT())])
    return prepared.sparkSession.read.schema(schema).parquet(f"{location}/features")


def feature_parts(rows: DataFrame, location: str) -> DataFrame:
    """What ``assemble`` wrote to ``location``, each vector as its stored parts."""
    schema = T.StructType([f for f in rows.schema if f.name != "features"])
    parts = "type tinyint, size int, indices array<int>, values array<double>"
    schema = schema.add("features", T.StructType.fromDDL(parts))
    return rows.sparkSession.read.schema(schema).parquet(f"{location}/features")


def train_and_evaluate(
    fct: DataFrame,
    scratch: str,
    params: ForestParams = ForestParams(),
    rated_only: bool = True,
) -> ModelRun | None:
    """Train on the earlier years, evaluate on the later ones, predict the recent ones.

    None when there is nothing to train or to evaluate on; then nothing should be
    published.
    ``rated_only=False`` also predicts films that have no rating yet. The predictions
    read what was written to ``scratch``, a new folder that executors share.
    """
    prepared = prepare(training_rows(fct))
    sizes = split_sizes(prepared).first()
    if not sizes["train_rows"] or not sizes["test_rows"]:
        return None
    spec = fit_features(prepared)
    rows = feature_parts(assemble(prepared, spec, scratch), scratch)
    size = rows.select("features.size").first()["size"]
    model = forest.fit(
        rows.where(in_train()), len(NUMERIC_FEATURES), size, f"{scratch}/forest", params,
        key="tconst", label="averageRating",
    )
    recent = rows.where(in_test() | in_apply(rated_only))
    said = model.predict(recent, f"{scratch}/recent", prediction="predictedRating")
    scored = written_once(said.drop("features"), f"{scratch}/scored")
    tested = scored.where(in_test())
    metrics = regression_metrics(tested, "averageRating", "predictedRating").first().asDict()
    metrics["train_rows"] = sizes["train_rows"]
    applied = scored.where(in_apply(rated_only))
    predictions = with_rated_flag(applied).select(*PREDICTIONS.names, "hasActualRating")
    return ModelRun(model, spec, metrics, predictions)


def prediction_sample(predictions: DataFrame, rows: int = 20) -> DataFrame:
    """The first predictions by title id, for a look at the run."""
    return predictions.orderBy("tconst").limit(rows).select(
        "primaryTitle", "startYear", "genres", "averageRating", "predictedRating",
        "hasActualRating",
    )


def genre_rating_trends(predictions: DataFrame) -> DataFrame:
    """Mean rating and prediction by year and genre as written (blanks kept)."""
    exploded = predictions.withColumn("genre", F.explode(genre_tokens(F.col("genres"))))
    known = exploded.where(F.col("startYear").isNotNull() & F.col("genre").isNotNull())
    return known.groupBy(F.col("startYear").alias("year"), "genre").agg(
        F.avg("averageRating").alias("averageRating"),
        F.avg("predictedRating").alias("predictedRating"),
        F.count("tconst").alias("movieCount"),
    )
