"""Text-to-value casts with an explicit rule for bad text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# What counts as a number. Spark alone would also take '1d', 'nan' and 'inf'.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"

# Tokens that mean NULL in the title files.
NULL_TOKENS = ("\\N", "")

# Further tokens that pandas reads as NULL by default.
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def null_tokens(pandas_na: bool = False) -> tuple[str, ...]:
    return NULL_TOKENS + PANDAS_NULL_TOKENS if pandas_na else NULL_TOKENS


def normalize_nulls(
    df: DataFrame,
    tokens: Iterable[str] = NULL_TOKENS,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Turn NULL-meaning tokens into NULL in every text column, or those named."""
    tokens = list(tokens)
    wanted = set(df.columns if columns is None else columns)

    def clean(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if field.name not in wanted or not isinstance(field.dataType, T.StringType):
            return column
        return F.when(~column.isin(tokens), column).alias(field.name)

    return df.select(*[clean(field) for field in df.schema.fields])


def coerce_double(column: Column) -> Column:
    """Number or NULL; NaN and infinities become NULL."""
    text = column.cast("string")
    number = text.try_cast("double")
    return F.when(text.rlike(NUMBER) & (F.abs(number) < float("inf")), number)


def coerce_int(column: Column, fractions: str = "error") -> Column:
    """Whole number or NULL for bad text.

    A number that is not whole fails the job (``fractions='error'``) or becomes
    NULL (``fractions='null'``). Plain integers take the first, exact branch; only
    other text is matched against the number pattern.
    """
    text = column.cast("string")
    number = text.try_cast("double")
    whole = F.when(number == F.rint(number), number.try_cast("bigint"))
    if fractions == "error":
        failure = F.raise_error(F.concat(F.lit("not a whole number: "), text))
        whole = F.coalesce(whole, failure.cast("bigint"))
    elif fractions != "null":
        raise ValueError(f"fractions must be 'error' or 'null', not {fractions!r}")
    return F.coalesce(text.try_cast("bigint"), F.when(text.rlike(NUMBER), whole))


def strict_int(column: Column) -> Column:
    """Whole number; any other text fails the job, whatever the ANSI setting."""
    text = column.cast("string")
    failure = F.raise_error(F.concat(F.lit("invalid integer: "), text)).cast("bigint")
    return F.when(text.isNotNull(), F.coalesce(text.try_cast("bigint"), failure))


def whole_number(column: Column) -> Column:
    """Nearest whole number (halves away from zero), NULL for bad text."""
    return F.round(column.try_cast("decimal(38,10)"), 0).try_cast("bigint")


def coerce_date(column: Column) -> Column:
    """Date from year-month-day text, NULL for anything else."""
    return F.when(column.rlike(ISO_DATE), column.try_cast("date"))


def numeric(df: DataFrame, name: str, whole: bool = False) -> Column:
    """The column as a number; a column that already is one passes unchanged."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, T.IntegralType):
        return column.cast("bigint")
    if whole:
        return whole_number(column)
    if isinstance(kind, T.FractionalType):
        return F.nanvl(column.cast("double"), F.lit(None).cast("double"))
    return coerce_double(column)
