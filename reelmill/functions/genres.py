"""Comma-joined genre lists and genre id arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNKNOWN = "Unknown"


def genre_tokens(column: Column) -> Column:
    """The list held in a comma-joined text, blanks kept; NULL stays NULL."""
    return F.split(column, ",", -1)


def join_ids(ids: Column) -> Column:
    """Comma-joined ids: ``''`` for an empty list, NULL for no list."""
    return F.array_join(ids.cast("array<string>"), ",")


def join_names(names: Column) -> Column:
    """Comma-joined known names in list order; NULL when none is known."""
    known = F.filter(names, lambda name: name.isNotNull() & (name != ""))
    return F.nullif(F.array_join(known, ","), F.lit(""))


def names_from_map(ids: Column, names_by_id: dict[int, str]) -> Column:
    """Names for an id list from a small dictionary held as a literal."""
    if not names_by_id:
        return F.lit(None).cast("string")
    pairs = [F.lit(part) for item in sorted(names_by_id.items()) for part in item]
    lookup = F.create_map(*pairs).cast("map<bigint,string>")
    return join_names(F.transform(ids, lambda i: F.try_element_at(lookup, i.cast("bigint"))))


def has_genre(column: Column, genre: str) -> Column:
    return F.array_contains(genre_tokens(column), genre).cast("int")
