"""Text aggregates and concatenations with the NULL rules of the exports."""

from pyspark.sql import Column, functions as F


def joined(values: Column, separator: str) -> Column:
    """Text of an array, NULL when it is empty."""
    return F.when(F.size(values) > 0, F.array_join(values, separator))


def joined_distinct(value: Column | str, separator: str) -> Column:
    """Aggregate: the distinct values in ascending order; NULL when there is none."""
    return joined(F.sort_array(F.collect_set(value)), separator)


def full_name(family: str, first: str) -> Column:
    """Family and first name with a blank between, a missing part counting as empty."""
    return F.concat(F.coalesce(family, F.lit("")), F.lit(" "), F.coalesce(first, F.lit("")))
