"""Address text and geocoder answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def token_count(text: Column) -> Column:
    """Number of pieces when split on single spaces; empty pieces count."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1


def token_prefix(text: Column, tokens: Column) -> Column:
    """The first ``tokens`` space-separated pieces, joined again."""
    return F.call_function("substring_index", text, F.lit(" "), tokens)


def _first_group(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def building_dong(address: Column) -> Column:
    """Building number: the digits before the first 동 that has some."""
    return _first_group(address, "([0-9]+)동")


def building_ho(address: Column) -> Column:
    """Unit number: the digits before the first 호 that has some."""
    return _first_group(address, "([0-9]+)호")
