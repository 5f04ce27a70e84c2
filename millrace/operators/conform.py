"""Joins and unions that shape the clean layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.merge import newest_per_key
from millrace.operators.skew import join_unique


def code_master(major: DataFrame, minor: DataFrame, on: str) -> DataFrame:
    """Flat code list: every minor code with its major code; of several major rows the greatest counts."""
    return join_unique(minor, major, on, "inner")


def extend_contract(
    main: DataFrame, extension: DataFrame, on: str, order_cols: Sequence[str] | None = None
) -> DataFrame:
    """Main rows with the columns of their extension, nulls where there is none.

    Of several extension rows of a key the newest by ``order_cols`` is taken, without these the greatest.
    """
    most = extension.count()
    if order_cols:
        extension = newest_per_key(extension, [on], order_cols)
    return join_unique(main, extension, on, "left", unique=bool(order_cols), most=most)


def conform_union(parts: Sequence[tuple[DataFrame, Mapping[str, str | Column]]]) -> DataFrame:
    """Map several tables to one column list and append them; columns a part lacks are null.

    Each mapping goes from result column to a source column name or an expression.
    """
    result: DataFrame | None = None
    for frame, mapping in parts:
        mapped = frame.select(
            *[(F.col(f"`{s}`") if isinstance(s, str) else s).alias(name) for name, s in mapping.items()]
        )
        result = mapped if result is None else result.unionByName(mapped, allowMissingColumns=True)
    if result is None:
        raise ValueError("nothing to union")
    return result
