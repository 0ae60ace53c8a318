"""Column helpers shared by the operators.

Expressions that are generated per KPI are SQL text: one call per column instead of one per function.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pad_id(column: str | Column, width: int = 6) -> Column:
    """Left-pad short ids with zeros; ids of ``width`` or more characters stay whole."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def row_sum(columns: Sequence[str]) -> str:
    """SQL text: sum across columns, null as soon as one of them is null."""
    return "(" + " + ".join(f"`{c}`" for c in columns) + ")"


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def lower_names(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Lower-case all column names, or those listed."""
    chosen = set(df.columns if columns is None else columns)
    return df.toDF(*[c.lower() if c in chosen else c for c in df.columns])


def round_columns(df: DataFrame, digits: int = 2, columns: Iterable[str] | None = None) -> DataFrame:
    """Round the listed columns, by default every float and double."""
    if columns is None:
        columns = [c for c, t in df.dtypes if t in ("double", "float")]
    chosen = set(columns)
    return df.selectExpr(*[f"round(`{c}`, {digits}) AS `{c}`" if c in chosen else f"`{c}`" for c in df.columns])


def cast_columns(df: DataFrame, columns: Iterable[str], dtype: str = "double") -> DataFrame:
    """Cast a subset in place; text that does not parse becomes null."""
    chosen = set(columns)
    return df.selectExpr(*[f"try_cast(`{c}` AS {dtype}) AS `{c}`" if c in chosen else f"`{c}`" for c in df.columns])


def add_missing(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add the columns that ``df`` lacks."""
    absent = {c: v for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df
