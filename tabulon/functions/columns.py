"""Column-expression helpers. All of them are built-in Catalyst expressions (codegen, no UDF)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_float_type(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType))


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN for float/double columns (``isnan`` on other types raises under ANSI)."""
    c = F.col(name)
    if is_float_type(df.schema[name].dataType):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The value as double, NULL where it is missing (NULL or NaN): what statistics skip."""
    return F.when(~is_missing(df, name), F.col(name).cast("double"))


def is_infinite(name: str) -> Column:
    c = F.col(name)
    return (c == F.lit(float("inf"))) | (c == F.lit(float("-inf")))


def any_of(conditions: list[Column]) -> Column:
    """OR-reduce; an empty list is FALSE."""
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def all_of(conditions: list[Column]) -> Column:
    """AND-reduce; an empty list is TRUE."""
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_or(num: Column, den: Column, default: float) -> Column:
    """num / den, ``default`` when den is 0."""
    return F.when(den == 0, F.lit(default)).otherwise(num.cast("double") / den.cast("double"))


def nan_ratio(num: Column, den: Column) -> Column:
    """num / den, NaN when den is 0 (the unguarded numpy convention)."""
    return ratio_or(num, den, float("nan"))


def vector_element(col: str | Column, index: int) -> Column:
    """Element of an ML vector column without a Python UDF."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(col) if isinstance(col, str) else col)[index]
