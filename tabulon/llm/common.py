"""Shared expressions and helpers of the operators in this subpackage."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.session import scratch_path

#: White space of every contract in this subpackage: the space and the controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
#: A word is a longest run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A bound input table; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def collapse_space(col: Column) -> Column:
    """Every run of white space becomes one space (no trimming)."""
    return F.regexp_replace(col, SPACE, " ")


def spaces_only(col: Column) -> Column:
    """Tabs, line ends and feeds become spaces, one for one. A chain of plain replacements: much
    cheaper than ``translate`` or a pattern over long texts."""
    for code in range(9, 14):
        col = F.replace(col, F.lit(chr(code)), F.lit(" "))
    return col


def word_array(col: Column) -> Column:
    """The words of a non-null text, in order."""
    return F.array_remove(F.split(spaces_only(col), " "), "")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once to the shared scratch folder and read it back.

    Cuts the lineage on storage that every executor reaches, so later steps survive lost
    executors; unlike ``checkpoint()`` the plan runs once and the result stays columnar."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(df: DataFrame) -> list[Column]:
    """128 bits that stand for a whole row, whatever its place: what ties between rows are broken by.
    Columns that cannot be hashed (maps) do not count."""
    names = [f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    set_ = [F.col(n).isNull() for n in names]
    return [F.xxhash64(F.lit(k), *[F.col(n) for n in names], *set_) for k in (1, 2)]


def process_cache() -> dict:
    """A dictionary that lives as long as the Python worker process (functions shipped by value
    get fresh module globals in every task)."""
    name = "_tabulon_llm_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return sys.modules[name].__dict__.setdefault("cache", {})
