"""Splitting and class balancing (SP-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.plans.lookup import attach, materialised

DEFAULT_NAMES = ("train", "test", "val")


def random_split(df: DataFrame, weights: list[float], seed: int = 42,
                 names=DEFAULT_NAMES) -> dict[str, DataFrame]:
    """``randomSplit``: Bernoulli sampling per partition. The assignment depends on the
    input partitioning, so it is not reproducible across clusters; see ``hash_split``."""
    parts = df.randomSplit(weights, seed)
    return dict(zip(names, parts))


#: The hash of a key is a whole number below this.
HASH_RANGE = 1 << 60


def key_hash(key: str) -> Column:
    """Stable hash of a key: the first 60 bits of md5(key as text)."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 15), 16, 10).cast("long")


def cut_points(weights: list[float]) -> list[int]:
    """Upper ends of the parts in the hash range, in the order of the weights (the last part takes
    the rest)."""
    total, acc, out = float(sum(weights)), 0.0, []
    for w in weights[:-1]:
        acc += w
        out.append(int(acc / total * HASH_RANGE))
    return out


def hash_split(df: DataFrame, key: str, weights: list[float], names=DEFAULT_NAMES,
               out: str = "split") -> DataFrame:
    """Reproducible split: a row goes to the part whose stretch of the 60-bit hash range holds its
    key's hash, so parts of any small share get their rows. Independent of partitioning and cluster
    size."""
    h = key_hash(key)
    expr = None
    for name, end in zip(names, cut_points(weights)):
        cond = h < F.lit(end)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    expr = F.lit(names[len(weights) - 1]) if expr is None else expr.otherwise(F.lit(names[len(weights) - 1]))
    return df.withColumn(out, expr)


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """(label, n_class, weight = N / (K * n_class)); N / K is a scalar subquery over the class counts,
    whose shuffle both share."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    mean = counts.agg(F.sum("n_class").cast("double").alias("n"), F.count(F.lit(1)).cast("double").alias("k"))
    n, k = mean.select("n").scalar(), mean.select("k").scalar()
    return counts.withColumn("weight", n / (k * F.col("n_class").cast("double")))


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Rows with a class-balancing weight column: NULL-safe equi-join on the label (a NULL
    label is its own class, no row is dropped); the written K-row table is broadcast."""
    w = class_weight_table(df, label).select(label, F.col("weight").alias(out))
    return attach(df, materialised(w), [label])
