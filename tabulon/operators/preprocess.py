"""The whole preprocessing chain (FE-9): cast -> fill -> de-outlier -> scale -> drop ->
assemble -> write, as ``fit`` and ``transform``.

``fit`` learns the fences and the scaler from the training rows. Columns that are cast or filled and
have statistics are written once; the selection of the quartiles (counts and ranges, then two rounds
as a rule) and the scaler's one aggregation read them pruned. What was learned is a small artefact
that is saved and loaded; ``transform`` applies it to any rows (training, test, a scoring batch) as
one lazy projection and filter, and never learns anything.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tabulon.operators import clean, features, outliers
from tabulon.plans.lookup import materialised


@dataclass
class PreprocessSpec:
    types: dict[str, str] = field(default_factory=dict)
    fill: list[str] = field(default_factory=list)
    fill_value: float = 0
    outlier_cols: list[str] = field(default_factory=list)
    k: float = 1.5
    scale: list[str] = field(default_factory=list)
    drop: list[str] = field(default_factory=list)
    features: list[str] = field(default_factory=list)
    features_col: str = "features"


@dataclass
class FittedPreprocess:
    """A specification with the statistics of the rows that it was fitted on: the fences (None: no
    value was there) and the (mean, population std) of the rows inside all of them."""

    spec: PreprocessSpec
    fences: dict[str, tuple[float | None, float | None]]
    scaling: dict[str, tuple[float | None, float | None]]

    def transform(self, df: DataFrame, remove_outliers: bool = True) -> DataFrame:
        """Any rows through the fitted chain. A scoring batch keeps all its rows with
        ``remove_outliers=False``."""
        x = _typed(df, self.spec)
        if self.fences and remove_outliers:
            x = outliers.remove_outliers(x, list(self.fences), bounds=self.fences)
        if self.scaling:
            x = features.standard_scale_transform(x, self.scaling)
        if self.spec.drop:
            x = x.drop(*self.spec.drop)
        return features.assemble(x, self.spec.features, self.spec.features_col) if self.spec.features else x

    def save(self, spark: SparkSession, path: str) -> None:
        """One row of JSON; floats come back as they were, infinite ones too."""
        spark.createDataFrame([(json.dumps(asdict(self)),)], "fitted string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedPreprocess:
        known = json.loads(spark.read.parquet(path).first()["fitted"])
        pairs = {name: {c: tuple(v) for c, v in known[name].items()} for name in ("fences", "scaling")}
        return cls(PreprocessSpec(**known["spec"]), **pairs)


def _typed(df: DataFrame, spec: PreprocessSpec) -> DataFrame:
    x = clean.cast_columns(df, spec.types) if spec.types else df
    return clean.fill_missing(x, spec.fill, spec.fill_value) if spec.fill else x


def fit(df: DataFrame, spec: PreprocessSpec) -> FittedPreprocess:
    """Statistics of the training rows: the write, if there are types or fills, and four actions as a
    rule, whatever the number of columns."""
    needed = list(dict.fromkeys([*spec.outlier_cols, *spec.scale]))
    typed = _typed(df, spec).select(*needed)
    if needed and (spec.types or spec.fill):
        typed = materialised(typed)
    fences = outliers.fences(typed, spec.outlier_cols, spec.k) if spec.outlier_cols else {}
    inside = outliers.remove_outliers(typed, list(fences), bounds=fences) if fences else typed
    return FittedPreprocess(spec, fences, features.standard_scale_fit(inside, spec.scale) if spec.scale else {})


def preprocess(df: DataFrame, spec: PreprocessSpec, out_path: str | None = None) -> DataFrame:
    """Fit and transform the same rows; with ``out_path`` the result is written as Parquet and read
    back, which also cuts the lineage for whatever trains on it."""
    x = fit(df, spec).transform(df)
    if out_path:
        x.write.mode("overwrite").parquet(out_path)
        x = df.sparkSession.read.parquet(out_path)
    return x
