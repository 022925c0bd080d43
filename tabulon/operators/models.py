"""Training and tuning of Spark ML classifiers (ML-*), and the champion rule.

Models are Spark ML ``PipelineModel``s (assembler + classifier), so a saved model scores raw
feature columns. Fits read a ``TrainingFrame``: feature vector, label, weight and fold, narrow, laid
out by the rows' own values in as many partitions as the counted rows need, so bagging and
splitting, which draw per partition, give the same model on any cluster, and equal rows, however
many, are spread like others. Everything that is tuned on the same rows (grid points, folds,
families) shares one persisted frame; ``parallelism`` fits run at a time, the largest grid points
first, so that a long fit does not start last.

Trees see a feature through at most ``maxBins`` bins, so they are fitted on the counted cells of the
binned rows (bins of the features, label, weight), each with its rows as weight: one pass over the
rows, then fits whose size follows from the bins. Their models are ``Bucketizer`` + assembler +
classifier and score raw columns too. A forest bags every row of a cell, however many there are: the
draws of n rows add up to one Poisson draw of mean n.
"""

from __future__ import annotations

import math
import sys
from contextlib import nullcontext
from functools import cached_property
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, StorageLevel, TaskContext, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tabulon.functions.columns import vector_element
from tabulon.operators.evaluate import evaluate
from tabulon.plans.lookup import materialised

FEATURES = "_features"

# ---- fixed values: tuning grids of the reference workflows ----
# k-fold cross-validation (3 folds, accuracy)
CV_GRIDS = {
    "logistic": {"maxIter": [10, 20, 30], "regParam": [0.1, 0.01, 0.001]},
    "tree": {"maxDepth": [5, 10, 20], "maxBins": [70, 100, 150]},
    "forest": {"maxDepth": [5, 10, 20], "maxBins": [70, 100, 150], "numTrees": [10, 20, 30]},
}
# train/validation split (ratio 0.9, accuracy); gbt is tuned inside one-vs-rest
TVS_GRIDS = {
    "logistic": {"regParam": [0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0],
                 "maxIter": [50, 100, 200]},
    "forest": {"numTrees": [10, 50, 100], "maxDepth": [5, 10, 20], "maxBins": [32, 64]},
    "gbt": {"maxDepth": [5, 10], "maxBins": [32, 64]},
}
# split weights and part names, in the order each workflow unpacks them
SPLITS = {
    "functions": ([0.8, 0.1, 0.1], ("train", "test", "val")),
    "notebook_lr_rf": ([0.7, 0.15, 0.15], ("train", "val", "test")),
    "notebook_gbt": ([0.8, 0.1, 0.1], ("train", "val", "test")),
}
SEED = 42


class Forest(RandomForestClassifier):
    """A random forest of counted rows: a row that stands for ``N_ROWS`` rows is drawn for a tree as
    often as these together, by a Poisson draw of that mean, and weighs so many times what each of them
    weighs. Trees are drawn and grown apart from each other, from seeds that follow from the forest's seed
    and their number: a smaller forest is the first trees of a larger one."""

    #: The column of the rows that a row stands for, and the pool for the fits of trees (None: of its own).
    rows, pool = "_n_rows", None

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        trees, label = self.getNumTrees(), self.getLabelCol()
        top = dataset.agg(F.max(label)).first()[0]
        if top is None:
            raise ValueError("a forest needs rows with a label")
        each = F.col(self.getWeightCol()) / F.col(self.rows) if self.isSet(self.weightCol) else F.lit(1.0)
        classes = {"ml_attr": {"type": "nominal", "num_vals": int(top) + 1}}  # also of a tree that draws no row of some
        rows = dataset.select(self.getFeaturesCol(), F.col(label).cast("double").alias(label, metadata=classes),
                              each.alias("_each"), F.col(self.rows).cast("double").alias("_mean"))
        spark, made = dataset.sparkSession, []
        rows = rows.filter(F.col("_mean") > 0)
        own = ThreadPool(min(trees, PARALLELISM)) if self.pool is None else nullcontext(self.pool)
        with own as pool:
            for first in range(0, trees, DRAWN):
                drawn = _drawn(rows, self.getSeed(), range(first, min(trees, first + DRAWN)))
                drawn = materialised(drawn)
                totals = drawn.agg(*[F.sum(c) for c in drawn.columns if c.startswith("_drawn")]).first()

                def tree(k, first=first, drawn=drawn, totals=totals):
                    draws = F.col(f"_drawn{first + k}")
                    bag = drawn.filter(draws > 0) if totals[k] else drawn
                    weight = (draws * F.col("_each")).alias(WEIGHT)
                    return self._tree(bag.select(self.getFeaturesCol(), label, weight), first + k)

                made.extend(pool.map(inheritable_thread_target(spark)(tree), range(len(totals)), 1))
        return self._copyValues(_forest(made[0], [m._java_obj.trees()[0] for m in made]))

    def _tree(self, bag: DataFrame, number: int) -> RandomForestClassificationModel:
        strategy = self.getFeatureSubsetStrategy()
        if strategy == "auto":
            strategy = "sqrt" if self.getNumTrees() > 1 else "all"
        seed = int(np.random.SeedSequence(_entropy(self.getSeed(), number)).generate_state(1, np.uint64)[0] >> np.uint64(1))
        return RandomForestClassifier._fit(self.copy({
            self.numTrees: 1, self.bootstrap: False, self.seed: seed, self.weightCol: WEIGHT,
            self.featureSubsetStrategy: strategy}), bag)


def _entropy(*of: int) -> list[int]:
    return [k % (1 << 64) for k in of]


def _drawn(rows: DataFrame, seed: int, trees: range) -> DataFrame:
    """The rows with the draws of these trees (``_drawn0``, ...), Poisson of mean ``_mean``, the last column:
    a stream for every tree and partition, so that other trees do not change a tree's draws."""
    entropy, names = [_entropy(seed, t) for t in trees], [f"_drawn{t}" for t in trees]

    def draw(batches):
        at = TaskContext.get().partitionId()
        streams = [np.random.Generator(np.random.PCG64([*e, at])) for e in entropy]
        for batch in batches:
            mean = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            draws = [pa.array(s.poisson(mean), pa.int64()) for s in streams]
            yield pa.RecordBatch.from_arrays([*batch.columns, *draws], names=[*batch.schema.names, *names])

    return rows.mapInArrow(draw, StructType([*rows.schema.fields, *[StructField(c, LongType()) for c in names]]))


FAMILIES = {
    "logistic": LogisticRegression,
    "tree": DecisionTreeClassifier,
    "forest": Forest,
    "gbt": GBTClassifier,
}


def classifier(family: str, label: str, weight: str | None = None, seed: int = 42, **params):
    cls = FAMILIES[family]
    est = cls(featuresCol=FEATURES, labelCol=label, **params)
    if weight:
        est.setWeightCol(weight)
    if est.hasParam("seed"):
        est.setSeed(seed)
    return est


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=FEATURES, handleInvalid="error")


#: Rows of a partition of a training frame: its partitions follow from the counted rows.
ROWS_PER_PARTITION = 50_000
#: A fit on the rows themselves reads so many of these partitions at a time: its many short passes cost as many tasks.
ROWS_PASSES = 4
#: Equal rows that are placed together; the next ones go elsewhere.
TOGETHER = 64
#: Fits that run at a time.
PARALLELISM = 8
FOLD = "_fold"
#: A hash of a row's values and of its number among equal rows, from which splits are drawn.
ROW = "_row"
#: What cells weigh in a fit, and the rows that they count in a validation.
WEIGHT = "_weight"
N_ROWS = "_n_rows"
#: Families that see binned features only.
BINNED = ("tree", "forest", "gbt")
#: Rows of which ``cells(bagged=True)`` makes portions of one row; no fit asks for portions.
BAGGED = 1_000_000
#: Trees of a forest whose draws are held at a time.
DRAWN = 32

#: Nodes of a forest that the driver goes through to cut it at a depth; a larger one is fitted anew.
WALKED = 20_000


def _counted(df: DataFrame, cols: list[str]) -> DataFrame:
    return materialised(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies")))


def _numbered(copies: DataFrame, cols: list[str], rows_per_partition: int) -> DataFrame:
    """The rows behind the counted ones, with their number among equal rows, in as many partitions as
    they need."""
    n_rows = copies.agg(F.sum("_copies")).first()[0] or 0
    partitions = max(1, -(-n_rows // rows_per_partition))
    last = F.expr(f"(_copies - 1) div {TOGETHER}")
    portions = copies.withColumn("_portion", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    placed = portions.repartition(partitions, *cols, "_portion")
    first = F.col("_portion") * TOGETHER
    numbers = F.sequence(first + 1, F.least(F.col("_copies"), first + TOGETHER))
    return placed.withColumn("_number", F.explode(numbers)).drop("_copies", "_portion")


def _row_hash(cols: list[str]) -> F.Column:
    return F.xxhash64(*cols, "_number")


def _fold(row: F.Column, folds: int) -> F.Column:
    return F.pmod(row, F.lit(folds)).cast("int")


def _held_back(row: F.Column, ratio: float, seed: int) -> F.Column:
    """Whether a row belongs to the validation part of a train/validation split."""
    return F.pmod(F.xxhash64(row, F.lit(seed)), F.lit(1 << 53)) >= F.lit(ratio * (1 << 53))


def laid_out(df: DataFrame, cols: list[str], rows_per_partition: int = ROWS_PER_PARTITION, folds: int = 0) -> DataFrame:
    """The rows of ``cols``, placed by a hash of their values and of their number among equal rows and
    sorted: the layout depends on the rows and the parameter alone. Equal rows are counted first (with
    map-side combining), so a value that a third of all rows share is one row until it is placed, in
    portions of ``TOGETHER``. With ``folds`` the rows have a fold, by a hash of the same."""
    return _laid_out(_counted(df, cols), cols, rows_per_partition, folds).drop(ROW)


def _laid_out(copies: DataFrame, cols: list[str], rows_per_partition: int, folds: int) -> DataFrame:
    rows = _numbered(copies, cols, rows_per_partition).sortWithinPartitions(*cols, "_number")
    rows = rows.withColumn(ROW, _row_hash(cols)).drop("_number")
    return rows.withColumn(FOLD, _fold(F.col(ROW), folds)) if folds else rows


#: Bins of the first round over a column's range, and of each too full piece in a later one.
FIRST_ROUND, LATER_ROUNDS, MAX_ROUNDS = 65_536, 256, 12


def _pieces(df: DataFrame, x: F.Column, n: F.Column, lo: float, hi: float, share: float) -> list[tuple]:
    """Ascending pieces (least value, greatest value, rows) of the finite values ``x`` between ``lo`` and
    ``hi``: equal ranges, parted at 0, and where one holds more than ``share`` rows and several values,
    ranges of it in turn: equal ones, then narrower ones to its lower and to its upper end, for values
    of many magnitudes. A round is one aggregation; the driver gets a bounded histogram."""
    def within(frame: DataFrame, low: F.Column, high: F.Column, parts: int, by: F.Column, to: str) -> list[tuple]:
        span, rising, falling = high / 2 - low / 2, F.col("x") / 2 - low / 2, high / 2 - F.col("x") / 2
        at = {"equal": F.try_divide(rising, span), "low": F.pow(F.try_divide(rising, span), F.lit(1 / 32)),
              "high": 1 - F.pow(F.try_divide(falling, span), F.lit(1 / 32))}[to]
        cut = F.least(F.floor(F.coalesce(at, F.lit(0.0)) * parts), F.lit(parts - 1)).cast("int")
        found = frame.groupBy(by.alias("_of"), cut.alias("_cut")).agg(F.min("x"), F.max("x"), F.sum("n")).collect()
        return [tuple(r)[2:] for r in found]

    rows = df.select(x.alias("x"), n.alias("n")).filter(F.col("x").between(F.lit(lo), F.lit(hi)))
    pieces = sorted(within(rows, F.lit(lo), F.lit(hi), FIRST_ROUND, F.col("x") < 0, "equal"))
    for k_round in range(MAX_ROUNDS):
        full = {k: p for k, p in enumerate(pieces) if p[2] > share and p[0] < p[1]}
        if not full:
            break
        inner = [-math.inf, *[p[0] for p in pieces[1:]], math.inf]
        placed = (Bucketizer(splits=inner, inputCol="x", outputCol="_at").transform(rows) if len(inner) > 2
                  else rows.withColumn("_at", F.lit(0.0)))
        placed = placed.withColumn("_at", F.col("_at").cast("int")).filter(F.col("_at").isin(list(full)))
        low, high = (F.create_map(*[F.lit(v) for k, p in full.items() for v in (k, p[end])])[F.col("_at")] for end in (0, 1))
        found = within(placed, low, high, LATER_ROUNDS, F.col("_at"), ("equal", "low", "high")[k_round % 3])
        pieces = sorted([p for k, p in enumerate(pieces) if k not in full] + found)
    return pieces


def bin_edges(df: DataFrame, cols: list[str], bins: int, n: F.Column | None = None) -> dict[str, list[float]]:
    """The inner edges of at most ``bins`` bins per column: between all its values if they are that few,
    else where equal shares of the rows (``n`` of them each) end. They depend on the rows alone."""
    n = F.lit(1) if n is None else n
    xs = {c: F.col(c).cast("double") for c in cols}
    finite = {c: F.when(F.abs(x) < F.lit(math.inf), x) for c, x in xs.items()}  # NaN sorts above infinity
    found = df.agg(*[f(finite[c]).alias(f"{k}{i}") for i, c in enumerate(cols) for k, f in (
        ("lo", F.min), ("hi", F.max), ("d", F.approx_count_distinct))],
        *[F.sum(F.when(finite[c].isNotNull(), n)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    few = [i for i in range(len(cols)) if found[f"d{i}"] <= 2 * bins]
    values: dict[int, list[float]] = {i: [] for i in few}
    if few:
        entries = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), finite[cols[i]].alias("x")) for i in few])).alias("e")
        for r in df.select(entries).select("e.c", "e.x").filter("x IS NOT NULL").distinct().collect():
            values[r["c"]].append(r["x"])
    out = {}
    for i, c in enumerate(cols):
        if i in values and len(values[i]) <= bins:
            ordered = sorted(set(values[i]))
            halves = [(a / 2 + b / 2, a, b) for a, b in zip(ordered, ordered[1:])]
            out[c] = [m if a < m <= b else b for m, a, b in halves]
            continue
        share = found[f"n{i}"] / bins
        edges, below, following = [], 0, share
        for least, _, rows in _pieces(df, finite[c], n, found[f"lo{i}"], found[f"hi{i}"], share):
            if below >= following:
                edges.append(least)
                following = (below // share + 1) * share
            below += rows
        out[c] = edges
    return out


class TrainingFrame:
    """What fits read: the laid out rows with their feature vector (``frame``), and for families that
    see bins only the counted ``cells`` of the binned rows, both made when they are first asked for. As
    a context manager they are persisted (memory and disk) and released; lost blocks are placed anew,
    alike."""

    def __init__(self, df: DataFrame, features: list[str], label: str, weight: str | None, folds: int, rows_per_partition: int):
        self.assembler, self.features, self.label = _assembler(features), features, label
        self.weight, self.folds, self.rows_per_partition = weight, folds, rows_per_partition
        self._cols = [*features, label] + ([weight] if weight else [])
        self._df = df.select(*self._cols)
        self._held: list[DataFrame] | None = None
        self._made: dict = {}

    @classmethod
    def of(cls, df: DataFrame, features: list[str], label: str, weight: str | None = None, folds: int = 0,
           rows_per_partition: int = ROWS_PER_PARTITION) -> TrainingFrame:
        return cls(df, features, label, weight, folds, rows_per_partition)

    def __enter__(self) -> TrainingFrame:
        self._held = []
        return self

    def __exit__(self, *error) -> None:
        for frame in self._held:
            frame.unpersist()

    def _hold(self, frame: DataFrame) -> DataFrame:
        if self._held is None:
            return frame
        self._held.append(frame.persist(StorageLevel.MEMORY_AND_DISK))
        return self._held[-1]

    @cached_property
    def _copies(self) -> DataFrame:
        return _counted(self._df, self._cols)

    @cached_property
    def frame(self) -> DataFrame:
        rows = self.assembler.transform(_laid_out(self._copies, self._cols, ROWS_PASSES * self.rows_per_partition, self.folds))
        keep = [FEATURES, self.label, *([self.weight] if self.weight else []), ROW, *([FOLD] if self.folds else [])]
        return self._hold(rows.select(*keep))

    def binning(self, bins: int) -> list:
        """The stages from raw columns to the vector of bin numbers. They start from 1, the zeroth bin is
        empty: Spark ML takes the number of zeros from a sample's rest, and may miss them."""
        if bins not in self._made:
            counted = "_copies" in self.__dict__
            edges = bin_edges(self._copies if counted else self._df, self.features, max(2, bins - 1),
                              F.col("_copies") if counted else None)
            names = [f"_bin_{c}" for c in self.features]
            splits = [[-math.inf, -sys.float_info.max, *edges[c], math.inf] for c in self.features]
            self._made[bins] = [Bucketizer(splitsArray=splits, inputCols=self.features, outputCols=names), _assembler(names)]
        return self._made[bins]

    def _cells(self, bins: int, split: tuple | None) -> DataFrame:
        """Bins, label, weight and the cell's rows of every part (``_n0``, ``_n1``, ...)."""
        if ("cells", bins, split) not in self._made:
            rows, parts = self._df, [F.count(F.lit(1))]
            if split:
                rows = _numbered(self._copies, self._cols, self.rows_per_partition)
                kind, *how = split
                row = _row_hash(self._cols)
                part = _fold(row, *how) if kind == "cv" else _held_back(row, *how).cast("int")
                rows = rows.withColumn("_part", part)
                parts = [F.count_if(F.col("_part") == k) for k in range(how[0] if kind == "cv" else 2)]
            binned = self.binning(bins)[0].transform(rows)
            for c in self.features:  # bins are ordered numbers, not categories
                binned = binned.withMetadata(f"_bin_{c}", {"ml_attr": {"type": "numeric"}})
            cells = binned.groupBy(*self._by).agg(*[n.alias(f"_n{k}") for k, n in enumerate(parts)])
            self._made["cells", bins, split] = materialised(cells)
        return self._made["cells", bins, split]

    @property
    def _by(self) -> list[str]:
        return [*[f"_bin_{c}" for c in self.features], self.label, *([self.weight] if self.weight else [])]

    def cells(self, bins: int, split: tuple | None = None, bagged: bool = False, passes: int = 1) -> DataFrame:
        """The vector of bin numbers, label, weight and rows per part (``_n0``, ...) of every cell, laid
        out like rows. ``split`` is ("cv", folds) or ("tvs", ratio, seed). With ``bagged``, which no fit
        asks for (a ``Forest`` draws every row of a cell), a cell is dealt out in portions: of one row each
        up to ``BAGGED`` rows, of equally many rows beyond. ``passes``: as many times larger partitions."""
        key = ("laid", bins, split, bagged, passes)
        if key not in self._made:
            cells = self._cells(bins, split)
            parts = [c for c in cells.columns if c.startswith("_n")]
            total = F.expr(" + ".join(parts))
            if bagged:
                n_rows = cells.agg(F.sum(total)).first()[0] or 0
                size = max(1, -(-n_rows // BAGGED))
                cells = cells.withColumn("_portion", F.explode(F.expr(f"sequence(0L, ({' + '.join(parts)} - 1) div {size})")))
                ends, start, stop = {}, F.col("_portion") * size, (F.col("_portion") + 1) * size
                before = F.lit(0).cast("long")
                for c in parts:  # a cell's rows lie one part after the other
                    ends[c] = F.greatest(F.lit(0).cast("long"), F.least(stop, before + F.col(c)) - F.greatest(start, before))
                    before = before + F.col(c)
                cells = cells.withColumns(ends)
            else:
                cells = cells.withColumn("_portion", F.lit(0).cast("long"))
            partitions = max(1, -(-cells.count() // (passes * self.rows_per_partition)))
            placed = cells.repartition(partitions, *self._by, "_portion").sortWithinPartitions(*self._by, "_portion")
            keep = [FEATURES, self.label, *([self.weight] if self.weight else []), *parts]
            self._made[key] = self._hold(self.binning(bins)[1].transform(placed).select(*keep))
        return self._made[key]

    def weighted(self, cells: DataFrame, parts: list[int] | None = None, weight: bool = True) -> DataFrame:
        """The cells of these parts (all if None) with their rows and what they weigh in a fit."""
        counts = [c for c in cells.columns if c.startswith("_n") and c != N_ROWS]
        n = F.expr(" + ".join(counts if parts is None else [f"_n{k}" for k in parts]))
        rows = cells.withColumn(N_ROWS, n.cast("double")).filter(F.col(N_ROWS) > 0)
        each = F.col(self.weight) if weight and self.weight else F.lit(1.0)
        return rows.select(FEATURES, self.label, N_ROWS, (F.col(N_ROWS) * each).alias(WEIGHT))


def _bins(est) -> int:
    return est.getOrDefault("maxBins")


def _passes(family: str) -> int:
    """Trees of a forest are fits of their own, many at a time: each needs fewer tasks."""
    return ROWS_PASSES if family == "forest" else 1


def train(df: DataFrame, family: str, label: str, features: list[str], weight: str | None = None,
          params: dict | None = None, seed: int = 42, rows_per_partition: int = ROWS_PER_PARTITION) -> PipelineModel:
    """Fit one classifier on raw feature columns; labels must be 0..K-1 valued numbers.
    Returns assembler (of bins for trees) + model as one ``PipelineModel`` that scores raw columns."""
    with TrainingFrame.of(df, features, label, weight, rows_per_partition=rows_per_partition) as rows:
        if family not in BINNED:
            est = classifier(family, label, weight, seed, **(params or {}))
            return PipelineModel(stages=[rows.assembler, est.fit(rows.frame)])
        est = classifier(family, label, WEIGHT, seed, **(params or {}))
        cells = rows.weighted(rows.cells(_bins(est), passes=_passes(family)))
        return PipelineModel(stages=[*rows.binning(_bins(est)), est.fit(cells)])


def one_vs_rest(df: DataFrame, family: str, label: str, features: list[str],
                params: dict | None = None, seed: int = 42, rows_per_partition: int = ROWS_PER_PARTITION,
                parallelism: int = PARALLELISM) -> PipelineModel:
    """One-vs-rest over a binary base classifier (e.g. gradient-boosted trees)."""
    base = classifier(family, label, None, seed, **(params or {}))
    ovr = OneVsRest(classifier=base, featuresCol=FEATURES, labelCol=label, parallelism=parallelism)
    with TrainingFrame.of(df, features, label, rows_per_partition=rows_per_partition) as rows:
        if family not in BINNED:
            return PipelineModel(stages=[rows.assembler, ovr.fit(rows.frame)])
        ovr.setWeightCol(WEIGHT)
        base.rows = WEIGHT  # all that one-vs-rest hands on; a row's own weight is 1
        cells = rows.weighted(rows.cells(_bins(base), passes=_passes(family)))
        return PipelineModel(stages=[*rows.binning(_bins(base)), ovr.fit(cells)])


def param_grid(est, grid: dict[str, list]):
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), values)
    return b.build()


def _work(point) -> float:
    """How much a fit with these parameters has to do, for comparison: their product."""
    return math.prod(float(v) for p, v in point.items() if p.name in ("numTrees", "maxDepth", "maxBins", "maxIter"))


def tune(df: DataFrame | None, family: str, label: str, features: list[str], grid: dict[str, list],
         method: str = "cv", folds: int = 3, ratio: float = 0.9, parallelism: int = PARALLELISM,
         seed: int = 42, weight: str | None = None, metric: str = "accuracy",
         one_vs_rest_base: bool = False, fixed: dict | None = None,
         rows_per_partition: int = ROWS_PER_PARTITION, rows: TrainingFrame | None = None):
    """Grid search by k-fold cross-validation (``cv``) or a train/validation split (``tvs``).
    With ``one_vs_rest_base`` the classifier is wrapped in ``OneVsRest`` and the grid's
    parameters reach the per-class sub-models. ``rows``, a persisted training frame of ``df`` (which
    may then be None), is shared with other calls. Returns (best PipelineModel, metrics per grid
    point, in the order of the grid)."""
    if method not in ("cv", "tvs"):
        raise ValueError(f"unknown tuning method {method!r}")
    weight = None if one_vs_rest_base else weight
    if rows is None:
        with TrainingFrame.of(df, features, label, weight, folds if method == "cv" else 0, rows_per_partition) as own:
            return tune(None, family, label, features, grid, method, folds, ratio, parallelism, seed, weight, metric,
                        one_vs_rest_base, fixed, rows=own)
    if method == "cv" and rows.folds != folds:
        raise ValueError(f"the training frame has {rows.folds} folds, not {folds}")
    binned = family in BINNED
    est = classifier(family, label, WEIGHT if binned and not one_vs_rest_base else weight, seed, **(fixed or {}))
    points = param_grid(est, grid)
    target = (OneVsRest(classifier=est, featuresCol=FEATURES, labelCol=label)
              if one_vs_rest_base else est)
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                           metricName=metric)
    if binned:
        if one_vs_rest_base:
            target.setWeightCol(WEIGHT)
            est.rows = WEIGHT  # all that it hands on; a row's own weight is 1
        if metric == "logLoss":
            ev.setWeightCol(N_ROWS)
        bins = max(grid.get("maxBins", [_bins(est)]))
        split = ("cv", folds) if method == "cv" else ("tvs", ratio, seed)
        cells = rows.cells(bins, split, passes=_passes(family))
        wanted = [([j for j in range(folds) if j != k], [k]) for k in range(folds)] if method == "cv" else [([0], [1])]
        parts = [tuple(rows.weighted(cells, side, bool(weight)) for side in sides) for sides in wanted]
        whole, stages = rows.weighted(cells, None, bool(weight)), rows.binning(bins)
    else:
        whole, stages = rows.frame, [rows.assembler]
        if method == "cv":
            parts = [(whole.filter(F.col(FOLD) != k), whole.filter(F.col(FOLD) == k)) for k in range(folds)]
        else:
            held = _held_back(F.col(ROW), ratio, seed)
            parts = [(whole.filter(~held), whole.filter(held))]
    scores = _searched(target, points, ev, parts, parallelism)
    best = max(range(len(points)), key=lambda k: (scores[k], -k))  # the first of equals
    return PipelineModel(stages=[*stages, target.fit(whole, points[best])]), scores


def _limit(point: dict) -> tuple:
    """The point's limit on growth, None if it has none: the depth of trees, or the iterations of a
    logistic regression, which converges; and the rest of the point."""
    limits = {p: v for p, v in point.items() if p.name == "maxDepth" or (p.name == "maxIter" and "Logistic" in p.parent)}
    if len(limits) != 1:
        return None, tuple(sorted((p.name, v) for p, v in point.items()))
    (limit, value), = limits.items()
    return value, tuple(sorted((p.name, v) for p, v in point.items() if p != limit))


def _grown(model) -> float:
    """How far a fit grew: a point with a limit above it, and nothing else different, has the same fit."""
    if hasattr(model, "models"):  # one-vs-rest
        return max(_grown(m) for m in model.models)
    if hasattr(model, "trees"):
        return max(tree.depth for tree in model.trees)
    if hasattr(model, "depth"):
        return model.depth
    return model.summary.totalIterations + 1 if getattr(model, "hasSummary", False) else math.inf


def _cut(node, depth: int, kinds):
    """A tree's node with the tree below it as a fit of this depth has it: nodes at the limit are leaves,
    and two leaves that predict the same are one."""
    if node.subtreeDepth() <= depth:
        return node
    if depth:
        left, right = _cut(node.leftChild(), depth - 1, kinds), _cut(node.rightChild(), depth - 1, kinds)
        if left.subtreeDepth() or right.subtreeDepth() or left.prediction() != right.prediction():
            return kinds.InternalNode(node.prediction(), node.impurity(), node.gain(), left, right, node.split(), node.impurityStats())
    return kinds.LeafNode(node.prediction(), node.impurity(), node.impurityStats())


def _forest(like, trees: list) -> RandomForestClassificationModel:
    """The forest of these trees, with the columns and the kind of another one."""
    java, context = like._java_obj, SparkContext._active_spark_context
    ml = context._jvm.org.apache.spark.ml.classification
    grown = context._gateway.new_array(ml.DecisionTreeClassificationModel, len(trees))
    for k, tree in enumerate(trees):
        grown[k] = tree
    made = ml.RandomForestClassificationModel(java.uid(), grown, java.numFeatures(), java.numClasses())
    return RandomForestClassificationModel(made).setFeaturesCol(like.getFeaturesCol())


def _part_of(forest, trees: int, depth: int | None):
    """The forest of a forest's first trees, which are drawn and grown apart from each other, cut at a
    depth: how a node is split does not depend on the limit below it."""
    java, ml = forest._java_obj, SparkContext._active_spark_context._jvm.org.apache.spark.ml
    kind, size = ml.classification.DecisionTreeClassificationModel, (java.numFeatures(), java.numClasses())
    grown = list(java.trees())[:trees]
    return _forest(forest, [tree if depth is None or tree.depth() <= depth
                            else kind(tree.uid(), _cut(tree.rootNode(), depth, ml.tree), *size) for tree in grown])


def _score(evaluator, model, rows: DataFrame) -> float:
    """The model's score on validation rows, from the counted pairs of label and prediction."""
    if evaluator.getMetricName() == "logLoss":  # of probabilities
        return evaluator.evaluate(model.transform(rows))
    unused = {model.getParam(c): "" for c in ("rawPredictionCol", "probabilityCol") if model.hasParam("probabilityCol")}
    n = F.sum(N_ROWS) if N_ROWS in rows.columns else F.count(F.lit(1))
    pairs = model.transform(rows, unused).groupBy(evaluator.getLabelCol(), evaluator.getPredictionCol())
    return evaluator.evaluate(pairs.agg(n.cast("double").alias(N_ROWS)), {evaluator.weightCol: N_ROWS})


def _searched(target, points: list[dict], evaluator, parts: list[tuple[DataFrame, DataFrame]], parallelism: int) -> list[float]:
    """The mean score of every grid point over the (training, validation) parts. All fits of all parts
    go through one pool, the largest points first; the driver only holds their scores. Points that only
    differ in a limit on growth are fitted from the largest limit on: a fit that stayed within a smaller
    one is that point's fit as well. Forests that only differ in their number of trees are the first
    trees of the largest one, which alone is fitted, and one of at most ``WALKED`` nodes is cut at the
    smaller depths. Trees of all forests are fitted in one pool of their own."""
    spark = parts[0][0].sparkSession
    trees = [next((v for p, v in point.items() if p.name == "numTrees"), None)
             if isinstance(target, RandomForestClassifier) else None for point in points]
    chains: dict[tuple, dict] = {}
    for k, point in enumerate(points):
        limit, rest = _limit({p: v for p, v in point.items() if trees[k] is None or p.name != "numTrees"})
        chains.setdefault(rest, {}).setdefault(limit, []).append(k)

    def score(job):
        part, chain = job
        found, grown, scores, fitted = [], math.inf, {}, None
        for limit in sorted(chain, key=lambda limit: -(limit or 0)):
            if limit is None or grown > limit:
                largest = max(chain[limit], key=lambda k: trees[k] or 0)
                counts = dict.fromkeys(trees[k] for k in chain[limit])
                if fitted is None or trees[largest] is None or fitted.totalNumNodes > WALKED:
                    fitted = target.fit(parts[part][0], points[largest])
                    grown = math.inf if limit is None or len(chain) == 1 else _grown(fitted)
                whole = fitted if trees[largest] is None else _part_of(fitted, trees[largest], limit)
                scores = {n: _score(evaluator, whole if n is None else _part_of(whole, n, None), parts[part][1]) for n in counts}
            found.extend((part, k, scores[trees[k]]) for k in chain[limit])
        return found

    jobs = sorted(((part, chain) for chain in chains.values() for part in range(len(parts))),
                  key=lambda job: -sum(max(_work(points[k]) for k in ks) for ks in job[1].values()))
    total = [0.0] * len(points)
    with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool, ThreadPool(max(1, parallelism)) as of_trees:
        if isinstance(target, Forest):
            target = target.copy()
            target.pool = of_trees
        batches = list(pool.imap_unordered(inheritable_thread_target(spark)(score), jobs))
    for _, point, value in sorted(row for batch in batches for row in batch):  # one order of adding up
        total[point] += value / len(parts)
    return total


def predictions_table(model: PipelineModel, df: DataFrame, label: str, id_col: str,
                      model_name: str, version: int, dataset: str,
                      positive_index: int = 1) -> DataFrame:
    """Score ``df`` into the long predictions table (model, version, dataset, row_id, label,
    prediction, score); score = probability of class ``positive_index`` (NULL when the model
    has no probability output, e.g. one-vs-rest)."""
    scored = model.transform(df)
    score = (vector_element("probability", positive_index) if "probability" in scored.columns
             else F.lit(None).cast("double"))
    return scored.select(F.lit(model_name).alias("model"), F.lit(version).alias("version"),
                         F.lit(dataset).alias("dataset"), F.col(id_col).alias("row_id"),
                         F.col(label).cast("int").alias("label"),
                         F.col("prediction").cast("int").alias("prediction"),
                         score.alias("score"))


def train_suite(train_df: DataFrame, datasets: dict[str, DataFrame], families: dict[str, dict],
                label: str, features: list[str], id_col: str, version: int = 1,
                method: str = "cv", weight: str | None = None, folds: int = 3,
                ratio: float = 0.9, seed: int = 42, parallelism: int = PARALLELISM,
                rows_per_partition: int = ROWS_PER_PARTITION):
    """Tune every family on ``train_df``, all on one persisted training frame with the same folds, and
    score each named dataset. Returns ({name: model}, predictions table)."""
    models, preds = {}, None
    with TrainingFrame.of(train_df, features, label, weight, folds if method == "cv" else 0, rows_per_partition) as rows:
        for name, grid in families.items():
            models[name], _ = tune(None, name, label, features, grid, method=method, folds=folds, ratio=ratio, seed=seed,
                                   weight=weight, parallelism=parallelism, rows=rows)
    for name, model in models.items():
        for ds_name, ds in datasets.items():
            p = predictions_table(model, ds, label, id_col, name, version, ds_name)
            preds = p if preds is None else preds.unionByName(p)
    return models, preds


def pick_champion(metrics: DataFrame, order: list[str],
                  criteria=("accuracy", "f1_score", "roc_auc")) -> DataFrame:
    """Fold over candidates in training ``order``: the first is champion; a later one
    replaces it only if it is strictly better on EVERY criterion. Candidates are one row per
    trained model (a handful), so the fold runs on the collected rows."""
    rows = metrics.orderBy(*order).collect()
    champ = None
    for r in rows:
        if champ is None:
            champ = r
            continue
        if all(r[c] is not None and champ[c] is not None and r[c] > champ[c] for c in criteria):
            champ = r
    spark = metrics.sparkSession
    return spark.createDataFrame([champ] if champ else [], metrics.schema)


def train_and_pick(train_df: DataFrame, datasets: dict[str, DataFrame], families: dict[str, dict],
                   label: str, features: list[str], id_col: str, test_name: str = "test",
                   version: int = 1, method: str = "cv", weight: str | None = None,
                   folds: int = 3, seed: int = 42, parallelism: int = PARALLELISM,
                   rows_per_partition: int = ROWS_PER_PARTITION):
    """Train and tune every family, evaluate every scored dataset in one pass, and apply the
    champion rule on ``test_name`` in training order (binary labels, positive class 1). Without test
    rows nothing beats the first family. Returns (champion family, its model, long metrics,
    predictions)."""
    fitted, preds = train_suite(train_df, datasets, families, label, features, id_col,
                                version=version, method=method, weight=weight, folds=folds,
                                seed=seed, parallelism=parallelism, rows_per_partition=rows_per_partition)
    metrics = evaluate(preds, by=["model", "version", "dataset"])
    criteria = ["accuracy", "f1_score", "roc_auc"]
    wide = (metrics.filter(F.col("dataset") == F.lit(test_name))
            .groupBy("model").pivot("metric", criteria).agg(F.first("value")))
    position = F.create_map(*[x for i, name in enumerate(families)
                              for x in (F.lit(name), F.lit(i))])
    wide = wide.withColumn("_order", position[F.col("model")])
    found = pick_champion(wide, ["_order"]).collect()
    champ = found[0]["model"] if found else next(iter(families))
    return champ, fitted[champ], metrics, preds
