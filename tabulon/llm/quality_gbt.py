"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every whole text (shares of character kinds, word lengths, repetition of words,
3-word windows and lines) are computed in tasks with numpy and written once. The trees are fitted on
labelled rows that are not held out: at most ``TRAIN_ROWS`` of them, those with the smallest hashes
of their ids, so that the driver's part is bounded at any input size. Statistics are put in at most
``BINS`` quantile bins; each level of a tree takes one histogram of gradients and curvatures per
statistic. Trees are complete and flattened into arrays (statistic and limit per inner node, value
per leaf), which are broadcast; scoring walks all trees of a batch at once, one numpy step a level.

Labels, language, source and id are never inputs of a score; the id only decides the fold.

Defined results: null and empty texts have statistics 0 and get a score. A null id is not held out.
Null labels are not learnt from; without labels every score is 0.5. Repeated rows score alike. An
empty table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written
from .shingles import U, span_hashes, text_batches, words_of

TRAIN_ROWS = 50_000
TREES, DEPTH, RATE, BINS, RIDGE, MIN_CURVATURE = 60, 4, 0.15, 64, 1.0, 2.0
BATCH_BYTES = 4_000_000
#: Kinds of characters whose shares are statistics.
KINDS = {"upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "symbol": "#*$%&|<>@^~\\{}[]=+_",
         "exclaim": "!", "question": "?", "stop": ".", "comma": ",;:", "quote": "\"'()-", "line": "\n"}
STATISTICS = [*KINDS, "beyond_ascii", "log_bytes", "log_words", "word_bytes", "word_spread", "short_words",
              "long_words", "distinct_words", "distinct_windows", "distinct_lines", "words_per_line",
              "words_per_stop", "shouted_words"]


def _distinct(owner: np.ndarray, hashed: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes per owner."""
    order = np.lexsort((hashed, owner))
    owner, hashed = owner[order], hashed[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashed[1:] != hashed[:-1])
    return np.bincount(owner[new], minlength=n)


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` for every text (its bytes are ``raw[offsets[k]:offsets[k + 1]]``)."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    out = np.zeros((n, len(STATISTICS)), dtype=np.float32)
    if not len(raw):
        return out
    col = {name: k for k, name in enumerate(STATISTICS)}
    kind = np.zeros(256, dtype=np.uint8)
    for k, chars in enumerate(KINDS.values()):
        kind[[ord(c) for c in chars]] = k + 1
    kind[128:] = len(KINDS) + 1
    text_of = np.repeat(np.arange(n), np.diff(offsets))
    width = len(KINDS) + 2
    counts = np.bincount(text_of * width + kind[raw], minlength=n * width).reshape(n, width)
    per_byte = np.divide(counts, size[:, None], out=np.zeros(counts.shape), where=size[:, None] > 0)
    out[:, :len(KINDS) + 1] = per_byte[:, 1:]
    a, b, owner, hashed = words_of(raw, offsets, lower=False)
    words = np.bincount(owner, minlength=n).astype(np.float64)
    some = np.maximum(words, 1)
    length = (b - a).astype(np.float64)
    mean = np.bincount(owner, length, n) / some
    out[:, col["log_bytes"]], out[:, col["log_words"]] = np.log1p(size), np.log1p(words)
    out[:, col["word_bytes"]] = mean
    out[:, col["word_spread"]] = np.sqrt(np.maximum(np.bincount(owner, length ** 2, n) / some - mean ** 2, 0))
    out[:, col["short_words"]] = np.bincount(owner, length <= 3, n) / some
    out[:, col["long_words"]] = np.bincount(owner, length >= 14, n) / some
    out[:, col["distinct_words"]] = _distinct(owner, hashed, n) / some
    with np.errstate(over="ignore"):
        if len(hashed) > 2:
            same = owner[2:] == owner[:-2]
            windows = (hashed[:-2] * U(3) + hashed[1:-1]) * U(5) + hashed[2:]
            held = np.maximum(np.bincount(owner[2:][same], minlength=n), 1)
            out[:, col["distinct_windows"]] = _distinct(owner[2:][same], windows[same], n) / held
    breaks = np.flatnonzero(raw == 10)
    begin = np.unique(np.concatenate([offsets[:-1][size > 0], breaks + 1]))
    begin = begin[begin < len(raw)]
    line_of = np.searchsorted(offsets, begin, side="right") - 1
    end = np.minimum(np.append(begin[1:], len(raw)), offsets[line_of + 1])
    full = end - begin > 1  # more than a line end
    lines = np.maximum(np.bincount(line_of[full], minlength=n), 1)
    out[:, col["distinct_lines"]] = _distinct(line_of[full], span_hashes(raw, begin[full], end[full]), n) / lines
    out[:, col["words_per_line"]] = words / lines
    out[:, col["words_per_stop"]] = words / (1 + counts[:, 1 + list(KINDS).index("stop")])
    upper = np.concatenate([[0], np.cumsum(kind[raw] == 1)])
    out[:, col["shouted_words"]] = np.bincount(owner, (upper[b] - upper[a]) * 2 > length, n) / some
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, raw, offsets in text_batches(batch, 1, BATCH_BYTES):
            rows = statistics(raw, offsets)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)),
                                             pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["id", "x"])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the statistics of every document."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([slim.schema["id"], T.StructField("x", T.ArrayType(T.FloatType()))])
    return slim.mapInArrow(_describe, schema)


def held_out(id_col: str | Column) -> Column:
    """The fold that is never learnt from: crc32 of the id as text, modulo 3, is 1."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Trees:
    """Complete trees as arrays: node k's children are 2k + 1 and 2k + 2; a row goes right if its
    statistic is above the limit."""

    def __init__(self, prior: float, depth: int = DEPTH):
        self.prior, self.depth = prior, depth
        self.statistic = np.zeros((0, 2 ** depth - 1), dtype=np.int32)
        self.limit = np.zeros((0, 2 ** depth - 1), dtype=np.float32)
        self.leaf = np.zeros((0, 2 ** depth), dtype=np.float64)

    def add(self, statistic: np.ndarray, limit: np.ndarray, leaf: np.ndarray) -> None:
        self.statistic = np.vstack([self.statistic, statistic])
        self.limit = np.vstack([self.limit, limit])
        self.leaf = np.vstack([self.leaf, leaf])

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.leaf))[None, :]
        node = np.zeros((len(x), len(self.leaf)), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.statistic[trees, node]] > self.limit[trees, node])
        total = self.prior + self.leaf[trees, node - (2 ** self.depth - 1)].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Boosted trees for logistic loss from histograms of binned statistics."""
    rate_of_ones = (y.sum() + 0.5) / (len(y) + 1.0)
    model = Trees(float(np.log(rate_of_ones / (1 - rate_of_ones))) if len(y) else 0.0, depth)
    if len(y) < 2 or y.min() == y.max():
        return model
    n, width = x.shape
    edges, binned = [], np.zeros((width, n), dtype=np.int64)
    for k in range(width):
        cuts = np.unique(np.quantile(x[:, k], np.arange(1, BINS) / BINS, method="lower").astype(np.float32))
        edges.append(cuts)
        binned[k] = np.searchsorted(cuts, x[:, k], side="left")  # bin b: above cuts[b - 1], up to cuts[b]
    margin = np.full(n, model.prior)
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        statistic = np.zeros(2 ** depth - 1, dtype=np.int32)
        limit = np.full(2 ** depth - 1, np.inf, dtype=np.float32)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, nodes = 2 ** level - 1, 2 ** level
            own = node - first
            gain = np.full(nodes, 1e-9)
            split = np.full((nodes, 2), -1)
            for k in range(width):
                if not len(edges[k]):
                    continue
                place = own * BINS + binned[k]
                left_g = np.bincount(place, g, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
                left_h = np.bincount(place, h, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                right_g, right_h = all_g - left_g, all_h - left_h
                value = (left_g ** 2 / (left_h + RIDGE) + right_g ** 2 / (right_h + RIDGE)
                         - all_g ** 2 / (all_h + RIDGE))
                value[(left_h < MIN_CURVATURE) | (right_h < MIN_CURVATURE)] = 0
                value = value[:, :len(edges[k])]
                best = value.argmax(axis=1)
                top = value[np.arange(nodes), best]
                better = top > gain
                gain[better] = top[better]
                split[better, 0], split[better, 1] = k, best[better]
            right = np.zeros(n, dtype=np.int64)
            for j in range(nodes):
                k, cut = split[j]
                if k >= 0:
                    statistic[first + j], limit[first + j] = k, edges[k][cut]
                    inside = own == j
                    right[inside] = binned[k][inside] > cut
            node = 2 * node + 1 + right
        own = node - (2 ** depth - 1)
        leaf = rate * np.bincount(own, g, 2 ** depth) / (np.bincount(own, h, 2 ** depth) + RIDGE)
        model.add(statistic, limit, leaf)
        margin += leaf[own]
    return model


def training_rows(described: DataFrame, labels: DataFrame, label_col: str, id_col: str,
                  limit: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``limit`` labelled rows outside the held-out fold, those
    with the smallest hashes of their ids: the same ones in every run."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
             .filter("id is not null and y is not null").filter(~held_out("id")))
    order = [F.xxhash64("id"), F.col("id"), F.col("y")]
    # the bounded rows first, then their statistics
    chosen = known.orderBy(*order).limit(limit)
    rows = described.join(chosen, "id").orderBy(*order).select("x", "y").toArrow()
    if not rows.num_rows:
        return np.zeros((0, len(STATISTICS)), dtype=np.float32), np.zeros(0)
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    return x, rows.column("y").to_numpy()


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(id, held_out, score) of every document."""
    described = written(document_statistics(docs, id_col, text_col), "quality_statistics")
    # plain arrays: a broadcast is pickled by reference, and workers need not have this package
    model = docs.sparkSession.sparkContext.broadcast(vars(fit(*training_rows(described, labels, label_col, id_col, train_rows))))
    schema = T.StructType([described.schema["id"], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees(0.0)
        vars(trees).update(model.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                x = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(trees.scores(x))], names=["id", "score"])

    return described.mapInArrow(score, schema).select("id", held_out("id").alias("held_out"), "score")
