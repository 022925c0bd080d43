"""Token counts by trie-shared dynamic programming.

Pre-tokens are the units of ``unigram``: stretches that no piece spans. A task takes in documents
up to ``BATCH_CHARS`` characters at a time, inserts their distinct pre-tokens in a trie, computes
the unigram forward scores once for every shared prefix, stores the token count at each terminal
and adds the counts up per document. Nothing is shuffled; memory is bounded by the batch (a longer
document is walked in stretches, its count is a sum).

Defined results: null and empty texts have 0 tokens. Repeated rows are counted alike. An empty
table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .unigram import UnitIndex, load_pieces, vocabulary

#: Characters whose pre-tokens share one trie.
BATCH_CHARS = 8_000_000


def stretches(units: list[str], limit: int) -> Iterator[list[str]]:
    """Consecutive units of about ``limit`` characters together."""
    start, size = 0, 0
    for k, unit in enumerate(units):
        size += len(unit)
        if size >= limit:
            yield units[start:k + 1]
            start, size = k + 1, 0
    if start < len(units):
        yield units[start:]


def _counter(loaded, batch_chars: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(loaded)
        for batch in batches:
            total = np.zeros(batch.num_rows, dtype=np.int64)
            index, held, size = UnitIndex(), [], 0

            def settle():
                if index:
                    counts = vocab.solve(list(index), want_ids=False)[0]
                    for row, numbers in held:
                        total[row] += counts[numbers].sum()

            for row, text in enumerate(batch.column(1)):
                for part in stretches(vocab.units(vocab.prepared(text.as_py() or "")), batch_chars):
                    numbers = np.fromiter(map(index.__getitem__, part), dtype=np.int64, count=len(part))
                    held.append((row, numbers))
                    size += sum(map(len, part)) if len(part) < 64 else len(part) * 6
                    if size >= batch_chars:
                        settle()
                        index, held, size = UnitIndex(), [], 0
            settle()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total)], names=["id", "n_tokens"])

    return count


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 batch_chars: int = BATCH_CHARS) -> DataFrame:
    """(id, n_tokens) of every document under the vocabulary at ``model_path`` (read by the driver,
    broadcast: its size is the vocabulary's)."""
    loaded = docs.sparkSession.sparkContext.broadcast({"path": model_path, **load_pieces(model_path)})
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([slim.schema["id"], T.StructField("n_tokens", T.LongType())])
    return slim.mapInArrow(_counter(loaded, batch_chars), schema)
