"""SentencePiece encoding and decoding as a max-plus parallel scan.

The best split of a text is a longest path over its positions, and path scores combine in the
max-plus algebra. A document longer than ``chunk_chars`` is cut into chunks of about that size. The
state at a boundary is how far the last piece reaches past it, 0 to L - 1 for pieces of at most L
characters; a boundary at a place that no piece spans has the single state 0, and a chunk's end is
moved back to such a place where it has one.

1. Every chunk yields its transfer matrix: the best score from each entry state to each exit state.
2. Matrices are combined associatively: products per block of ``BLOCK`` chunks, a scan over a
   document's blocks, a scan inside each block. That gives every chunk the best score of reaching
   each of its entry states.
3. From these scores every chunk computes, on its own, its back pointers and the map from exit
   state to entry state. The maps compose from the document's end (again per block, then over
   blocks), which fixes every chunk's exit state.
4. Every chunk follows its back pointers on its own; a document's ids are its chunks' in order.

A chunk between two single-state boundaries has a 1 x 1 matrix and is settled at step 1, so steps
2 and 3 run for chunks inside stretches without such places only. Scores are integers, so the
result is that of the sequential algorithm whatever the chunk size. Documents of one chunk need no
shuffle.

The installed model file is a merge-ranked one: its pieces and scores are used as they are as a
unigram vocabulary, which is what this method decodes. Decoding joins pieces and byte pieces.

Defined results: null and empty texts have no ids and decode to the empty text. U+2581 decodes as
a space. Rows that repeat an id keep ids of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written
from .unigram import Unigram, UnitIndex, load_pieces, vocabulary

CHUNK_CHARS = 32_768
#: Characters whose units are solved together.
BATCH_CHARS = 2_000_000
BLOCK = 64
_NONE = -(1 << 62)

_IDS = T.ArrayType(T.IntegerType(), False)


def _encode_texts(vocab: Unigram, texts: list[str], batch_chars: int) -> Iterator[np.ndarray]:
    """Ids of prepared texts; equal units of a batch are solved once."""
    start = 0
    while start < len(texts):
        index, held, size = UnitIndex(), [], 0
        while start < len(texts) and size < batch_chars:
            units = vocab.units(texts[start])
            held.append(np.fromiter(map(index.__getitem__, units), dtype=np.int64, count=len(units)))
            size += len(texts[start])
            start += 1
        counts, _, offsets, flat = vocab.solve(list(index))
        for numbers in held:
            n = counts[numbers]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(n) else 0
            yield flat[np.repeat(offsets[numbers] - (ends - n), n) + np.arange(total)]


def _list_array(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``limit`` bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, done = 0, 0
    while start < batch.num_rows:
        end = min(max(start + 1, int(np.searchsorted(ends, done + limit, side="right"))), batch.num_rows)
        yield batch.slice(start, end - start)
        start, done = end, ends[end - 1]


def _whole_encoder(loaded, batch_chars: int, decoded: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(loaded)
        for batch in batches:
            for part in _slices(batch, 1, batch_chars):
                texts = [vocab.prepared(t or "") for t in part.column(1).to_pylist()]
                ids = list(_encode_texts(vocab, texts, batch_chars))
                columns = [part.column(0), _list_array(ids), pa.array(np.ones(len(ids), np.int64))]
                names = ["id", "ids", "n_chunks"]
                if decoded:
                    columns.append(pa.array([vocab.decode(x.tolist()) for x in ids], pa.string()))
                    names.append("text")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return encode


def cut(vocab: Unigram, text: str, chunk_chars: int) -> Iterator[tuple[int, int, bool, bool]]:
    """(start, end, single-state entry, single-state exit) of the chunks of a prepared text. A chunk
    ends at the last place within its size that no piece spans, else at its size."""
    start, entry = 0, True
    while start < len(text):
        end = min(start + chunk_chars, len(text))
        safe = end == len(text)
        if not safe:
            # a unit boundary seen from the chunk's start holds for the text if another unit follows
            units = vocab.units(text[start:end + 1])
            if len(units) > 1 and (entry or len(units) > 2):
                end, safe = end + 1 - len(units[-1]), True
        yield start, end, entry, safe
        start, entry = end, safe


def _chunker(loaded, chunk_chars: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(loaded)
        reach = vocab.max_len - 1
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = vocab.prepared(text.as_py())
                chunks = [(row, k, text[a:b] if out else text[a:b + reach], b - a, entry, out)
                          for k, (a, b, entry, out) in enumerate(cut(vocab, text, chunk_chars))]
                for k in range(0, len(chunks), 64):
                    yield pa.RecordBatch.from_pylist([dict(zip(_CHUNK.names, c, strict=True)) for c in chunks[k:k + 64]],
                                                     schema=_CHUNK)

    return split


_CHUNK = pa.schema([("row", pa.int64()), ("k", pa.int64()), ("text", pa.string()), ("n", pa.int64()),
                    ("entry", pa.bool_()), ("exit", pa.bool_())])
_CHUNK_DDL = "row long, k long, text string, n long, entry boolean, exit boolean"


def _states(vocab: Unigram, single: bool) -> int:
    return 1 if single else vocab.max_len


def transfer(vocab: Unigram, text: str, n: int, entry: bool, exit: bool) -> np.ndarray:
    """Best score from each entry state to each exit state of a chunk of ``n`` characters."""
    rows, cols = _states(vocab, entry), _states(vocab, exit)
    matrix = np.full((rows, cols), _NONE, dtype=np.int64)
    for s in range(min(rows, n + 1)):
        best, _ = vocab.forward(text, [_NONE] * s + [0], n)
        for t in range(cols):
            if n + t < len(best):
                matrix[s, t] = best[n + t]
    return matrix


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    sums = a[:, :, None] + b[None, :, :]
    sums[(a[:, :, None] <= _NONE // 2) | (b[None, :, :] <= _NONE // 2)] = _NONE
    return sums.max(axis=1)


def _through(v: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    return times(v[None, :], matrix)[0]


def _pack(matrix: np.ndarray) -> bytes:
    return np.int32(matrix.shape[0]).tobytes() + matrix.astype(np.int64).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    rows = int(np.frombuffer(raw[:4], dtype=np.int32)[0])
    return np.frombuffer(raw[4:], dtype=np.int64).reshape(rows, -1)


def _first_pass(loaded, batch_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(loaded)
        for batch in batches:
            for part in _slices(batch, 2, batch_chars):
                rows = part.to_pylist()
                settled = [r for r in rows if r["entry"] and r["exit"]]
                for r, ids in zip(settled, _encode_texts(vocab, [r["text"] for r in settled], batch_chars), strict=True):
                    r["ids"], r["text"] = ids, None
                for r in rows:
                    if "ids" not in r:
                        r["matrix"] = _pack(transfer(vocab, r["text"], r["n"], r["entry"], r["exit"]))
                yield pa.RecordBatch.from_pylist([{f.name: r.get(f.name) for f in _FIRST} for r in rows], schema=_FIRST)

    return run


_FIRST = pa.schema([*_CHUNK, ("ids", pa.list_(pa.int32())), ("matrix", pa.binary())])
_FIRST_DDL = f"{_CHUNK_DDL}, ids array<int>, matrix binary"


def _block_product(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    ordered = table.sort_by("k")
    out = _unpack(ordered.column("matrix")[0].as_py())
    for raw in ordered.column("matrix")[1:]:
        out = times(out, _unpack(raw.as_py()))
    return pa.table({"row": [key[0].as_py()], "run": [key[1].as_py()], "block": [key[2].as_py()], "matrix": [_pack(out)]})


def _scan(table: pa.Table, order: str, entry: np.ndarray) -> list[bytes]:
    """Entry scores of every element of the sorted table."""
    out, v = [], entry
    for raw in table.column("matrix"):
        out.append(_pack(v[None, :]))
        v = _through(v, _unpack(raw.as_py()))
    return out


def _scan_blocks(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    ordered = table.sort_by("block")
    start = np.zeros(1, dtype=np.int64)  # a run begins at a single-state boundary
    return pa.table({"row": ordered["row"], "run": ordered["run"], "block": ordered["block"],
                     "entering": pa.array(_scan(ordered, "block", start), pa.binary())})


def _scan_chunks(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    ordered = table.sort_by("k")
    start = _unpack(ordered["entering"][0].as_py())[0]
    return ordered.drop_columns(["matrix", "entering"]).append_column(
        "entering", pa.array(_scan(ordered, "k", start), pa.binary()))


def _back_pointers(loaded):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(loaded)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                v = _unpack(r["entering"])[0]
                best, back = vocab.forward(r["text"], [int(x) for x in v], r["n"])
                came = []
                for t in range(_states(vocab, r["exit"])):
                    end = r["n"] + t
                    reached = end < len(best) and back[end] != -2
                    while reached and back[end] >= 0:
                        end = back[end]
                    came.append(end if reached else -1)
                # a position's piece start, as a distance; 255: entered here or not reached
                steps = bytes(i - b if b >= 0 and i - b < 255 else 255 for i, b in enumerate(back))
                out.append({**{k: r[k] for k in ("row", "run", "block", "k", "text", "n")}, "steps": steps,
                            "came": came})
            yield pa.RecordBatch.from_pylist(out, schema=_BACK)

    return run


_BACK = pa.schema([("row", pa.int64()), ("run", pa.int64()), ("block", pa.int64()), ("k", pa.int64()),
                   ("text", pa.string()), ("n", pa.int64()), ("steps", pa.binary()), ("came", pa.list_(pa.int32()))])
_BACK_DDL = "row long, run long, block long, k long, text string, n long, steps binary, came array<int>"


def _compose_block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Exit state of the block's last chunk -> entry state of its first."""
    maps = table.sort_by([("k", "descending")]).column("came").to_pylist()
    out = list(range(len(maps[0])))
    for m in maps:
        out = [m[s] if 0 <= s < len(m) else -1 for s in out]
    return pa.table({"row": [key[0].as_py()], "run": [key[1].as_py()], "block": [key[2].as_py()],
                     "came": pa.array([out], pa.list_(pa.int32()))})


def _exits(table: pa.Table, order: str, last: int) -> pa.Array:
    """Exit state of every element, from the last one's, of the table sorted descending."""
    out, state = [], last
    for m in table.column("came").to_pylist():
        out.append(state)
        state = m[state]
    return pa.array(out, pa.int32())


def _exit_blocks(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    ordered = table.sort_by([("block", "descending")])
    return ordered.drop_columns(["came"]).append_column("leaving", _exits(ordered, "block", 0))


def _exit_chunks(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    ordered = table.sort_by([("k", "descending")])
    states = _exits(ordered, "k", ordered["leaving"][0].as_py())
    return ordered.drop_columns(["came", "leaving"]).append_column("leaving", states)


def _follow(loaded):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(loaded)
        for batch in batches:
            ids = []
            for r in batch.to_pylist():
                back = [i - d if d != 255 else -1 for i, d in enumerate(r["steps"])]
                ids.append(np.array(vocab.path(r["text"], back, r["n"] + r["leaving"])[0], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("k"), _list_array(ids)],
                                             names=["row", "k", "ids"])

    return run


def _resolve(open_chunks: DataFrame, loaded) -> DataFrame:
    """(row, k, ids) of chunks with more than one boundary state."""
    runs = open_chunks.withColumn("block", F.floor(F.col("k") / BLOCK))
    # a run of linked chunks is closed by a single-state exit; blocks do not cross runs
    by_block = ["row", "run", "block"]
    products = runs.select(*by_block, "k", "matrix").groupBy(*by_block).applyInArrow(
        _block_product, "row long, run long, block long, matrix binary")
    entering = products.groupBy("row", "run").applyInArrow(
        _scan_blocks, "row long, run long, block long, entering binary")
    chunks = runs.select(*by_block, "k", "text", "n", "exit", "matrix").join(entering, by_block)
    scanned = chunks.groupBy(*by_block).applyInArrow(
        _scan_chunks, "row long, run long, block long, k long, text string, n long, exit boolean, entering binary")
    pointers = written(scanned.mapInArrow(_back_pointers(loaded), _BACK_DDL), "scan_back_pointers")
    maps = pointers.select(*by_block, "k", "came")
    leaving = (maps.groupBy(*by_block).applyInArrow(_compose_block, "row long, run long, block long, came array<int>")
               .groupBy("row", "run").applyInArrow(_exit_blocks, "row long, run long, block long, leaving int"))
    states = maps.join(leaving, by_block).groupBy(*by_block).applyInArrow(
        _exit_chunks, "row long, run long, block long, k long, leaving int")
    return (pointers.select("row", "k", "text", "n", "steps").join(states.select("row", "k", "leaving"), ["row", "k"])
            .mapInArrow(_follow(loaded), "row long, k long, ids array<int>"))


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           chunk_chars: int = CHUNK_CHARS, batch_chars: int = BATCH_CHARS, decoded: bool = False) -> DataFrame:
    """(id, ids, n_chunks) of every document; with ``decoded`` also the text that its ids decode to
    (documents of one chunk are decoded in the pass that encodes them)."""
    spark = docs.sparkSession
    loaded = spark.sparkContext.broadcast({"path": model_path, **load_pieces(model_path)})
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    giant = F.length("text") >= chunk_chars
    schema = T.StructType([slim.schema["id"], T.StructField("ids", _IDS), T.StructField("n_chunks", T.LongType())])
    if decoded:
        schema = schema.add("text", T.StringType())
    small = slim.filter(~F.coalesce(giant, F.lit(False))).mapInArrow(_whole_encoder(loaded, batch_chars, decoded), schema)
    giants = written(slim.filter(giant).withColumn("row", F.monotonically_increasing_id()), "scan_giants")
    chunks = (giants.select("row", "text").mapInArrow(_chunker(loaded, chunk_chars), _CHUNK_DDL)
              .repartition("row", "k").mapInArrow(_first_pass(loaded, batch_chars), _FIRST_DDL))
    chunks = written(chunks, "scan_chunks")
    parts = chunks.filter("ids is not null").select("row", "k", "ids")
    still_open = chunks.filter("ids is null")
    if not still_open.isEmpty():
        # number the runs of linked chunks: a chunk entered at a single-state boundary starts one
        heads = (still_open.filter("entry").groupBy("row").agg(F.sort_array(F.collect_list("k")).alias("heads")))
        runs = still_open.join(heads, "row").withColumn(
            "run", F.array_max(F.filter("heads", lambda h: h <= F.col("k")))).drop("heads")
        parts = parts.unionByName(_resolve(runs, loaded))
    whole = parts.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("chunks"))
    large = giants.select("id", "row").join(whole, "row").select(
        "id", F.flatten(F.transform("chunks", lambda c: c["ids"])).alias("ids"),
        F.size("chunks").cast("long").alias("n_chunks"))
    return small.unionByName(decode(large, model_path) if decoded else large)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Adds the text of ``ids_col`` (null: empty)."""
    spark = encoded.sparkSession
    loaded = spark.sparkContext.broadcast({"path": model_path, **load_pieces(model_path)})
    schema = T.StructType([*encoded.schema.fields, T.StructField(text_col, T.StringType())])
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(loaded)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [vocab.decode(ids or []) for ids in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=[*part.schema.names, text_col])

    return encoded.mapInArrow(run, schema)
