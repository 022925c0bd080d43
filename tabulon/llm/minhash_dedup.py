"""Near-duplicate components by MinHash with sequential Bayesian verification.

1. *Signatures.* One pass over the whole texts gives every document's number of distinct shingles, a
   128-bit digest of its set and ``HASHES`` minimum hashes. Of equal sets the document with the
   smallest id stands for all.
2. *Bands.* ``ROWS`` consecutive minima are a key; documents that share one of the ``BANDS`` keys are
   candidates. Two sets of similarity s share none with probability ``(1 - s**ROWS)**BANDS``: 7e-9 at
   0.85. Keys that nobody shares are left out before anything is joined.
3. *Sequential verification.* A byte of each minimum is the sketch. Sketches of candidates are
   compared ``BATCH`` minima at a time. With m of n equal bytes and a uniform prior, the posterior
   probability that the similarity reaches the threshold is a binomial tail; as soon as it is below
   ``MISS`` the pair is left (bytes that agree by chance are in the bound). Over all batches a pair
   exactly at the threshold is lost with a probability below 2e-5, a more similar one with less.
4. Survivors are verified exactly, on their whole sets, by ``near_groups``, which never forms the
   pairs of a group as rows, however large it is. Verified links are joined to components.

So every returned link is true, and one is lost with the probabilities above at most; a component
only falls apart if all links between its parts are lost.

Defined results: null and empty texts, and texts without words, have no shingles and are linked with
nothing. A text of fewer words than a shingle has its whole sequence as its one shingle. Ids are
whole numbers; a row without an id keeps a null component, is linked with nothing and is kept. Rows
that repeat an id are the same document, with the same component, and are kept alike (if their texts
differ, links of either may count). An empty table gives an empty result. Only the id and the text are read, so further
columns of any name do not matter. A text is split into words a piece at a time; its word hashes and
shingles (some forty bytes of memory for a word) are held whole, by one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .near_groups import Rule, components, restrict
from .shingles import U, mix, shingle_sets, text_batches

WIDTH = 3
#: Links have 100 * intersection >= SIMILARITY * union.
SIMILARITY = 85
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Minima that are compared before the posterior is looked at again.
BATCH = 32
#: Posterior probability of a link below which a pair is left.
MISS = 1e-6
#: Bytes of text that are worked on at once (some sixty bytes of memory for each).
BATCH_BYTES = 1_500_000
#: Shingles whose hashes are taken at once; they stay in the processor's cache.
CACHED = 1 << 15


def least_matches(n: int, similarity: float, miss: float) -> int:
    """The smallest number of equal bytes among n with which the posterior probability that the
    share of equal bytes reaches that of ``similarity`` is at least ``miss``. With a uniform prior the
    posterior is Beta(m + 1, n - m + 1), whose upper tail is P(Binomial(n + 1, share) <= m)."""
    share = similarity + (1 - similarity) / 256  # unequal minima agree in their byte by chance
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * share ** m * (1 - share) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n


def minima(owner: np.ndarray, hashed: np.ndarray, n_sets: int) -> np.ndarray:
    """Sets x ``HASHES`` minimum hashes of sorted sets (text number, hash); empty sets have zeros."""
    factors = np.random.default_rng(13).integers(0, 1 << 63, HASHES, dtype=U) * U(2) + U(1)
    sizes = np.bincount(owner, minlength=n_sets)
    ends = np.cumsum(sizes)
    out = np.full((n_sets, HASHES), ~U(0))
    with np.errstate(over="ignore"):
        for a in range(0, len(hashed), CACHED):
            part = hashed[a:a + CACHED]
            begins = np.flatnonzero(np.diff(owner[a:a + CACHED], prepend=-1))
            sets = owner[a + begins]
            for k in range(HASHES):
                least = np.minimum.reduceat(part * factors[k], begins)
                out[sets, k] = np.minimum(out[sets, k], least)
    out[ends == ends - sizes] = 0
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """Sets x ``BANDS`` keys of the bands."""
    with np.errstate(over="ignore"):
        key = mix(np.arange(1, BANDS + 1, dtype=U) * U(0x9E3779B97F4A7C15))[None, :]
        for r in range(ROWS):
            key = mix(key ^ least[:, r::ROWS]) + U(r)
        return key


def _describe(width: int):
    """(id, n, digest_a, digest_b, sketch, bands) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in text_batches(batch, 1, BATCH_BYTES):
                owner, hashed = shingle_sets(raw, offsets, width)
                n = np.bincount(owner, minlength=b - a)
                least = minima(owner, hashed, b - a)
                with np.errstate(over="ignore"):
                    digests, ends = [], np.cumsum(n)
                    for seed in (U(0x243F6A8885A308D3), U(0x13198A2E03707344)):
                        sums = np.concatenate([[U(0)], np.cumsum(mix(hashed ^ seed))])
                        digests.append((sums[ends] - sums[ends - n]).view(np.int64))
                    sketch = (mix(least) >> U(56)).astype(np.uint8)
                keys = band_keys(least).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)), *map(pa.array, digests),
                     pa.array([s.tobytes() for s in sketch], pa.binary()), lists],
                    names=["id", "n", "digest_a", "digest_b", "sketch", "bands"])

    return run


def _matrix(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), dtype=np.uint8).reshape(len(sketches), -1)


def sequential(similarity: float, miss: float, batch: int = BATCH):
    """The test of one sketch, or as many as there are others, against others, batch by batch."""
    least = {n: least_matches(n, similarity, miss) for n in range(batch, HASHES + 1, batch)}

    def may_link(one, n, others, sizes):
        alive, equal = np.arange(len(others)), np.zeros(len(others), dtype=np.int64)
        for upto, matches in least.items():
            cut = slice(upto - batch, upto)
            own = one[cut] if one.ndim == 1 else one[alive, cut]
            equal = equal + (others[alive, cut] == own).sum(axis=1)
            stay = equal >= matches
            alive, equal = alive[stay], equal[stay]
        out = np.zeros(len(others), dtype=bool)
        out[alive] = True
        return out

    return may_link


def _set_rows(width: int):
    """(id, shingles) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in text_batches(batch, 1, BATCH_BYTES):
                owner, hashed = shingle_sets(raw, offsets, width)
                cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=b - a))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(hashed.view(np.int64)))], names=["id", "shingles"])

    return run


def candidate_groups(documents: DataFrame) -> DataFrame:
    """(grp, id, n, probes) of documents (id, n, bands) that share a band's key. Groups with the same
    members are one."""
    keyed = documents.select("id", "n", F.explode("bands").alias("grp"))
    names = [F.bit_xor(F.xxhash64("id", F.lit(k))) for k in (1, 2)]
    shared = (keyed.groupBy("grp").agg(F.count("*").alias("size"), names[0].alias("x"), names[1].alias("y"))
              .filter("size > 1").groupBy("size", "x", "y").agg(F.min("grp").alias("id")).select("id"))
    shared = written(shared, "minhash_shared")
    return (restrict(keyed.withColumnsRenamed({"id": "doc", "grp": "id"}), shared, "semi")
            .select(F.col("id").alias("grp"), F.col("doc").alias("id"), "n", F.lit(True).alias("probes")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    similarity: int = SIMILARITY, miss: float = MISS) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable by links), kept
    (the id is its component's; rows without an id are)."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    described = written(slim.mapInArrow(_describe(width), "id long, n long, digest_a long, digest_b long, "
                                        "sketch binary, bands array<long>"), "minhash_sets")
    known = described.filter("n > 0 and id is not null")
    digest = ["n", "digest_a", "digest_b"]
    classes = written(known.groupBy(*digest).agg(F.min("id").alias("rep")), "minhash_classes")
    reps = (known.join(classes, digest).filter("id = rep")
            .select("id", "n", "bands").dropDuplicates(["id"]))  # rows that repeat an id
    groups = written(candidate_groups(written(reps, "minhash_reps")), "minhash_groups")
    members = written(groups.select("id").distinct(), "minhash_members")
    sketches = written(restrict(described.select("id", "sketch"), members, "semi"), "minhash_sketches")
    sets = written(restrict(slim, members, "semi").mapInArrow(_set_rows(width), "id long, shingles array<long>"),
                   "minhash_shingles")
    rule = Rule(num=similarity, den=100, matrix=_matrix, may_link=sequential(similarity / 100, miss), prune_centres=True)
    found = components(groups, sketches, sets, rule).withColumnRenamed("id", "rep")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id"))
    return (described.select("id", *digest).join(classes, digest, "left").join(found, "rep", "left")
            .select("id", F.col("n").alias("n_shingles"), component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))))
