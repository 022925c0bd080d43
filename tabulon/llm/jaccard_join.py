"""Near-duplicate join on word shingles, exact, by universe partitioning.

Two sets r, s with |s| <= |r| have a Jaccard similarity of at least 0.8 only if |r| * 0.8 <= |s|
and their symmetric difference is at most (|r| + |s|) / 9.

1. *Equal sets first.* Every document's set size and 128-bit set digest are written (a slim
   table); of equal sets the document with the smallest id stands for all.
2. *Size bands and segments.* Sizes fall in bands that grow by a quarter. A band has a fixed number
   of segments, and a shingle's hash says in which segment it lies, so a set is split into disjoint
   segments of about four shingles.
3. *Pigeonhole.* A set probes its own band and the bands below that can hold a partner. If the
   difference is at most H, then among segments with allowances v_i that add up to H + 1 one pair
   differs in fewer than v_i places: v = 1 asks for an equal segment, v = 2 for one that is equal or
   one shingle apart. Equal segments have equal keys; a segment one apart meets in the one-deletion
   neighbourhood, the keys of the segment without one of its shingles.
4. *Candidates.* Every set's segment keys go to buckets as packed arrays, are sorted there, and
   yield the groups of documents that share a key. A key that many documents of one batch share is
   combined before the shuffle. Groups with the same members are one, with a multiplicity.
5. *Allocation by cost.* A set of l shingles needs to probe about 0.22 l of its 0.28 l segments, and
   it is free to choose. The cost of a segment is the length of its key's list, now known: segments
   whose key nobody shares cost nothing and come first, then the shortest lists, so a set probes long
   lists (a common passage, a common line) only if it has to, and a set with enough unshared
   segments probes nothing. Where too few segments have shingles, some are raised to v = 2, at the
   cost of one more key per shingle. Sets index all their segments, and the neighbourhoods of the
   segments that may be raised: all in bands of few segments, ``RESERVE`` in the others. Empty
   segments are a last resort, so that no link is ever lost.
6. *Verification* is exact, on the whole sets, by ``near_groups``: members meet their group's centre;
   groups that still hold more than one component are worked on in blocks inside tasks. The sketch of
   a set there is the parity of its shingles in 4 to 8 places for each: the places in which two
   differ are at most as many as the shingles that only one of them has, so a sketch never rules out
   a link.
7. Verified links are joined to connected components.

A text is split into words a piece at a time; its word hashes and shingles (some forty bytes of
memory for a word) are held whole, by one task.

Defined results: null and empty texts, and texts without words, have no shingles and are linked
with nothing. Ids are whole numbers; a row without an id keeps a null component and is linked with
nothing. Rows that repeat an id are the same document. An empty table gives an empty result. Only
the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .near_groups import Rule, components, restrict
from .shingles import U, mix, shingle_sets, text_batches

WIDTH = 5
#: Bytes of text that are worked on at once (some sixty bytes of memory for each).
BATCH_BYTES = 1_500_000
#: Packed keys per bucket.
BUCKET_KEYS = 4_000_000
#: Segments with an indexed one-deletion neighbourhood, in bands of more than ``FEW`` segments.
RESERVE, FEW = 8, 16
#: A key of so many documents in one batch is combined before the shuffle.
COMBINE = 64

INDEX, PROBE, WHOLE = 1, 2, 4
#: Flags also hold, from this bit on, how many bands under its own the set is seen in.
BELOW = 3


def band_bounds(limit: int = 1 << 31) -> np.ndarray:
    """Lower bounds of the size bands: 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, ..."""
    bounds = [1]
    while bounds[-1] < limit:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 5 // 4))
    return np.array(bounds, dtype=np.int64)


def segments_of(bounds: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Segments of a band: one more than the largest difference of two partners, and some to skip."""
    most = (bounds[band + 1] - 1) // 4
    return most + 1 + 4 + most * 12 // 100


def _key(total: np.ndarray, count: np.ndarray, salt: np.ndarray, segment: np.ndarray) -> np.ndarray:
    return mix(total + count.astype(U) * U(0x9E3779B97F4A7C15) + salt
               + (segment.astype(U) + U(1)) * U(0xC2B2AE3D27D4EB4F))


def signatures(owner: np.ndarray, hashed: np.ndarray, sizes: np.ndarray, bounds: np.ndarray,
               below: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(set number, key, flags, spare) under the bands ``below`` bands under each set's own: a set
    may leave ``spare`` of its probing keys out. ``owner`` and ``hashed`` are sorted; ``sizes`` are
    the sets'. Sets without a partner there give nothing."""
    n_sets = len(sizes)
    band = np.searchsorted(bounds, np.maximum(sizes, 1), side="right") - 1 - below
    top = bounds[np.maximum(band, 0) + 1] - 1
    joins = (sizes > 0) & (band >= 0) & (top * 5 >= sizes * 4)
    band = np.maximum(band, 0)
    need = np.where(joins, (sizes + np.minimum(top, sizes)) // 9 + 1, 0)
    segments = segments_of(bounds, band)
    salt = mix(band.astype(U) + U(0x1234567))
    keep = joins[owner]
    owner, hashed = owner[keep], hashed[keep]
    if not len(owner):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U), np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.uint16)
    segment = ((hashed >> U(32)) * segments[owner].astype(U) >> U(32)).astype(np.int64)
    begins = np.ones(len(owner), dtype=bool)
    begins[1:] = (owner[1:] != owner[:-1]) | (segment[1:] != segment[:-1])
    at = np.flatnonzero(begins)
    of = np.cumsum(begins) - 1
    mixed = mix(hashed ^ U(0x5851F42D4C957F2D))
    total = np.add.reduceat(mixed, at)
    count = np.diff(np.append(at, len(owner)))
    who, where = owner[at], segment[at]
    filled = np.bincount(who, minlength=n_sets)
    first = np.cumsum(filled) - filled
    spare_keys = np.clip(filled - need, 0, 65535).astype(np.uint16)
    index = U(INDEX) if below == 0 else U(0)
    flags = np.full(len(who), index | U(PROBE))
    raised = np.zeros(len(who), dtype=bool)
    spare = (segments[who] <= FEW) | (where < RESERVE)
    extra_who, extra_where, extra_flags = [], [], []
    for k in np.flatnonzero(joins & (filled < need)):  # too few segments have shingles
        own = np.arange(first[k], first[k] + filled[k])
        missing = int(need[k] - filled[k])
        can = own[spare[own] & (count[own] > 1)]
        can = can[np.argsort(count[can], kind="stable")][:missing]
        raised[can] = True
        missing -= len(can)
        if missing:
            empty = np.setdiff1d(np.arange(segments[k]), where[own])[:missing]
            extra_who.append(np.full(len(empty), k))
            extra_where.append(empty)
            extra_flags.append(np.full(len(empty), int(PROBE), dtype=U))
    out_who, out_key, out_flags = [who], [_key(total, count, salt[who], where)], [flags]
    if below == 0:  # index the empty segments too
        slots = np.where(joins, segments, 0)
        base = np.cumsum(slots) - slots
        free = np.ones(int(slots.sum()), dtype=bool)
        free[base[who] + where] = False
        empty = np.flatnonzero(free)
        set_of = np.repeat(np.arange(n_sets), slots)[empty]
        extra_who.append(set_of)
        extra_where.append(empty - base[set_of])
        extra_flags.append(np.full(len(empty), int(INDEX), dtype=U))
    if extra_who:
        some, place = np.concatenate(extra_who), np.concatenate(extra_where)
        zero = np.zeros(len(some), dtype=U)
        out_who.append(some)
        out_key.append(_key(zero, zero, salt[some], place))
        out_flags.append(np.concatenate(extra_flags))
    # one-deletion neighbourhoods
    open_to = raised | (spare & (below == 0))
    drop = np.flatnonzero(open_to[of] & (count[of] > 1 if below else count[of] > 0))
    s = of[drop]
    out_who.append(who[s])
    out_key.append(_key(total[s] - mixed[drop], count[s] - 1, salt[who[s]], where[s]))
    out_flags.append(np.where(raised[s] & (count[s] > 1), index | U(PROBE), index))
    flags = np.concatenate(out_flags).astype(np.uint8)
    used = flags > 0
    out = np.concatenate(out_who)[used]
    return out, np.concatenate(out_key)[used], flags[used] | np.uint8(below << BELOW), spare_keys[out]


def _describe(width: int):
    """(id, n, digest_a, digest_b) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in text_batches(batch, 1, BATCH_BYTES):
                owner, hashed = shingle_sets(raw, offsets, width)
                n = np.bincount(owner, minlength=b - a)
                digests = []
                with np.errstate(over="ignore"):
                    for seed in (U(0x243F6A8885A308D3), U(0x13198A2E03707344)):
                        sums = np.concatenate([[U(0)], np.cumsum(mix(hashed ^ seed))])
                        ends = np.cumsum(n)
                        digests.append((sums[ends] - sums[ends - n]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)), *map(pa.array, digests)],
                    names=["id", "n", "digest_a", "digest_b"])

    return run


def _packed(width: int, buckets: int):
    """(bucket, keys, ids, flags, spares) as packed arrays, one row per batch and bucket."""
    def emit(bucket, keys, *columns, whole=False):
        return {"bucket": int(bucket), "whole": whole, "keys": keys.tobytes(),
                **{n: c.tobytes() for n, c in zip(("ids", "flags", "spares"), columns, strict=True)}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = band_bounds()
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b, raw, offsets in text_batches(batch, 1, BATCH_BYTES):
                owner, hashed = shingle_sets(raw, offsets, width)
                sizes = np.bincount(owner, minlength=b - a).astype(np.int64)
                with np.errstate(over="ignore"):
                    parts = [signatures(owner, hashed, sizes, bounds, below) for below in range(3)]
                who, keys, flags, spares = (np.concatenate(x) for x in zip(*parts, strict=True))
                order = np.argsort(keys, kind="stable")
                keys, columns = keys[order], [every[a:b][who][order], flags[order], spares[order]]
                rows, keys, columns = _combine(keys, columns, buckets, emit)
                bucket = (keys >> U(32)) * U(buckets) >> U(32)  # ascending, as the keys are
                cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=U(buckets))), len(keys))
                rows += [emit(bucket[i], keys[i:j], *(c[i:j] for c in columns))
                         for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_PACKED)

    return run


_PACKED = pa.schema([("bucket", pa.int32()), ("whole", pa.bool_()),
                     *((n, pa.binary()) for n in ("keys", "ids", "flags", "spares"))])
_PACKED_DDL = "bucket int, whole boolean, keys binary, ids binary, flags binary, spares binary"
_GROUP_DDL = "grp long, id long, flags byte, spare int, mult long"


def _combine(keys, columns, buckets, emit):
    """Keys that ``COMBINE`` documents of the batch share and some of them probe: the members go out
    as a finished group, to a bucket of their own choosing, and one of them stands for them at the
    key's bucket."""
    if not len(keys):
        return [], keys, columns
    ids, flags, spares = columns
    at = np.flatnonzero(np.diff(keys, prepend=~keys[0]))
    size = np.diff(np.append(at, len(keys)))
    flagged = np.bitwise_or.reduceat(flags, at)
    hot = np.flatnonzero((size >= COMBINE) & (flagged & (INDEX | PROBE) == INDEX | PROBE))
    rows, keep = [], np.ones(len(keys), dtype=bool)
    flags = flags.copy()
    for g in hot:
        a, b = at[g], at[g] + size[g]
        where = int(mix(np.array([keys[a] ^ U(ids[a])]))[0] % U(buckets))
        rows.append(emit(where, keys[a:a + 1], ids[a:b], flags[a:b], spares[a:b], whole=True))
        keep[a + 1:b] = False
        flags[a] = flagged[g] & (INDEX | PROBE) | WHOLE
    return rows, keys[keep], [c[keep] for c in (ids, flags, spares)]


def _groups(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Rows (grp, id, flags, spare, mult) of the groups of documents that share a key, some probing
    and some indexing; ``mult`` keys have exactly these members."""
    out: list[tuple] = []
    loose: list[tuple] = []
    for whole, k, *columns in zip(*(table.column(n).to_pylist() for n in ("whole", "keys", "ids", "flags", "spares")),
                                  strict=True):
        k = np.frombuffer(k, dtype=U)
        i, f, sp = (np.frombuffer(c, dtype=t) for c, t in zip(columns, (np.int64, np.uint8, np.uint16), strict=True))
        if whole:  # combined before the shuffle: the key names the group
            out.append((np.repeat(k, len(i)), i, f, sp, np.ones(len(i), dtype=np.int64)))
        else:
            loose.append((k, i, f, sp))
    if loose:
        keys, ids, flags, spares = (np.concatenate(x) for x in zip(*loose, strict=True))
        order = np.lexsort((ids, keys))
        keys, ids, flags, spares = keys[order], ids[order], flags[order], spares[order]
        at = np.flatnonzero(np.diff(keys, prepend=~keys[0]))
        size = np.diff(np.append(at, len(keys)))
        flagged = np.bitwise_or.reduceat(flags, at)
        named = (flagged & WHOLE) > 0
        good = (flagged & (INDEX | PROBE) == INDEX | PROBE) & ((size > 1) | named)
        with np.errstate(over="ignore"):
            name = mix(np.add.reduceat(mix(ids.view(U) * U(64) + flags.astype(U)), at) + size.astype(U))
        name[named] = keys[at][named]
        chosen = np.flatnonzero(good)
        _, once, times = np.unique(name[chosen], return_index=True, return_counts=True)
        mult = np.zeros(len(at), dtype=np.int64)
        mult[chosen[once]] = times  # groups with the same members are one
        group_of = np.repeat(np.arange(len(at)), size)
        rows = (mult[group_of] > 0) & (flags & WHOLE == 0)  # stand-ins are out already
        out.append((name[group_of[rows]], ids[rows], flags[rows], spares[rows], mult[group_of[rows]]))
    grp, ids, flags, spares, mult = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (
        np.zeros(0, dtype=U), *(np.zeros(0, dtype=np.int64) for _ in range(4)))
    return pa.table({"grp": grp.view(np.int64), "id": ids, "flags": flags.astype(np.int8),
                     "spare": spares.astype(np.int32), "mult": mult})


def allocate(keyed: DataFrame) -> DataFrame:
    """(grp, id, probes) of the groups in which somebody has to probe: its index members and those
    that probe it. Of a set's shared keys under a band, all but ``spare`` have to be probed (keys
    that nobody shares are probed for nothing): the shortest lists are."""
    keyed = keyed.withColumn("below", F.shiftright(F.col("flags").cast("int"), BELOW))
    probing = keyed.filter(F.col("flags").bitwiseAND(F.lit(PROBE)) > 0)
    owed = (probing.groupBy("id", "below").agg((F.sum("mult") - F.max("spare")).alias("owed")).filter("owed > 0"))
    lengths = keyed.groupBy("grp").agg(F.count("*").alias("length"))
    shortest = Window.partitionBy("id", "below").orderBy("length", "grp")
    before = F.coalesce(F.sum("mult").over(shortest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    probes = (probing.join(owed, ["id", "below"]).join(lengths, "grp").withColumn("before", before)
              .filter("before < owed").select("grp", "id", F.lit(True).alias("probes")).distinct())
    probes = written(probes, "near_probes")
    members = keyed.join(probes, ["grp", "id"], "left").filter(
        (F.col("flags").bitwiseAND(F.lit(INDEX)) > 0) | F.col("probes"))
    return (members.join(probes.select("grp").distinct(), "grp", "left_semi")
            .groupBy("grp", "id").agg(F.max(F.coalesce("probes", F.lit(False))).alias("probes")))


def parity_sketches(hashed: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """For each set, whether an odd number of its hashes falls in each place; the places are a power
    of two, from 64 on and 4 for each hash at least."""
    places = np.maximum(6, np.ceil(np.log2(np.maximum(4 * sizes, 1)))).astype(np.int64)
    width = np.int64(1) << places
    first = np.cumsum(width) - width
    at = (hashed & (np.repeat(width, sizes) - 1).astype(U)).astype(np.int64)
    odd = np.bincount(np.repeat(first, sizes) + at, minlength=int(width.sum())).astype(np.uint8) & 1
    packed = np.packbits(odd, bitorder="little").tobytes()
    return [packed[a // 8:(a + w) // 8] for a, w in zip(first.tolist(), width.tolist(), strict=True)]


def folded(sketches: list[bytes]) -> np.ndarray:
    """Parity sketches folded to the narrowest one's places, 64 in a column."""
    width = min(map(len, sketches), default=8)
    out = np.zeros((len(sketches), width // 8), dtype=U)
    for k, sketch in enumerate(sketches):
        out[k] = np.bitwise_xor.reduce(np.frombuffer(sketch, dtype=U).reshape(-1, width // 8), axis=0)
    return out


def _may_link(one, n, others, sizes):
    differ = np.bitwise_count(one ^ others).sum(axis=1, dtype=np.int64)
    return differ * 9 <= n + sizes


RULE = Rule(num=80, den=100, matrix=folded, may_link=_may_link)


def _set_rows(width: int):
    """(id, sketch, shingles) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in text_batches(batch, 1, BATCH_BYTES):
                owner, hashed = shingle_sets(raw, offsets, width)
                n = np.bincount(owner, minlength=b - a)
                cuts = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(parity_sketches(hashed, n), pa.binary()),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(hashed.view(np.int64)))],
                    names=["id", "sketch", "shingles"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = WIDTH) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable by links)."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    known = slim.filter("id is not null")
    described = written(slim.mapInArrow(_describe(width), "id long, n long, digest_a long, digest_b long"),
                        "near_sets")
    digest = ["n", "digest_a", "digest_b"]
    classes = written(described.filter("n > 0 and id is not null").groupBy(*digest)
                      .agg(F.min("id").alias("rep")), "near_classes")
    copies = written(described.filter("id is not null").join(classes, digest, "left")
                     .filter("rep is null or rep <> id").select("id").distinct(), "near_copies")
    keys = classes.agg(F.sum(F.col("n") + 8)).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * partitions, -(-int(keys) // (2 * BUCKET_KEYS)))
    packed = restrict(known, copies, "anti").mapInArrow(_packed(width, buckets), _PACKED_DDL)
    keyed = written(packed.groupBy("bucket").applyInArrow(_groups, _GROUP_DDL).groupBy("grp", "id", "flags")
                    .agg(F.max("spare").alias("spare"), F.sum("mult").alias("mult")), "near_keys")
    sized = described.filter("id is not null").groupBy("id").agg(F.max("n").alias("n"))
    groups = written(allocate(keyed).join(sized, "id"), "near_groups")
    members = written(groups.select("id").distinct(), "near_members")
    sets = written(restrict(known, members, "semi").mapInArrow(_set_rows(width), "id long, sketch binary, shingles array<long>"),
                   "near_shingles")
    found = components(groups, sets, sets, RULE).withColumnRenamed("id", "rep")
    return (described.join(classes, digest, "left").join(found, "rep", "left")
            .select("id", F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id")).alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the smallest id of every component, with all its columns; rows without an
    id stay."""
    found = near_duplicates(docs, id_col, text_col)
    dropped = written(found.filter("component_id <> id").select("id").distinct(), "near_dropped")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
                       F.col(id_col).cast("long").alias("id"))
    return restrict(rows, dropped, "anti").select("whole.*")
