"""Components of candidate groups: which members of a group are linked, exactly, without forming the
pairs of a group as rows.

Two sets link when ``den * intersection >= num * union``. Candidate groups (grp, id, n, probes) say
that only members of a common group, one of them probing, can link; ``n`` is the size of the set.

1. *Centres.* Every member meets the group's centre, its smallest probing id: one pair for each
   member, equal ones once. A sketch of both sets may rule the pair out, the rest is verified.
   Groups of copies of one text end here.
2. *Open groups* still hold more than one component among the others. Groups with the same members
   are one. A group is cut in blocks by a hash of the id so that no block holds more than ``BLOCK``
   members or ``BLOCK_WEIGHT`` elements, and every pair of blocks is one piece of work of its own;
   small groups share tasks. The task compares sketches (numpy, one member against all others of
   another component) and returns only the members that have a possible partner, not the pairs.
3. *Verification.* The whole sets of those members, dealt out the same way, are compared where the
   sketch does not rule the pair out; a link joins the two components at once, so no pair within a
   component is looked at, and a task returns a forest: fewer rows than members.
4. The links join the components.

The work in a group whose members stay apart grows with the square of its members (nothing is left
out), but only inside tasks of bounded size: rows, shuffles and memory stay proportional to the
members, times the number of blocks for groups of more than a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import connected_components

#: Members and elements of a block.
BLOCK, BLOCK_WEIGHT = 1024, 4_000_000
#: Bytes of the members of small groups that share a task.
TASK_BYTES = 24_000_000
#: Ids are broadcast up to this count, else joined by shuffle.
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Rule:
    """Sets link when ``den * intersection >= num * union``. ``matrix`` makes sketches comparable;
    ``may_link(one, n, others, sizes)`` is false only for pairs that the sketches rule out (``one``
    is a row, or as many rows as ``others``). With ``prune_centres`` pairs with centres are compared
    by sketch, too."""

    num: int
    den: int
    matrix: Callable[[list[bytes]], np.ndarray]
    may_link: Callable[[np.ndarray, np.ndarray | int, np.ndarray, np.ndarray], np.ndarray]
    prune_centres: bool = False

    def sizes_allow(self, a: str, b: str) -> str:
        return f"{a} * {self.den} >= {b} * {self.num} and {b} * {self.den} >= {a} * {self.num}"


def restrict(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose id is (semi) or is not (anti) among the written ``ids``."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "id", f"left_{how}")


def _ruled_out(rule: Rule):
    """The pairs (a, b) that their sketches leave."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, other = (rule.matrix(batch.column(n).to_pylist()) for n in ("sketch_a", "sketch_b"))
                keep = rule.may_link(one, batch.column("n").to_numpy(), other, batch.column("m").to_numpy())
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return run


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sets link. Only the sets of documents in the pairs are moved."""
    named = written(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "near_pair_ids")
    sets = restrict(sets.select("id", "shingles"), named, "semi")
    with_b = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
    both = with_b.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
    common = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    either = F.size("set_a") + F.size("set_b") - common
    return written(both.filter(common * rule.den >= either * rule.num).select("a", "b"), "near_links")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (id, component) after further links: the components that the links connect become
    one. Only links between different components enter the search."""
    of_a = labels.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    of_b = labels.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    between = written(links.join(of_a, "a").join(of_b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
                      .filter("a <> b").distinct(), "near_between")
    if between.isEmpty():
        return labels
    found = connected_components(between).select(F.col("node").alias("component"), F.col("component").alias("top"))
    return written(labels.join(found, "component", "left")
                   .select("id", F.coalesce("top", "component").alias("component")), "near_labels")


def _pieces(table: pa.Table) -> Iterator[pa.Table]:
    """The pieces of work of a task: one group, or two blocks of one, in a fixed order."""
    table = table.sort_by([(c, "ascending") for c in ("grp", "lo", "hi", "side", "id")])
    keys = [table.column(c).to_numpy() for c in ("grp", "lo", "hi")]
    new = np.ones(table.num_rows, dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    cuts = np.append(np.flatnonzero(new), table.num_rows)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield table.slice(a, b - a)


class _Piece:
    def __init__(self, table: pa.Table, rule: Rule):
        self.rule = rule
        self.ids, self.n, self.component, self.probes = (
            table.column(c).to_numpy() for c in ("id", "n", "component", "probes"))
        self.component = self.component.copy()
        side = table.column("side").to_numpy()
        #: Members from here on are the second block; those before meet only them.
        self.second = int((side == 0).sum()) if side.any() else 0
        self.sketches = rule.matrix(table.column("sketch").to_pylist())

    def partners(self, i: int) -> np.ndarray:
        """Later members of other components that member i may link with."""
        start = max(i + 1, self.second) if i < self.second or not self.second else len(self.ids)
        n, m = int(self.n[i]), self.n[start:]
        ok = (self.component[start:] != self.component[i]) & (m * self.rule.den >= n * self.rule.num)
        ok &= n * self.rule.den >= m * self.rule.num
        if not self.probes[i]:
            ok &= self.probes[start:]
        at = np.flatnonzero(ok) + start
        return at[self.rule.may_link(self.sketches[i], n, self.sketches[at], self.n[at])] if len(at) else at

    def rows(self) -> range:
        return range(self.second or len(self.ids))


def _with_partners(rule: Rule):
    """(grp, id) of the members that have a possible partner."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        grps, found = [], []
        for part in _pieces(table):
            piece = _Piece(part, rule)
            needed = np.zeros(len(piece.ids), dtype=bool)
            for i in piece.rows():
                at = piece.partners(i)
                if len(at):
                    needed[i] = True
                    needed[at] = True
            found.append(piece.ids[needed])
            grps.append(np.full(int(needed.sum()), part.column("grp")[0].as_py(), dtype=np.int64))
        return pa.table({"grp": np.concatenate(grps), "id": np.concatenate(found)})

    return run


def _forest(rule: Rule):
    """Links (a, b) that connect all members of a piece that links connect."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        links = []
        for part in _pieces(table):
            piece = _Piece(part, rule)
            sets = part.column("shingles").combine_chunks()
            sets = sets.chunk(0) if isinstance(sets, pa.ChunkedArray) else sets
            lengths = np.asarray(sets.value_lengths(), dtype=np.int64)
            starts = np.cumsum(lengths) - lengths
            distinct, element = np.unique(sets.flatten().to_numpy(), return_inverse=True)
            mine = np.zeros(len(distinct), dtype=bool)
            for i in piece.rows():
                at = piece.partners(i)
                if not len(at):
                    continue
                own = element[starts[i]:starts[i] + lengths[i]]
                mine[own] = True
                size = lengths[at]
                first = np.cumsum(size) - size
                where = np.repeat(starts[at] - first, size) + np.arange(int(size.sum()))
                common = np.add.reduceat(mine[element[where]].astype(np.int64), first)
                mine[own] = False
                linked = common * rule.den >= (piece.n[i] + piece.n[at] - common) * rule.num
                for j in at[linked].tolist():
                    if piece.component[j] != piece.component[i]:
                        links.append((piece.ids[i], piece.ids[j]))
                        piece.component[piece.component == piece.component[j]] = piece.component[i]
        a, b = np.array(links, dtype=np.int64).reshape(-1, 2).T
        return pa.table({"a": a, "b": b})

    return run


def _dealt(members: DataFrame, bytes_each) -> DataFrame:
    """Members of open groups (with the group's ``blocks``) dealt to tasks: columns lo, hi, side (of
    the pair of blocks) and task."""
    spark = members.sparkSession
    size = members.filter("blocks = 1").agg(F.sum(bytes_each)).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // TASK_BYTES))
    own = F.pmod(F.xxhash64("id", F.lit(5)), F.col("blocks")).cast("int")
    each = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    each = each.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
    return each.withColumns({
        "side": F.when(F.col("own") == F.col("lo"), 0).otherwise(1),
        "task": F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("grp"), F.lit(tasks))).otherwise(F.xxhash64("grp", "lo", "hi")),
    }).drop("own", "other", "blocks")


def _open_members(others: DataFrame, labels: DataFrame) -> DataFrame:
    """(grp, id, n, probes, component, blocks) of groups that hold pairs not yet met."""
    labelled = others.join(labels, "id")
    names = [F.bit_xor(F.xxhash64("id", "probes", F.lit(k))) for k in (1, 2)]
    groups = (labelled.groupBy("grp").agg(
        F.min("component").alias("first"), F.max("component").alias("last"), F.max("probes").alias("any"),
        F.count("*").alias("size"), F.sum("n").alias("weight"), names[0].alias("x"), names[1].alias("y"))
        .filter("first <> last and any"))
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("weight") / BLOCK_WEIGHT))
    groups = groups.groupBy("size", "x", "y").agg(F.min("grp").alias("grp"), F.max(blocks).cast("int").alias("blocks"))
    return labelled.join(groups.select("grp", "blocks"), "grp")


def components(groups: DataFrame, sketches: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(id, component) of the members of written candidate groups (grp, id, n, probes): the components
    that the links among probing and other members make. Written tables: ``sketches`` (id, sketch)
    and ``sets`` (id, shingles) of every member."""
    labels = written(groups.select("id", F.col("id").alias("component")).distinct(), "near_labels")
    centre = groups.groupBy("grp").agg(F.min(F.when(F.col("probes"), F.struct("id", "n"))).alias("c"))
    others = written(groups.join(centre.select("grp", F.col("c.id").alias("a"), F.col("c.n").alias("m")), "grp")
                     .filter("id <> a"), "near_others")
    pairs = others.filter(rule.sizes_allow("n", "m")).groupBy(F.col("id").alias("b"), "a").agg(
        F.max("n").alias("n"), F.max("m").alias("m"))
    if rule.prune_centres:
        own = sketches.select("id", "sketch")
        pairs = (pairs.join(own.select(F.col("id").alias("a"), F.col("sketch").alias("sketch_a")), "a")
                 .join(own.select(F.col("id").alias("b"), F.col("sketch").alias("sketch_b")), "b")
                 .select("a", "b", F.col("m").alias("n"), F.col("n").alias("m"), "sketch_a", "sketch_b")
                 .mapInArrow(_ruled_out(rule), "a long, b long"))
    labels = merged(labels, verified(written(pairs.select("a", "b"), "near_pairs"), sets, rule))
    left = written(_open_members(others.drop("a", "m"), labels), "near_open")
    if left.isEmpty():
        return labels
    with_sketch = left.join(sketches.select("id", "sketch"), "id")
    needed = written(_dealt(with_sketch, F.octet_length("sketch") + 64).groupBy("task")
                     .applyInArrow(_with_partners(rule), "grp long, id long").distinct(), "near_needed")
    if needed.isEmpty():
        return labels
    with_sets = with_sketch.join(needed, ["grp", "id"], "left_semi").join(sets.select("id", "shingles"), "id")
    links = written(_dealt(with_sets, F.octet_length("sketch") + 64 + 8 * F.col("n")).groupBy("task")
                    .applyInArrow(_forest(rule), "a long, b long").distinct(), "near_links")
    return merged(labels, links)
