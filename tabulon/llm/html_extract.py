"""HTML main text with a site style tree.

The pages of a host are merged into one tree: elements with the same path of tags, classes, ids and
roles (digits aside) are one node. A node's *presentation* importance is the entropy of the child
sequences that it has on the host's pages, its *content* importance the entropy of the texts
standing in it, both to the base of the number of pages that have the node: 0 where every page shows
the same, 1 where no two do. Pages of a host that show the same count once. A branch is removed from
a page if no node in it reaches ``IMPORTANCE``. What a node has to stay under grows with its pages:
0 up to ``FEW_PAGES``, which are too few to tell, from the next page on what every page shows is
removed, and from ``FULL_PAGES`` on the whole ``IMPORTANCE`` counts. A page that would lose all its
text this way keeps its branches (a host of nothing but copies of one page).

Repetition alone cannot tell an advert that changes with every page from an article, so an element
that names its role (tag, ARIA role, class or id) has the importance of that role: 0 for menus, page
headers, footers, sidebars, notices, adverts, forms and comments, and where a page has an article or
main element, only what stands in it is main text. Words of class or id are hints only (``site
has-sidebar``): they do not count on an article or main element, nor on an element that holds the
page's main element, its only articles or most of its text (``_by_word``), and a page that they
leave without text keeps what the entropy keeps.

1. Each task parses its pages; a page becomes hashes of the child sequences and texts of its nodes.
   Pages of a host with the same hashes are reduced to one, then the hashes are counted per host and
   node with map-side combining, first per value, then per node. A hot host is spread over its pages
   and values.
2. Unimportant nodes (few: templates) are written; they are broadcast when they are at most
   ``BROADCAST_NODES`` by count, else each host's are joined to its pages by shuffle.
3. Pages are parsed again, unimportant branches removed and the blocks joined.

Defined results: a null or empty page has the empty text. Pages with a null or odd url share the
host of that name (empty for null). Repeated rows are extracted alike. Broken markup is read as far
as it goes. An empty table gives an empty result. Only id, url and html are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written
from .html_tree import Element, number, parse

IMPORTANCE = 0.2
FEW_PAGES, FULL_PAGES = 3, 10
BROADCAST_NODES = 200_000
PRESENTATION, CONTENT = 0, 1
Block = tuple[Element, str, str]


def host_of(url: str) -> Column:
    """Lower-case host of a url, without user and port; null and odd urls as they are."""
    plain = F.lower(F.coalesce(F.col(url), F.lit("")))
    return F.regexp_replace(plain, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*).*$", "$1")


_SHOWN = pa.list_(pa.struct([("node", pa.int64()), ("kind", pa.int8()), ("value", pa.int64())]))


def _show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, page, n, shown) of the pages of a batch: host, html; ``page`` is the hash of all that
    the ``n`` pages show."""
    for batch in batches:
        copies: Counter = Counter()
        values_of: dict[tuple[int, int], list[dict]] = {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            shown: dict[tuple[int, int], list] = {}
            todo = [parse(page.as_py() or "")[0]]
            while todo:
                e = todo.pop()
                if e.noise:
                    continue
                if e.children:
                    todo.extend(reversed(e.children))
                    shown.setdefault((e.key, PRESENTATION), []).append([c.key for c in e.children])
                if e.own:
                    shown.setdefault((e.key, CONTENT), []).append(e.own)
            values = [(*at, number(*v)) for at, v in shown.items()]
            key = (host, number(*values))
            copies[key] += 1
            values_of[key] = [{"node": n, "kind": k, "value": v} for n, k, v in values]
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in copies], pa.int64()), pa.array([p for _, p in copies], pa.int64()),
             pa.array(list(copies.values()), pa.int64()), pa.array([values_of[k] for k in copies], _SHOWN)],
            names=["host", "page", "n", "shown"])


def site_style_tree(pages: DataFrame, copies: bool = True) -> DataFrame:
    """(host, node, pages, importance) from rows of (host, html): the larger of a node's
    presentation and content importance. Without ``copies``, pages of a host that show the same
    count once."""
    shown = pages.mapInArrow(
        _show, "host long, page long, n long, shown array<struct<node: long, kind: byte, value: long>>")
    if not copies:
        shown = shown.groupBy("host", "page").agg(F.first("shown").alias("shown"), F.lit(1).cast("long").alias("n"))
    values = (shown.select("host", "n", F.inline("shown"))
              .groupBy("host", "node", "kind", "value").agg(F.sum("n").alias("n")))
    per_kind = values.groupBy("host", "node", "kind").agg(
        F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("n_log_n"))
    # entropy of the shares n / m, to the base m
    entropy = F.when(F.col("m") > 1, 1 - F.col("n_log_n") / (F.col("m") * F.log("m"))).otherwise(F.lit(1.0))
    return per_kind.groupBy("host", "node").agg(F.max("m").alias("pages"), F.max(entropy).alias("importance"))


def main_text(page: str, unimportant: set[int]) -> str:
    """The page's main text, given the unimportant nodes of its host."""
    _, blocks = parse(page)
    kept = _shown(blocks, unimportant)
    text = _main(kept, True) or _main(kept, False)
    if not text and unimportant:
        kept = _shown(blocks, set())
        text = _main(kept, True) or _main(kept, False)
    return text


def _main(blocks: list[Block], by_word: bool) -> str:
    """The text of the blocks, in article or main elements if there are any; ``by_word``: without
    what is noise by a role word."""
    if by_word:
        removed = _by_word(blocks)
        kept = [(e, text) for (e, text, _), gone in zip(blocks, removed, strict=True) if text and not gone]
    else:
        kept = [(e, whole) for e, _, whole in blocks]
    main = [text for e, text in kept if e.content]
    return "\n".join(main or [text for _, text in kept])


def _by_word(blocks: list[Block]) -> list[bool]:
    """Per block, whether it stands in an element that is noise by a role word. A word does not
    count on an article or main element, nor on an element that holds a main element, more than half
    of the text, or articles that do not share the word while no article stands outside (in no other
    element of a role word than such that hold this one)."""
    above: dict[int, tuple[Element | None, Element | None]] = {}  # nearest element of a word, of article or main
    worded: dict[int, Element | None] = {}  # elements of a word, outer ones first, each with the next outer one
    by_id: dict[int, Element] = {}

    def nearest(e: Element) -> tuple[Element | None, Element | None]:
        chain = []
        while e is not None and id(e) not in above:
            chain.append(e)
            e = e.parent
        word, head = (None, None) if e is None else above[id(e)]
        for x in reversed(chain):
            if x.head:
                head = x
            elif x.words:
                worded[id(x)], by_id[id(x)] = word, x
                word = x
            above[id(x)] = (word, head)
        return above[id(chain[0])] if chain else (word, head)

    heads: dict[int, Element] = {}
    total, held = 0, Counter()
    for e, text, _ in blocks:
        word, head = nearest(e)
        total += len(text)
        if word is not None:
            held[id(word)] += len(text)
        while text and head is not None and id(head) not in heads:
            heads[id(head)] = head
            head = above[id(head.parent)][1]
    if not worded:
        return [False] * len(blocks)
    stays: set[int] = set()
    for k in reversed(worded):  # inner ones first
        if worded[k] is not None:
            held[id(worded[k])] += held[k]
        if 2 * held[k] > total:
            stays.add(k)
    outside = {None if (w := above[i][0]) is None else id(w) for i, h in heads.items() if h.head == "article"}
    free: dict[int, bool] = {}  # an article stands outside the element
    for k, outer in worded.items():
        free[k] = None in outside or outer is not None and (free[id(outer)] or id(outer) in outside)
    for i, h in heads.items():
        at = above[i][0]
        while at is not None:
            if h.head == "main" or not (free[id(at)] or h.words & at.words):
                stays.add(id(at))
            at = worded[id(at)]
    gone: dict[int | None, bool] = {None: False}
    for k, outer in worded.items():
        gone[k] = k not in stays or gone[None if outer is None else id(outer)]
    return [gone[None if (w := above[id(e)][0]) is None else id(w)] for e, _, _ in blocks]


def _shown(blocks: list[Block], unimportant: set[int]) -> list[Block]:
    """The blocks that no removed branch holds."""
    important: dict[int, bool] = {}

    def stays(e: Element) -> bool:
        """Whether any node of the branch is important (computed bottom-up, without recursion)."""
        todo = [(e, False)]
        while todo:
            x, done = todo.pop()
            if id(x) in important:
                continue
            if done or not x.children:
                important[id(x)] = not x.noise and (x.key not in unimportant or any(
                    important[id(c)] for c in x.children))
            else:
                todo.append((x, True))
                todo.extend((c, False) for c in x.children)
        return important[id(e)]

    def shown(e: Element) -> bool:
        """No branch that holds the element is removed; blocks share their ancestors' verdicts."""
        chain = []
        while e is not None and e.parent is not None:
            chain.append(e)
            e = e.parent
        return all(stays(x) and not x.noise for x in chain)

    return [block for block in blocks if not block[0].noise and shown(block[0])]


def _extract(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty: set[int] = set()
        for batch in batches:
            nodes = batch.column(4).to_pylist() if broadcast is None else None
            texts = []
            for k, (host, page) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3), strict=True)):
                removed = broadcast.value.get(host, empty) if nodes is None else set(nodes[k] or ())
                texts.append(main_text(page.as_py() or "", removed))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             names=["id", "url", "text"])

    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of every page."""
    spark = pages.sparkSession
    slim = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.xxhash64(host_of(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    tree = site_style_tree(slim.select("host", "html"), copies=False)
    told = F.least(F.lit(1.0), (F.col("pages") - FEW_PAGES) / (FULL_PAGES - FEW_PAGES))
    low = written(tree.filter(F.col("importance") < IMPORTANCE * told).select("host", "node"), "style_tree_low")
    schema = T.StructType([slim.schema["id"], slim.schema["url"], T.StructField("text", T.StringType())])
    if low.count() <= BROADCAST_NODES:
        by_host: dict[int, set[int]] = {}
        for r in low.collect():
            by_host.setdefault(r["host"], set()).add(r["node"])
        return slim.mapInArrow(_extract(spark.sparkContext.broadcast(by_host)), schema)
    per_host = low.groupBy("host").agg(F.collect_list("node").alias("nodes"))
    joined = slim.join(per_host, "host", "left").select("id", "url", "host", "html", "nodes")
    return joined.mapInArrow(_extract(None), schema)
