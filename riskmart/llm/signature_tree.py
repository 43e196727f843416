"""N-gram Jaccard join by signature trees.

A document's set holds the hashes of its distinct word shingles.  Documents link when
their sets' Jaccard similarity reaches ``percent``; a component is what links connect.

1. Equal sets become one node.  Of a set of n, at most e = n - ceil(percent * n / 100)
   shingles are missing from a linked partner, so the e + l smallest hashes of both
   (their windows) share l shingles at least: a node with fewer window shingles that
   occur in other windows has no partner and is done.
2. Of the other nodes' whole sets, shingles are counted.  With the rarest first, linked
   nodes share one of their first e + 1 shingles; a node whose first e + 1 are its own
   is done as well.  The others fall into clusters that share such a shingle, so common
   passages bring no one together.
3. A cluster's nodes, in cells of bounded size, form a signature tree: a node of the
   tree has the OR of its members' token bitmaps, their size range, and the most
   tokens that share a bit with another of the same set.  Two trees (or one with
   itself) are walked together, level by level; a pair of tree nodes is dropped when
   sizes or the greatest possible overlap rule a link out.  Pairs of leaves are
   compared exactly, unless links found before connect them already.
   Clusters of several cells: the cells, then one node of each component, then all
   pairs of cells of the clusters that are still in several components.

Defined cases: null or empty text has the empty set and no links; a text of fewer
words than a shingle is one shingle; null ids take part, and a component of nulls
alone has id null; rows that repeat are in one component; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import (WordHashes, components, discard, first_of_repeats, mix, raw_texts, shingle_set, stash,
                                 tidied, whole_text)


@dataclass(frozen=True)
class Settings:
    words: int = 5
    percent: int = 80
    cell_nodes: int = 1024
    cell_tokens: int = 4_000_000
    leaf: int = 1


def missing(n, percent: int):
    """Shingles of a set of ``n`` that a linked partner may lack, at most."""
    return n - -(-percent * n // 100)


def shared_least(n, percent: int):
    """l for a set of ``n``: grows with n."""
    e = missing(n, percent)
    return (e + 1) // 2 + (e == 0)


def _missing(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / 100)


# -- sets ----------------------------------------------------------------------------------

_SETS = "doc_id long, text_hash long, n long, s1 long, s2 long, window array<long>"


def _sets(words_in_shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            n, s1, s2, windows = [], [], [], []
            for data in raw_texts(batch.column("text")):
                u = shingle_set(hashes.of(data.lower().split()), words_in_shingle)
                size = len(u)
                n.append(size)
                s1.append(int(mix(u).sum().view(np.int64)) if size else 0)
                s2.append(int(mix(u ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum().view(np.int64)) if size else 0)
                windows.append(u[: missing(size, percent) + shared_least(size, percent)].view(np.int64))
            sizes = np.cumsum([0] + [len(w) for w in windows]).astype(np.int32)
            values = np.concatenate(windows) if windows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                 pa.array(s2, pa.int64()), pa.ListArray.from_arrays(pa.array(sizes), pa.array(values, pa.int64()))],
                ["doc_id", "text_hash", "n", "s1", "s2", "window"])
    return run


def _whole_sets(words_in_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(hashes.of(data.lower().split()), words_in_shingle).view(np.int64)
                    for data in raw_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))],
                                             ["node", "tokens"])
    return run


# -- the tree ------------------------------------------------------------------------------

class Forest:
    """Union-find over positions."""

    def __init__(self, labels: list[int]):
        first: dict[int, int] = {}
        self.parent = [first.setdefault(x, i) for i, x in enumerate(labels)]

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.parent[self.root(i)] = self.root(j)


class Tree:
    """Levels of a signature tree, leaves first; every level halves the one below."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        # similar sizes side by side, and of one size those with the same smallest hash
        size = np.array([len(s) for s in sets])
        self.order = np.lexsort(([int(s[0]) for s in sets], size))
        maps = np.zeros((len(sets), bits // 64), np.uint64)
        for row, k in enumerate(self.order):
            at = (sets[k] % np.uint64(bits)).astype(np.int64)
            np.bitwise_or.at(maps[row], at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        n = size[self.order]
        self.levels = [(maps, n, n, n - np.bitwise_count(maps).sum(1).astype(np.int64))]
        while len(self.levels[-1][1]) > 1:
            maps, low, high, excess = self.levels[-1]
            if len(low) % 2:
                maps, low, high, excess = (np.concatenate([x, x[-1:]]) for x in (maps, low, high, excess))
            self.levels.append((maps[::2] | maps[1::2], np.minimum(low[::2], low[1::2]),
                                np.maximum(high[::2], high[1::2]), np.maximum(excess[::2], excess[1::2])))


def dual_walk(left: Tree, right: Tree, percent: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of leaf positions whose sizes and bitmaps allow a link, in parts; i < j within one tree."""
    stack = [(max(len(left.levels), len(right.levels)) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        if len(a) > 8192:
            stack += [(level, a[k: k + 8192], b[k: k + 8192]) for k in range(0, len(a), 8192)]
            continue
        lm, llow, lhigh, lexc = left.levels[min(level, len(left.levels) - 1)]
        rm, rlow, rhigh, rexc = right.levels[min(level, len(right.levels) - 1)]
        fits = (100 * lhigh[a] >= percent * rlow[b]) & (100 * rhigh[b] >= percent * llow[a])
        if same:
            fits &= a <= b
        a, b = a[fits], b[fits]
        # J >= p% needs an overlap of p * (|A| + |B|) / (100 + p)
        overlap = np.bitwise_count(lm[a] & rm[b]).sum(1).astype(np.int64) + np.minimum(lexc[a], rexc[b])
        overlap = np.minimum(overlap, np.minimum(lhigh[a], rhigh[b]))
        fits = (100 + percent) * overlap >= percent * (llow[a] + rlow[b])
        a, b = a[fits], b[fits]
        if not len(a):
            continue
        if level == 0:
            keep = a < b if same else np.ones(len(a), bool)
            yield a[keep], b[keep]
            continue
        a2, b2 = [], []
        lsize = len(left.levels[min(level - 1, len(left.levels) - 1)][1])
        rsize = len(right.levels[min(level - 1, len(right.levels) - 1)][1])
        lsteps = (0, 1) if level < len(left.levels) else (None,)
        rsteps = (0, 1) if level < len(right.levels) else (None,)
        for x in lsteps:
            for y in rsteps:
                p, q = a if x is None else 2 * a + x, b if y is None else 2 * b + y
                good = (p < lsize) & (q < rsize)
                a2.append(p[good]), b2.append(q[good])
        stack.append((level - 1, np.concatenate(a2), np.concatenate(b2)))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the Jaccard similarity of two sorted sets reaches ``percent``."""
    at = np.searchsorted(b, a)
    inside = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * inside >= percent * (len(a) + len(b) - inside)


def cell_links(nodes: list[int], sides: list[int], labels: list[int], sets: list[np.ndarray],
               percent: int) -> list[tuple[int, int]]:
    """Links that connect what the sets of a cell connect: within one side, or between sides 0 and 1.

    ``labels``: nodes of one label are connected already.
    """
    forest, out = Forest(labels), []
    typical = int(np.median([len(s) for s in sets]))
    bits = 1 << min(16, max(9, (8 * typical).bit_length()))
    parts = [[i for i, s in enumerate(sides) if s == k] for k in (0, 1)]
    trees = [Tree([sets[i] for i in p], bits) if p else None for p in parts]
    if trees[0] is None:
        return out
    across = trees[1] is not None
    p, q = (parts[0], parts[1]) if across else (parts[0], parts[0])
    left, right = (trees[0], trees[1]) if across else (trees[0], trees[0])
    for a, b in dual_walk(left, right, percent, not across):
        for i, j in zip(left.order[a].tolist(), right.order[b].tolist()):
            i, j = p[i], q[j]
            if forest.root(i) != forest.root(j) and linked(sets[i], sets[j], percent):
                forest.join(i, j)
                out.append((nodes[i], nodes[j]))
    return out


def stars(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, smallest node) of what ``links`` connect: edges that need few steps to become components."""
    ids = sorted({x for pair in links for x in pair})
    place = {x: i for i, x in enumerate(ids)}
    forest = Forest(ids)
    for a, b in links:
        low, high = sorted((forest.root(place[a]), forest.root(place[b])))
        forest.parent[high] = low
    return [(x, ids[forest.root(i)]) for i, x in enumerate(ids) if forest.root(i) != i]


def _cells(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [], [])

        def links() -> pa.RecordBatch:
            found = stars(cell_links(*held, percent)) if len(held[0]) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            cells = zip(*(batch.column(c).to_pylist() for c in ("cluster", "cell", "side", "label", "node")))
            for (cluster, cell, side, label, node), tokens in zip(cells, batch.column("tokens")):
                if now != (cluster, cell):
                    if now is not None:
                        yield links()
                    now, held = (cluster, cell), ([], [], [], [])
                for part, x in zip(held, (node, side, label, np.array(tokens.values).view(np.uint64))):
                    part.append(x)
        if now is not None:
            yield links()
    return run


def _walk(rows: DataFrame, sets: DataFrame, percent: int, tag: str) -> DataFrame:
    """Links (a, b) of every cell of ``rows`` (cluster, cell, side, label, node), written."""
    key = ["cluster", "cell"]
    rows = rows.select(*key, "side", "label", "node").join(sets, "node")
    return stash(rows.repartition(*key).sortWithinPartitions(*key)
                 .mapInArrow(tidied(_cells(percent)), "a long, b long"), tag)


# -- the join ------------------------------------------------------------------------------

def classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_hash, n_shingles, class (null for an empty set), component_id."""
    s, percent = settings, settings.percent
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("text_hash"),
                        whole_text().alias("text"))
    sets = stash(texts.mapInArrow(tidied(_sets(s.words, percent)), _SETS).withColumn(
        "row", F.monotonically_increasing_id()), "shingle-sets")
    same = ["n", "s1", "s2"]
    nodes = stash(sets.where("n > 0").groupBy(*same).agg(F.min("row").alias("node"), F.min("doc_id").alias("least"),
                                                         F.count("*").alias("rows")), "set-nodes")
    # rows whose set another row stands for
    again = stash(sets.where("n > 0").select("row", *same).join(nodes.where("rows > 1").select(*same, "node"), same)
                  .where("row <> node").select("row"), "set-repeats")
    single = sets.where("n > 0").join(again, "row", "left_anti").select(F.col("row").alias("node"), "n", "window",
                                                                       "doc_id", "text_hash")
    tokens = single.select("node", F.explode("window").alias("token"))
    counts = stash(tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1"), "window-tokens")

    # nodes with enough window shingles that others have too
    hits = tokens.join(counts.hint("merge"), "token").groupBy("node").agg(F.count("*").alias("hits"))
    partner = F.ceil(F.col("n") * percent / 100)                       # the smallest set it can link to
    partner_e = _missing(partner, percent)
    least = F.ceil(partner_e / 2) + (partner_e == 0).cast("int")
    open_ = single.join(hits, "node").where(F.col("hits") >= least)
    open_ = stash(open_.select("node", "doc_id", "text_hash"), "open-nodes")

    # a node's text is that of the row it is named after; rows that repeat id and text would double it
    repeats = sets.groupBy("doc_id", "text_hash").agg(F.count("*").alias("c")).where("c > 1")
    once = texts if repeats.isEmpty() else texts.dropDuplicates(["doc_id", "text_hash"])
    wanted = open_.select("node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    whole = once.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    whole = stash(whole.select("node", "text").mapInArrow(tidied(_whole_sets(s.words)), "node long, tokens array<long>"),
                  "open-sets")

    # clusters: nodes that share one of their rarest shingles
    tokens = whole.select("node", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    counts = stash(tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1"), "open-tokens")
    known = tokens.join(counts.hint("merge"), "token").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("c", "token"))).alias("known"))
    first = _missing(F.col("n"), percent) + 1 - (F.col("n") - F.size("known"))        # of e + 1, less its own
    meet = stash(known.where(first > 0).select("node", "n", F.explode(F.slice(
        "known", F.lit(1), first.cast("int"))).alias("k")).select("node", "n", "k.token"), "rarest-tokens")
    firsts = stash(meet.groupBy("token").agg(F.min("node").alias("b"), F.count("*").alias("k")).where("k > 1")
                   .select("token", "b"), "cluster-firsts")
    cluster = stash(components(meet.join(firsts, "token").select(F.col("node").alias("a"), "b").where("a <> b")
                               .distinct(), "clusters"), "clusters")
    sizes = cluster.join(meet.select(F.col("node").alias("id"), "n").distinct(), "id").groupBy("component_id").agg(
        F.count("*").alias("members"), F.sum("n").alias("held"))
    sizes = stash(sizes.withColumn("cells", F.greatest(F.ceil(F.col("members") / s.cell_nodes),
                                                       F.ceil(F.col("held") / s.cell_tokens)).cast("long")), "cluster-sizes")
    member = (cluster.join(sizes, "component_id").withColumnRenamed("id", "node")
              .select("node", F.col("component_id").alias("cluster"), "cells",
                      F.pmod(F.xxhash64("node"), F.col("cells")).alias("block")))
    member = stash(member, "cluster-members")

    links = _walk(member.withColumns({"cell": F.col("block").cast("string"), "side": F.lit(0), "label": F.col("node")}),
                  whole, percent, "links")
    large = member.where("cells > 1")
    if not large.isEmpty():
        links = stash(links.unionByName(_large_links(large, whole, links, s)), "all-links")

    discard(counts, open_, meet, firsts, whole)
    joined = components(links, "near")
    named = (nodes.join(joined.withColumnRenamed("id", "node"), "node", "left")
             .withColumn("class", F.coalesce("component_id", "node")))
    named = stash(named.select(*same, "class", "least"), "near-classes")
    ids = stash(named.groupBy("class").agg(F.min("least").alias("component_id")), "near-ids")
    named = stash(named.drop("least").join(ids, "class"), "near-named")
    rows = sets.select("doc_id", "text_hash", *same).join(named, same, "left")
    return rows.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "class",
                       F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _large_links(large: DataFrame, sets: DataFrame, links: DataFrame, s: Settings) -> DataFrame:
    """Links between the cells of clusters of several cells."""
    def labelled(found: DataFrame, tag: str) -> DataFrame:
        return stash(large.join(components(found, tag).withColumnRenamed("id", "node"), "node", "left")
                     .withColumn("label", F.coalesce("component_id", "node")).drop("component_id"), tag)

    # one node of each component of a cell, the one of the smallest number
    now = labelled(links, "cell-labels")
    heads = now.where("node = label")
    count = heads.groupBy("cluster").agg(F.count("*").alias("heads"))
    heads = heads.join(count, "cluster").withColumn("cell", F.concat(
        F.lit("h"), F.pmod(F.xxhash64("node", F.lit(1)), F.ceil(F.col("heads") / s.cell_nodes))))
    more = _walk(heads.withColumn("side", F.lit(0)), sets, s.percent, "head-links")

    # every pair of cells of the clusters still in several components
    now = labelled(links.unionByName(more), "head-labels")
    open_ = now.groupBy("cluster").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    now = now.join(stash(open_.select("cluster"), "open-clusters"), "cluster")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("other")
    pairs = now.select("*", other).where("other <> block").withColumns({
        "side": (F.col("other") < F.col("block")).cast("int"),
        "cell": F.concat_ws("-", F.least("block", "other"), F.greatest("block", "other"))})
    return more.unionByName(_walk(pairs, sets, s.percent, "pair-links"))


def one_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` with one of each component (smallest id, then text hash), with all their columns."""
    found = stash(classes(docs, settings), "near-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_hash")).alias("f")
    stays = found.where("class is not null").groupBy("class").agg(first).select("f.doc_id", "f.text_hash").unionByName(
        found.where("class is null").select("doc_id", "text_hash"))
    stays = stash(stays.distinct().select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_key")), "near-stays")
    empty = F.trim(F.translate(whole_text(), "\t\n\x0b\x0c\r", "     ")) == ""
    return first_of_repeats(docs, F.xxhash64(whole_text()), stays, every=empty)
