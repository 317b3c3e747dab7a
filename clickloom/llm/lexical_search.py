"""Ranked lexical search by a trie of documents.

Each document is restricted to the terms that the items ask for, its terms are ordered by document frequency (most frequent
first), and the documents of a task are laid into a trie, where common beginnings share a path. A node knows, of the documents
below it, the largest number of occurrences of every term and the least length value m. A score grows with the
first and falls with the second, so the two bound all scores below the node. For each item the trie is searched depth first,
best bound first; a branch whose bound is below the item's tenth best score so far is left out, which loses nothing. What a
task knows of an item's best it keeps from trie to trie. The tasks' best documents (ten an item and task) are ranked last.

Items are searched in blocks of bounded size: a block's terms and weights are broadcast, the documents stay where they are.

Defined results: null and empty texts have no terms, rank nowhere and find nothing. A row ranks on its own, also if it shares
its id or has none; equal scores are ordered by id, null first. Items that share an id, or have none, are searched each on
their own. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.sources.stage import stage

# Bytes of terms in a block of items, about.
BLOCK_BYTES = 4 << 20
# Documents of a trie, and the most of them that a node keeps without branching further.
TRIE, BUCKET = 1 << 14, 16
# Fixed rule of terms: bytes that part them are 00-2F, 3A-40, 5B-60 and 7B-7F; A-Z are lowered.
PARTS = bytes(32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
NO_ID = -(1 << 63)


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(PARTS).split()


def item_terms(items: DataFrame, item_id: str, text_col: str) -> DataFrame:
    """Stored (num, item_id, terms, size): distinct terms of each item that has any, and their bytes."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t.as_py()))) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(found, pa.list_(pa.binary())), pa.array([sum(map(len, f)) + 16 * len(f) for f in found], pa.int64())],
                ["item_id", "terms", "size"])

    kind = dict(items.dtypes)[item_id]
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text_col).cast("binary").alias("text"))
    found = rows.mapInArrow(split, f"item_id {kind}, terms array<binary>, size long").where("size > 0")
    return stage(found.withColumn("num", F.monotonically_increasing_id()), "ls-items")


@dataclass(frozen=True)
class Node:
    """A subtree: documents ``low`` to ``high`` of the sorted ones, its branches, and bounds over its documents."""

    low: int
    high: int
    m: int
    ranks: np.ndarray
    tfs: np.ndarray
    branches: list[Node]


class Trie:
    """Documents as (id, m, ascending term ranks, occurrences)."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, ranks: list[np.ndarray], tfs: list[np.ndarray]) -> None:
        order = sorted(range(len(ids)), key=[r.astype(">u4").tobytes() for r in ranks].__getitem__)
        self.ids, self.m = ids[order], m[order]
        self.ranks = np.concatenate([ranks[i] for i in order])
        self.tfs = np.concatenate([tfs[i] for i in order])
        self.ends = np.cumsum([0, *(len(ranks[i]) for i in order)])
        self.root = self.grow()

    def grow(self) -> Node:
        """Branch while a subtree has more than BUCKET documents with different rests; bounds are merged from the branches up."""
        size = np.diff(self.ends)
        plan: list[tuple[int, int, list[int]]] = []  # (low, high, numbers of the branches), parents first
        open_ = [(0, len(self.ids), 0, -1)]
        while open_:
            low, high, depth, parent = open_.pop()
            if parent >= 0:
                plan[parent][2].append(len(plan))
            me = len(plan)
            plan.append((low, high, []))
            while high - low > BUCKET:
                at = self.ends[low:high] + depth
                term = np.where(size[low:high] > depth, self.ranks[np.minimum(at, len(self.ranks) - 1)].astype(np.int64), -1)
                if term[0] == -1 == term[-1]:
                    break  # all end here: copies of one term vector
                cuts = np.flatnonzero(term[1:] != term[:-1]) + 1
                depth += 1
                if len(cuts):
                    edges = [low, *(low + cuts).tolist(), high]
                    open_ += [(a, b, depth, me) for a, b in zip(edges, edges[1:], strict=False)]
                    break
        nodes: list[Node | None] = [None] * len(plan)
        for i in range(len(plan) - 1, -1, -1):
            low, high, numbers = plan[i]
            below = [nodes[k] for k in numbers]
            if below:
                ranks, tfs = np.concatenate([b.ranks for b in below]), np.concatenate([b.tfs for b in below])
            else:
                ranks, tfs = self.ranks[self.ends[low] : self.ends[high]], self.tfs[self.ends[low] : self.ends[high]]
            by = np.argsort(ranks, kind="stable")
            ranks, tfs = ranks[by], tfs[by]
            heads = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]])) if len(ranks) else np.empty(0, np.int64)
            most = np.maximum.reduceat(tfs, heads) if len(heads) else tfs
            nodes[i] = Node(low, high, int(self.m[low:high].min()), ranks[heads], most, below)
        return nodes[0]

    def bound(self, node: Node, weights: np.ndarray) -> int:
        return int((weights[node.ranks] * (1_000_000_000 * node.tfs // (1000 * node.tfs + 8 * node.m))).sum())

    def search(self, weights: np.ndarray, best: list[tuple[int, int]], k: int) -> None:
        """Better the heap ``best`` of (score, -id) pairs, at most ``k``, least first."""
        stack = [(self.bound(self.root, weights), self.root)]
        while stack:
            bound, node = stack.pop()
            if bound < (best[0][0] if len(best) == k else 1):
                continue
            if node.branches:
                found = [(self.bound(b, weights), b) for b in node.branches]
                least = best[0][0] if len(best) == k else 1
                stack += sorted((f for f in found if f[0] >= least), key=lambda f: f[0])
                continue
            a, b = self.ends[node.low], self.ends[node.high]
            ranks, tfs = self.ranks[a:b], self.tfs[a:b]
            ends = self.ends[node.low : node.high + 1] - a
            value = weights[ranks] * (1_000_000_000 * tfs // (1000 * tfs + 8 * np.repeat(self.m[node.low : node.high], np.diff(ends))))
            total = np.concatenate([[0], np.cumsum(value)])
            scores = total[ends[1:]] - total[ends[:-1]]
            for i in np.flatnonzero(scores >= (best[0][0] if len(best) == k else 1)).tolist():
                entry = int(scores[i]), -int(self.ids[node.low + i])
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)


def restricted(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Stored (id, n, terms, tfs) of the documents with any term: number of all terms; the known ones, by number."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = known.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                ids, n, found, tfs = [], [], [], []
                for name, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                    counts = Counter(terms(text.as_py()))
                    if counts:
                        ids.append(name)
                        n.append(counts.total())
                        mine = [(numbers[t], c) for t, c in counts.items() if t in numbers]
                        found.append([t for t, _ in mine])
                        tfs.append([c for _, c in mine])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                    ["id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return stage(rows.mapInArrow(count, "id long, n long, terms array<int>, tfs array<long>"), "ls-vectors")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search_block(docs: DataFrame, items: Sequence, k: int, id_col: str, text_col: str) -> DataFrame:
    """(num, id, score): per task the best ``k`` documents of each of the items (num, terms)."""
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for item in items for t in item["terms"]}))}
    vectors = restricted(docs, vocabulary, id_col, text_col)
    n_docs, length = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # At most a row per term of the block.
    found = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    df = np.zeros(len(vocabulary), np.int64)
    df[found["term"].to_numpy()] = found["count"].to_numpy()
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(df))
    weights = np.zeros(len(df), np.int64)
    weights[rank] = [weight(n_docs, int(x)) for x in df]
    asked = {item["num"]: np.sort(rank[[vocabulary[bytes(t)] for t in item["terms"]]]) for item in items}
    shared = docs.sparkSession.sparkContext.broadcast((rank, weights, asked))

    def best_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, weights, asked = shared.value
        best: dict[int, list[tuple[int, int]]] = {num: [] for num in asked}
        mine = np.zeros(len(weights), np.int64)
        for trie in tries(batches, rank, weights, n_docs, length):
            for num, ranks in asked.items():
                mine[ranks] = weights[ranks]
                trie.search(mine, best[num], k)
                mine[ranks] = 0
        rows = [(num, None if -name == NO_ID else -name, score) for num, some in best.items() for score, name in some]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["num", "id", "score"])

    return vectors.where("size(terms) > 0").select("id", "n", "terms", "tfs").mapInArrow(best_of, "num long, id long, score long")


def tries(batches: Iterator[pa.RecordBatch], rank: np.ndarray, weights: np.ndarray, n_docs: int, length: int) -> Iterator[Trie]:
    """Tries of at most TRIE documents; terms without weight are left out."""
    ids, m, ranks, tfs = [], [], [], []
    for batch in batches:
        n = batch.column("n").to_numpy()
        size = 100 - 90 + (90 * n * n_docs) // length
        names = batch.column("id").fill_null(NO_ID).to_numpy()
        owner = batch.column("terms").value_lengths().to_numpy()
        ends = np.cumsum(owner)
        of, times = rank[batch.column("terms").flatten().to_numpy()], batch.column("tfs").flatten().to_numpy()
        for i, (a, b) in enumerate(zip((ends - owner).tolist(), ends.tolist(), strict=True)):
            r, t = of[a:b], times[a:b]
            use = np.flatnonzero(weights[r] > 0)
            if not len(use):
                continue
            use = use[np.argsort(r[use])]
            ids.append(names[i])
            m.append(size[i])
            ranks.append(r[use])
            tfs.append(t[use])
            if len(ids) == TRIE:
                yield Trie(np.array(ids), np.array(m), ranks, tfs)
                ids, m, ranks, tfs = [], [], [], []
    if ids:
        yield Trie(np.array(ids), np.array(m), ranks, tfs)


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, id, score): the ``k`` best documents with a score above 0 of every item, equal scores by ascending id."""
    asked = item_terms(items, item_id, item_text)
    total = asked.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    found = None
    for block in range(blocks):
        # About ``block_bytes`` of terms.
        some = asked.where(F.pmod(F.xxhash64("num"), F.lit(blocks)) == block).select("num", "terms").collect()
        if some:
            part = stage(search_block(docs, some, k, id_col, text_col), "ls-best")
            found = part if found is None else found.unionAll(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "num long, id long, score long")
    order = Window.partitionBy("num").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = asked.select(F.col("num").alias("i"), "item_id")
    return top.join(names, F.expr("num = i")).select("item_id", "rank", "id", "score")
