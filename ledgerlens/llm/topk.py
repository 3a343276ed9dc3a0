"""Exact top-k search by inner product: best-first search over M-trees.

Inner products become distances by one more component: with x' = (x, sqrt(M - |x|^2)),
M the largest squared norm, and q' = (q, 0), the squared distance of q' and x' is
|q|^2 + M - 2 q.x, so the nearest vectors have the highest products.

Vectors are dealt into blocks of about ``block_rows``, queries into blocks of about
``query_rows``; each pair of blocks is one group: an M-tree over the vectors (paged nodes
with a routing vector, covering radius and distance to the parent's routing vector)
answers all queries of the block.  A query first meets its nearest leaf; then it goes down
the tree where the triangle inequality leaves room for a better product, stored parent
distances ruling out children before any distance is computed, and visits the leaves best
first (turns grouped in growing steps) while their bound is no worse than its k-th product.
Queries that visit the same page at the same step share one matrix product over the entries that the stored distances
leave.  Products are exact whole numbers; bounds carry a slack beyond rounding, so ties are
never cut.  The k best of each block meet in a window over the query.

Defined results: vectors that are null or hold a null take no part, nor do rows without id.
Rows that repeat (same id and vector) are searched once and take as many places as they stand
for; queries that repeat are asked once, and those of one id with several vectors share its places.  A query never meets its own id.
Shorter vectors count as ended with zeros.  Fewer than k candidates: all of them.
Products must fit 64 bits.  Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PAGE = 256
FAN_OUT = 64
BLOCK_ROWS = 16_384
QUERY_ROWS = 4_096
_NONE = np.iinfo(np.int64).min


class Node:
    """A page: a leaf's vectors or an inner node's children, each with its distance to ``pivot``."""

    __slots__ = ("children", "pivot", "radius", "rows", "to_pivot")


class MTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE, names: np.ndarray | None = None):
        """``names``: what a query's own rows are known by; the ids themselves by default."""
        self.ids, self.exact = ids, vectors
        self.names = ids if names is None else names
        self.points = vectors.astype(np.float64)
        norms = np.einsum("ij,ij->i", self.points, self.points)
        self.most = float(norms.max(initial=0.0))
        self.last = np.sqrt(np.maximum(self.most - norms, 0.0))
        self.page = page
        self.whole = self.most * max(1, vectors.shape[1]) < 2**50  # products fit a double exactly
        self.rng = np.random.default_rng(len(ids))
        self.root = self._build(np.arange(len(ids)), 0) if len(ids) else None

    def _distance(self, rows: np.ndarray, pivot: int) -> np.ndarray:
        gap = self.points[rows] - self.points[pivot]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap) + (self.last[rows] - self.last[pivot]) ** 2)

    def _build(self, rows: np.ndarray, pivot_at: int) -> Node:
        node = Node()
        node.pivot = int(rows[pivot_at])
        node.children = None
        near = self._distance(rows, node.pivot)
        node.radius = float(near.max())
        if len(rows) <= self.page:
            node.rows, node.to_pivot = rows, near
            return node
        node.rows = None
        # routing vectors: some of the node's own; every entry goes to the nearest
        chosen = [pivot_at]
        least, owner = near, np.zeros(len(rows), np.int64)
        fan_out = min(FAN_OUT, -(-len(rows) // self.page) + 1)
        for at in self.rng.choice(len(rows), fan_out - 1, replace=False):
            if least[at] > 0:
                d = self._distance(rows, int(rows[at]))
                owner = np.where(d < least, len(chosen), owner)
                least = np.minimum(d, least)
                chosen.append(int(at))
        if len(chosen) == 1:  # alike, or nearly all: plain pages
            groups = [(rows[i : i + self.page], 0) for i in range(0, len(rows), self.page)]
        else:
            groups = []
            for k, at in enumerate(chosen):
                own = np.flatnonzero(owner == k)
                groups.append((rows[own], int(np.flatnonzero(own == at)[0])))
        node.children = [self._build(part, at) for part, at in groups]
        node.to_pivot = self._distance(np.array([c.pivot for c in node.children]), node.pivot)
        return node

    def search(self, queries: np.ndarray, k: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, products), a row for each query: its k best but those with its own name, by product, ties to
        smaller ids.  Places beyond the candidates hold the score ``_NONE``."""
        return _Search(self, queries, k, own).run()


class _Search:
    """One search of a block of queries."""

    def __init__(self, tree: MTree, queries: np.ndarray, k: int, own: np.ndarray):
        self.tree, self.exact, self.k, self.own = tree, queries, k, own
        self.q = queries.astype(np.float64)
        norms = np.einsum("ij,ij->i", self.q, self.q)
        self.base = norms + tree.most
        self.slack = 1e-9 * (self.base + 1.0) + 1e-6
        self.whole = tree.whole and float(self.base.max(initial=0.0)) < 2**50
        self.ids = np.full((len(queries), k), -1, np.int64)
        self.scores = np.full((len(queries), k), _NONE)
        self.worst = np.full(len(queries), -np.inf)

    def run(self):
        tree, every = self.tree, np.arange(len(self.q))
        if tree.root is None:
            return self.ids, self.scores
        d = self._distances(every, [tree.root.pivot])[:, 0]
        self.seeds: dict[int, np.ndarray] = {}
        self._seed(tree.root, every, d)
        self.stops: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.leaves: list[Node] = []
        self._route(tree.root, every, d, np.maximum(0.0, d - tree.root.radius))
        if not self.stops:
            return self.ids, self.scores
        who = np.concatenate([w for w, _, _ in self.stops])
        d = np.concatenate([x for _, x, _ in self.stops])
        low = np.concatenate([x for _, _, x in self.stops])
        leaf = np.repeat(np.arange(len(self.stops)), [len(w) for w, _, _ in self.stops])
        order = np.lexsort((low, who))
        who, d, low, leaf = who[order], d[order], low[order], leaf[order]
        # turns go together in growing steps: 1st, 2nd, 3rd and 4th, 5th to 8th, ...
        turn = np.arange(len(who)) - np.searchsorted(who, who)
        turn = np.ceil(np.log2(turn + 1)).astype(np.int64)
        order = np.lexsort((leaf, turn))
        bounds = np.flatnonzero(np.diff(turn[order] * (len(self.stops) + 1) + leaf[order], prepend=-1))
        for part in np.split(order, bounds[1:]) if len(order) else []:
            part = part[self._upper(who[part], low[part]) >= self.worst[who[part]]]
            if len(part):
                self._visit(self.leaves[leaf[part[0]]], who[part], d[part])
        return self.ids, self.scores

    def _distances(self, who: np.ndarray, rows) -> np.ndarray:
        return np.sqrt(np.maximum(self.base[who][:, None] - 2.0 * (self.q[who] @ self.tree.points[rows].T), 0.0))

    def _upper(self, who: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """The highest product that a distance of at least this allows."""
        base, slack = self.base[who], self.slack[who]
        if distance.ndim == 2:
            base, slack = base[:, None], slack[:, None]
        return (base - np.maximum(distance, 0.0) ** 2) / 2 + slack

    def _seed(self, node: Node, who: np.ndarray, d: np.ndarray) -> None:
        """Each query visits one leaf: down the child with the least distance."""
        if node.children is None:
            self.seeds[id(node)] = who
            self._visit(node, who, d)
            return
        near = self._distances(who, [c.pivot for c in node.children])
        best = near.argmin(axis=1)
        for j in np.unique(best):
            at = best == j
            self._seed(node.children[j], who[at], near[at, j])

    def _route(self, node: Node, who: np.ndarray, d: np.ndarray, low: np.ndarray) -> None:
        if node.children is None:
            new = ~np.isin(who, self.seeds.get(id(node), []))
            self.stops.append((who[new], d[new], low[new]))
            self.leaves.append(node)
            return
        radii = np.array([c.radius for c in node.children])
        worst = self.worst[who][:, None]
        # by stored parent distances, before any distance is computed
        may = self._upper(who, np.abs(d[:, None] - node.to_pivot) - radii) >= worst
        open_at = np.flatnonzero(may.any(axis=0))
        near = self._distances(who, [node.children[j].pivot for j in open_at])
        least = np.maximum(0.0, near - radii[open_at])
        may = may[:, open_at] & (self._upper(who, least) >= worst)
        for j, at in enumerate(open_at):
            go = may[:, j]
            if go.any():
                self._route(node.children[at], who[go], near[go, j], least[go, j])

    def _visit(self, leaf: Node, who: np.ndarray, d: np.ndarray) -> None:
        worst = self.worst[who][:, None]
        may = self._upper(who, np.abs(d[:, None] - leaf.to_pivot)) >= worst
        rows = leaf.rows[may.any(axis=0)]
        if not len(rows):
            return
        if self.whole:
            got = np.rint(self.q[who] @ self.tree.points[rows].T).astype(np.int64)
        else:
            got = self.exact[who] @ self.tree.exact[rows].T
        ids = self.tree.ids[rows]
        take = (got >= worst) & (self.tree.names[rows] != self.own[who][:, None])
        if len(rows) > self.k:  # the k best of the page and their ties; rows with the query's id are none of them
            others = np.where(take, got, _NONE)
            take &= got >= np.partition(others, -self.k, axis=1)[:, -self.k][:, None]
        at, place = np.nonzero(take)
        mine = np.arange(len(who))
        old = self.ids[who]
        held_at, held = np.nonzero(self.scores[who] > _NONE)
        row = np.concatenate([held_at, at])
        new_ids = np.concatenate([old[held_at, held], ids[place]])
        new_scores = np.concatenate([self.scores[who][held_at, held], got[at, place]])
        order = np.lexsort((new_ids, -new_scores, row))
        row, new_ids, new_scores = row[order], new_ids[order], new_scores[order]
        rank = np.arange(len(row)) - np.searchsorted(row, mine)[row]
        keep = rank < self.k
        self.ids[who[row[keep]], rank[keep]] = new_ids[keep]
        self.scores[who[row[keep]], rank[keep]] = new_scores[keep]
        full = self.scores[who, self.k - 1] > _NONE
        self.worst[who[full]] = self.scores[who[full], self.k - 1]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    page: int = PAGE,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for frames of (vec_id, vector array<bigint>)."""
    usable = F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull())
    data = vectors.where(usable).groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("copies"))
    asked = queries.where(usable).select("vec_id", "vector").distinct()
    n_data, n_asked = data.count(), asked.count()
    blocks, query_blocks = max(1, -(-n_data // block_rows)), max(1, -(-n_asked // query_rows))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = data.select("*", dealt(blocks).alias("b")).select("*", every(query_blocks).alias("qb"))
    right = asked.select("*", dealt(query_blocks).alias("qb")).select("*", every(blocks).alias("b"))
    names = ["query_id", "vec_id", "score", "copies"]

    def answer(d: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        width = max([1, *map(len, d["vector"]), *map(len, q["vector"])])
        if not len(d) or not len(q):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in names})
        d = d.sort_values("vec_id", kind="stable")
        vec_id, copies = d["vec_id"].to_numpy(np.int64), d["copies"].to_numpy(np.int64)
        # rows go by their place in the order of the ids, which keeps ties and tells apart rows of one id
        tree = MTree(np.arange(len(d)), _matrix(d["vector"], width), page, vec_id)
        own = q["vec_id"].to_numpy(np.int64)
        rows, scores = tree.search(_matrix(q["vector"], width), k, own)
        found = (scores > _NONE).ravel()
        rows = rows.ravel()[found]
        return pd.DataFrame(dict(zip(names, (np.repeat(own, k)[found], vec_id[rows], scores.ravel()[found], copies[rows]), strict=True)))

    near = left.groupBy("b", "qb").cogroup(right.groupBy("b", "qb")).applyInPandas(answer, ", ".join(f"{c} bigint" for c in names))
    # a row that stands several times takes as many places
    near = near.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(k)).cast("int"))))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def whole_steps(vector: str, steps: int = 256):
    """floor(steps * x) of each component, x as double; null for a vector that holds a null or a non-finite one."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.when(~bad, F.transform(x, lambda v: F.floor(F.lit(float(steps)) * v)))
