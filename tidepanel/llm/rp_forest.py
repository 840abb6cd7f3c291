"""Approximate nearest neighbours by inner product with a forest of random-projection trees.

The trees are fitted on a bounded sample; every row is put into one leaf of each tree. A query
walks all trees through one priority queue: the side of a split that it lies on costs nothing,
the other side costs its squared distance from the split, and leaves are visited in the order of
that cost until a fixed share of all leaves has been, and until the leaves visited in one tree hold
enough rows. Rows of visited leaves are candidates; their inner products on the original vectors decide.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField

from tidepanel.llm.common import with_arrow_columns
from tidepanel.llm.vectors import matrix, meet, ranked, usable
from tidepanel.session import materialize

TREES, DEPTH = 8, 7

#: share of all leaves of all trees that a query visits; measured recall at 20 is 0.95 or more
SHARE = 0.16

#: rows that the visited leaves of one tree must hold, or all leaves are visited
LEAST = 400

#: rows that the splits are fitted on; all rows are indexed
SAMPLE = 16384

FOUND = "query_id long, vec_id long, score double"


@dataclass
class Forest:
    """Splits of complete binary trees, in breadth-first order: directions and thresholds."""

    directions: np.ndarray  #: trees x splits x dimensions
    thresholds: np.ndarray  #: trees x splits

    @property
    def leaves(self) -> int:
        return self.thresholds.shape[1] + 1

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in each tree: vectors x trees."""
        out = np.zeros((len(vectors), len(self.thresholds)), np.uint8 if self.leaves <= 256 else np.uint16)
        for t, (directions, thresholds) in enumerate(zip(self.directions, self.thresholds)):
            node = np.zeros(len(vectors), int)
            while len(node) and node[0] < len(thresholds):
                right = np.einsum("ij,ij->i", vectors, directions[node]) > thresholds[node]
                node = 2 * node + 1 + right
            out[:, t] = node - len(thresholds)
        return out

    def visit(self, query: np.ndarray, share: float, counts: np.ndarray | None = None, least: int = 0) -> np.ndarray:
        """Which leaves a query visits: trees x leaves. ``counts`` are the rows of each leaf. A row is in one leaf of a
        tree, so ``least`` rows of one tree are as many different candidates."""
        sides = self.directions @ query - self.thresholds
        inner = self.thresholds.shape[1]
        seen = np.zeros((len(self.thresholds), self.leaves), bool)
        left = math.ceil(share * seen.size)
        held = np.zeros(len(seen), np.int64)
        queue = [(0.0, t, 0) for t in range(len(seen))]
        margins = sides.tolist()
        while queue and (left > 0 or (counts is not None and held.max() < least)):
            cost, tree, node = heapq.heappop(queue)
            while node < inner:  # follow the near side, leave the far one in the queue
                side = margins[tree][node]
                right = side > 0
                heapq.heappush(queue, (cost + side * side, tree, 2 * node + 1 + (not right)))
                node = 2 * node + 1 + right
            seen[tree, node - inner] = True
            if counts is not None:
                held[tree] += counts[tree, node - inner]
            left -= 1
        return seen


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, sample: int = SAMPLE, seed: int = 7) -> Forest | None:
    """A forest from at most ``sample`` rows, the first in the order of a hash; None without rows.

    A split's direction is that between two random rows of those that reach it (any direction, if these are equal or fewer
    than two), its threshold their median.
    """
    chosen = rows.orderBy(F.xxhash64("vec_id", F.lit("forest")), "vec_id").select("v").limit(sample).toArrow()
    x = matrix(chosen["v"])
    if not len(x):
        return None
    rng = np.random.default_rng(seed)
    inner = 2**depth - 1
    directions = rng.standard_normal((trees, inner, x.shape[1]))
    thresholds = np.zeros((trees, inner))
    for t in range(trees):
        node = np.zeros(len(x), int)
        for k in range(inner):
            here = np.flatnonzero(node == k)
            if len(here) > 1:
                one, other = rng.choice(here, 2, replace=False)
                if (x[one] != x[other]).any():
                    directions[t, k] = x[one] - x[other]
            directions[t, k] /= np.linalg.norm(directions[t, k])
            if len(here):
                along = x[here] @ directions[t, k]
                thresholds[t, k] = np.median(along)
                node[here] = 2 * k + 1 + (along > thresholds[t, k])
    return Forest(directions, thresholds)


def _with_bytes(df: DataFrame, name: str, of) -> DataFrame:
    """``df`` with the bytes that ``of`` makes of each matrix of vectors."""

    def make():
        return lambda vectors: [pa.array([x.tobytes() for x in of(np.array(vectors, float))] if vectors else [], pa.binary())]

    return with_arrow_columns(df, "v", [StructField(name, BinaryType())], make)


def leaf_counts(rows: DataFrame, trees: int, leaves: int) -> np.ndarray:
    """Rows of each leaf, trees x leaves, from the ``leaf`` bytes of all rows; one row a leaf reaches the driver."""
    kind = np.uint8 if leaves <= 256 else np.uint16

    def count(batches):
        total = np.zeros((trees, leaves), np.int64)
        for batch in batches:
            leaf = np.frombuffer(b"".join(batch.column(0).to_pylist()), kind).reshape(-1, trees)
            for t in range(trees):
                total[t] += np.bincount(leaf[:, t], minlength=leaves)
        tree, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(at), pa.array(total[tree, at])], ["tree", "at", "n"])

    out = np.zeros((trees, leaves), np.int64)
    for r in rows.select("leaf").mapInArrow(count, "tree long, at long, n long").groupBy("tree", "at").agg(F.sum("n").alias("n")).collect():
        out[r["tree"], r["at"]] = r["n"]
    return out


def exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products pair by pair, added up component after component: equal vectors give equal scores."""
    total = np.zeros(len(queries))
    for j in range(rows.shape[1]):
        total += queries[:, j] * rows[:, j]
    return total


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, share: float = SHARE, forest: Forest | None = None, least: int = LEAST
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` nearest rows among its candidates.

    Both tables hold ``vec_id, v`` (see ``usable``). Rows with the query's own id are no candidates of
    it. A query visits leaves until ``share`` of them and ``least`` rows are reached, so tables of up to
    ``least`` rows are searched whole and no list is short. Ties go to the smaller id. Rows that repeat an id are candidates each;
    queries that repeat one are one query, with the smallest of their vectors. Empty tables give an
    empty result.
    """
    forest = forest or fit(vectors)
    if forest is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    trees, leaves = forest.thresholds.shape[0], forest.leaves
    rows = materialize(_with_bytes(vectors, "leaf", forest.leaf_of), "forest-rows")
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    counts = leaf_counts(rows, trees, leaves)
    asked = _with_bytes(asked, "visits", lambda q: [np.packbits(forest.visit(x, share, counts, least)) for x in q])
    asked = materialize(asked, "forest-queries")
    kind = np.uint8 if leaves <= 256 else np.uint16

    def search(block: pa.Table, wanted: pa.Table) -> pa.Table:
        out = []
        if block.num_rows and wanted.num_rows:
            ids, x = np.asarray(block["vec_id"]), matrix(block["v"])
            leaf = np.frombuffer(b"".join(block["leaf"].to_pylist()), kind).reshape(len(ids), trees)
            asking, q = np.asarray(wanted["vec_id"]), matrix(wanted["v"])
            visits = np.unpackbits(np.frombuffer(b"".join(wanted["visits"].to_pylist()), np.uint8).reshape(len(asking), -1), axis=1)
            visits = visits[:, : trees * leaves].reshape(len(asking), trees, leaves).astype(bool)
            members = [[np.flatnonzero(leaf[:, t] == n) for n in range(leaves)] for t in range(trees)]
            for at in range(0, len(asking), 256):
                out.append(_best(ids, x, members, asking[at : at + 256], q[at : at + 256], visits[at : at + 256], k))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["query_id", "vec_id", "score"])

    return ranked(meet(rows, asked, search, FOUND), k)


def _best(ids, x, members, asking, q, visits, k) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best candidates of a block for each of some queries."""
    scores = np.full((len(asking), len(ids)), -np.inf)
    for t, lists in enumerate(members):
        for n, rows in enumerate(lists):
            asked = np.flatnonzero(visits[:, t, n])
            if len(rows) and len(asked):
                scores[np.ix_(asked, rows)] = q[asked] @ x[rows].T
    scores[asking[:, None] == ids[None, :]] = -np.inf
    # a matrix product may round equal vectors differently: keep all that could be among the k best
    least = np.partition(scores, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(asking), -np.inf)
    slack = 1e-12 * x.shape[1] * np.abs(q).max(1) * np.abs(x).max()
    who, which = np.nonzero((scores >= (least - slack)[:, None]) & (scores > -np.inf))
    score = exact(q[who], x[which])
    order = np.lexsort((ids[which], -score, who))
    who, which, score = who[order], which[order], score[order]
    place = np.arange(len(who)) - np.searchsorted(who, who)
    keep = place < k
    return asking[who[keep]], ids[which[keep]], score[keep]
