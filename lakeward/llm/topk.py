"""Exact top-k by inner product with cover trees over queries and over data.

Vectors are stored in blocks. A block of queries meets every block of data; each side is a
cover tree, and pairs of nodes are pruned together: the largest inner product between two
nodes follows from their centres and covering radii, and if it is below the worst k-th score
of the query node's queries, no pair under them matters. A task keeps each query's best k from
one data block to the next, so bounds tighten as it goes. The best k of all tasks are merged last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.common import staged

SCALE = 1024
DATA_BLOCK, QUERY_BLOCK, LEAF = 2048, 512, 32
KEPT_TREES = 16
# Tasks, at least, that share the data blocks of one dimension.
LEAST_SPREAD = 64

_BLOCK = "block bigint, dim int, ids binary, vectors binary"
_LOWEST = np.iinfo(np.int64).min
# Scores are refused from here on, a little below what 64 bits hold, as they are estimated in doubles.
_LARGEST = 2.0**63 * (1 - 1e-9)


class Node:
    __slots__ = ("centre", "norm", "radius", "points", "children", "worst")

    def __init__(self, centre: np.ndarray, radius: float, points: np.ndarray, children: list):
        self.centre, self.radius, self.points, self.children = centre, radius, points, children
        self.norm = float(np.sqrt(centre @ centre))
        self.worst = _LOWEST


def cover_tree(vectors: np.ndarray, points: np.ndarray | None = None, first: int = 0) -> Node:
    """A node covers its points within its radius; its children are a net of half that radius.

    Children of one point are kept in their parent, to be compared at once.
    """
    points = np.arange(len(vectors)) if points is None else points
    centre = vectors[first]
    distances = np.sqrt(((vectors[points] - centre) ** 2).sum(axis=1))
    radius = float(distances.max()) * (1 + 1e-12)
    if len(points) <= LEAF or radius == 0:
        return Node(centre, radius, points, [])
    single, children = [], []
    rest, near = points, distances <= radius / 2
    while True:
        covered = rest[near]
        if len(covered) == 1:
            single.append(covered)
        elif len(covered):
            children.append(cover_tree(vectors, covered, first))
        rest = rest[~near]
        if not len(rest):
            break
        first = int(rest[0])
        near = np.sqrt(((vectors[rest] - vectors[first]) ** 2).sum(axis=1)) <= radius / 2
    return Node(centre, radius, np.concatenate(single) if single else np.zeros(0, np.int64), children)


class Search:
    """The best k of each query of a block, over the data blocks shown to it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors.astype(np.float64), k
        self.exact = vectors
        self.tree = cover_tree(self.vectors)
        self.worst = np.full(len(ids), _LOWEST)
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]  # (-score, id), in order

    def add(self, ids: np.ndarray, exact: np.ndarray, tree: Node) -> None:
        data = exact.astype(np.float64)
        # Doubles hold the scores exactly up to here, and multiply faster.
        whole = max(1.0, np.abs(data).max(initial=0)) * max(1.0, np.abs(self.vectors).max(initial=0)) * data.shape[1] < 2**53
        self._visit(self.tree, tree, ids, data if whole else exact, whole)

    def _bounds(self, q: Node, nodes: list[Node]) -> np.ndarray:
        centres = np.array([n.centre for n in nodes]) @ q.centre
        norms, radii = np.array([n.norm for n in nodes]), np.array([n.radius for n in nodes])
        most = centres + q.norm * radii + norms * q.radius + radii * q.radius
        return most + 1e-9 * (np.abs(most) + q.norm * norms) + 1

    def _worst(self, q: Node) -> int:
        parts = [int(self.worst[q.points].min())] if len(q.points) else []
        return min(parts + [self._worst(c) for c in q.children])

    def _visit(self, q: Node, d: Node, ids: np.ndarray, data: np.ndarray, whole: bool) -> None:
        if len(d.points):
            self._compare(self._under(q), d.points, ids, data, whole)
        if not d.children:
            return
        bounds = self._bounds(q, d.children)
        for i in np.argsort(-bounds):
            if bounds[i] < self._worst(q):
                break
            if not q.children or d.children[i].radius >= q.radius:
                self._visit(q, d.children[i], ids, data, whole)
                continue
            parts = list(q.children)
            if len(q.points):
                parts.append(Node(q.centre, q.radius, q.points, []))
            for part in parts:
                if self._bounds(part, [d.children[i]])[0] >= self._worst(part):
                    self._visit(part, d.children[i], ids, data, whole)

    def _under(self, q: Node) -> np.ndarray:
        return np.concatenate([q.points, *(self._under(c) for c in q.children)]) if q.children else q.points

    def _compare(self, queries: np.ndarray, points: np.ndarray, ids: np.ndarray, data: np.ndarray, whole: bool) -> None:
        own = (self.vectors if whole else self.exact)[queries]
        for at in range(0, len(points), 4096):
            part = points[at : at + 4096]
            if not whole and (np.abs(self.vectors[queries] @ data[part].astype(np.float64).T) >= _LARGEST).any():
                raise OverflowError("a score does not fit into 64 bits")
            scores = (own @ data[part].T).astype(np.int64)
            hits = (scores >= self.worst[queries, None]) & (ids[part] != self.ids[queries, None])
            for row in np.flatnonzero(hits.any(axis=1)):
                q, hit = queries[row], hits[row]
                score, found = scores[row, hit], ids[part][hit]
                order = np.lexsort((found, -score))[: self.k]
                merged = sorted(self.best[q] + list(zip((-score[order]).tolist(), found[order].tolist())))[: self.k]
                self.best[q] = merged
                if len(merged) == self.k:
                    self.worst[q] = -merged[-1][0]


def _blocks(size: int):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[int, list[tuple[int, list[int]]]] = {}

        def block(dim: int, rows: list) -> pa.RecordBatch:
            nonlocal number
            number += 1
            ids = np.array([r[0] for r in rows], np.int64)
            vectors = np.array([r[1] for r in rows], np.int64).reshape(len(rows), dim)
            columns = ([number], [dim], [ids.tobytes()], [vectors.tobytes()])
            types = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["block", "dim", "ids", "vectors"])

        for batch in batches:
            for vec_id, vector in zip(batch["id"].to_pylist(), batch["vector"].to_pylist()):
                rows = waiting.setdefault(len(vector), [])
                rows.append((vec_id, vector))
                if len(rows) == size:
                    yield block(len(vector), waiting.pop(len(vector)))
        for dim, rows in waiting.items():
            yield block(dim, rows)

    return mapped


_FOUND = "q_block bigint, place bigint, query_id bigint, vec_id bigint, score bigint"


def _search(k: int):
    """Rows come sorted by query block. The trees of the data blocks met last are kept."""

    def finish(block: int, search: Search) -> pa.RecordBatch:
        rows = [(block, n, int(q), i, -s) for n, (q, best) in enumerate(zip(search.ids, search.best)) for s, i in best]
        names = [field.split()[0] for field in _FOUND.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(5)], names)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, search = None, None
        trees: dict[int, Node] = {}
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch[c][i].as_py() for c in batch.schema.names}
                q_ids, q_vectors, ids, vectors = (np.frombuffer(row[c], np.int64) for c in ("q_ids", "q_vectors", "ids", "vectors"))
                if row["q_block"] != held:
                    if search:
                        yield finish(held, search)
                    held, search = row["q_block"], Search(q_ids, q_vectors.reshape(len(q_ids), row["dim"]), k)
                vectors = vectors.reshape(len(ids), row["dim"])
                tree = trees.pop(row["block"], None) or cover_tree(vectors.astype(np.float64))
                trees[row["block"]] = tree
                if len(trees) > KEPT_TREES:
                    del trees[next(iter(trees))]
                search.add(ids, vectors, tree)
        if search:
            yield finish(held, search)

    return mapped


def top_k(embeddings: DataFrame, is_query: F.Column, k: int = 10, scale: int = SCALE) -> DataFrame:
    """The ``k`` best rows for each query: query_id, rank (from 1), vec_id, score.

    Components become floor(scale * x); the score is their inner product in 64-bit integers.
    Queries are the rows where ``is_query`` holds, candidates all rows of the same length but those with the query's vec_id; all are
    given if there are fewer than ``k``. Ties go to the smaller vec_id. Rows whose vec_id, vector
    or a component is null, or a component is not finite, take no part. A query row that repeats
    is asked once, rows that share a vec_id are queries of their own; a candidate row that repeats is listed as often. Other columns are not read.
    """
    vector = F.transform(F.col("embedding"), lambda x: F.floor(x.cast("double") * scale))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
    rows = rows.select(F.col("vec_id").cast("bigint").alias("id"), vector.alias("vector"), is_query.alias("asks"))
    data = staged(rows.select("id", "vector").mapInArrow(_blocks(DATA_BLOCK), _BLOCK), "vectors")
    asked = rows.where("asks").select("id", "vector").distinct()
    queries = staged(asked.mapInArrow(_blocks(QUERY_BLOCK), _BLOCK), "queries")

    # Enough salts that a task holds a few blocks of data, however many there are.
    spread = max(LEAST_SPREAD, data.count() // 4)
    salted = data.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(spread)))
    asking = queries.select(
        F.col("block").alias("q_block"), "dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))).alias("salt"),
    )
    met = salted.join(asking, ["dim", "salt"]).repartition(spread, "salt").sortWithinPartitions("q_block", "block")
    found = met.select("q_block", "dim", "q_ids", "q_vectors", "block", "ids", "vectors").mapInArrow(_search(k), _FOUND)
    rank = F.row_number().over(Window.partitionBy("q_block", "place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
