"""Hard negatives of anchors, by score bounds along a spanning tree of the anchors.

Anchors are packed into blocks of near ones; a block is a minimum spanning tree. The score of a
candidate at a child differs from its score at the parent by at most the edge's length times the
candidate's norm. Walking the tree, a task holds an interval for each candidate's score, and computes
the score itself only where the interval meets what the anchor still looks for: same-label scores
above its positives so far, or scores within its windows and above the negatives so far.

Blocks of anchors meet groups of candidate blocks, so what is shuffled is each vector once per
block group of the other side, and no task holds more than a few blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.common import staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
# A negative scores from LEAST_PERCENT to MOST_PERCENT of its positive.
LEAST_PERCENT, MOST_PERCENT = 30, 90

ANCHOR_BLOCK, CANDIDATE_BLOCK = 256, 2048
ANCHOR_BLOCKS_PER_TILE, CANDIDATE_BLOCKS_PER_TILE = 16, 64
# Candidate blocks are dealt to at least so many tiles, if there are as many.
LEAST_TILES = 64
# Anchors near the same one of these stand together; any choice gives the same result.
PIVOTS = 64

_LOWEST, _HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_CANDIDATES = "block bigint, dim int, ids binary, labels binary, vectors binary"
_ANCHORS = f"{_CANDIDATES}, parents binary, edges binary"
_FOUND = "anchor_id bigint, block bigint, place int, vec_id bigint, score bigint"


def whole_components(vectors: list[list[float]], scale: int) -> np.ndarray:
    """floor(scale * x) of each component, as 64-bit integers; refuses what they cannot hold."""
    floors = np.floor(np.array(vectors, np.float64).reshape(len(vectors), -1) * scale)
    if not (np.abs(floors) < 2.0**63).all():
        raise OverflowError("a scaled component does not fit into 64 bits")
    return floors.astype(np.int64)


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the vectors in which each follows its parent in a minimum spanning tree (Prim's), the
    parents' places in that order (-1 for the first), and the lengths of the edges, rounded up."""
    points = vectors.astype(np.float64)
    n = len(points)
    near, parent = np.full(n, np.inf), np.full(n, -1)
    order, parents, edges = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    placed, at = np.full(n, -1), 0
    for step in range(n):
        placed[at], order[step] = step, at
        if step:
            parents[step], edges[step] = placed[parent[at]], near[at]
        distance = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
        closer = (distance < near) & (placed < 0)
        near[closer], parent[closer] = distance[closer], at
        at = int(np.argmin(np.where(placed < 0, near, np.inf)))
    return order, parents, edges * (1 + 1e-9) + 1e-9


class Block:
    """Rows of one length: ids, labels, whole components."""

    def __init__(self, row: dict):
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(self.ids), row["dim"])
        self.doubles = self.vectors.astype(np.float64)
        self.norms = np.sqrt((self.doubles**2).sum(axis=1)) * (1 + 1e-9)
        self.most = float(np.abs(self.doubles).max(initial=0))


class Anchors(Block):
    def __init__(self, row: dict):
        super().__init__(row)
        self.parents, self.edges = np.frombuffer(row["parents"], np.int64), np.frombuffer(row["edges"], np.float64)


def scores(candidates: Block, rows: np.ndarray, anchors: Anchors, place: int) -> np.ndarray:
    """Exact inner products; an error if one does not fit into 64 bits."""
    most = candidates.most * anchors.most * max(1, candidates.vectors.shape[1])
    if most < 2**53:  # doubles are exact up to here
        return (candidates.doubles[rows] @ anchors.doubles[place]).astype(np.int64)
    if most < 2**63:
        return candidates.vectors[rows] @ anchors.vectors[place]
    products = candidates.vectors[rows].astype(object) @ anchors.vectors[place].astype(object)
    if any(not _LOWEST <= p <= _HIGHEST for p in products):
        raise OverflowError("a score does not fit into 64 bits")
    return products.astype(np.int64)


def walk(
    anchors: Anchors,
    candidates: Block,
    wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray],
    take: Callable[[int, np.ndarray, np.ndarray], None],
) -> int:
    """Show each anchor's ``wanted`` candidates, with their exact scores, to ``take``; gives how many were scored.

    ``wanted`` gets bounds of the scores of all candidates, from below and above, and gives places.
    """
    size = (len(anchors.ids), len(candidates.ids))
    low, high = np.empty(size), np.empty(size)
    scored = 0
    for place in range(size[0]):
        parent = anchors.parents[place]
        if parent < 0:
            rows = np.arange(size[1])
        else:
            # Half a unit, and a billionth, cover what doubles round away.
            reach = anchors.edges[place] * candidates.norms + 0.5
            low[place], high[place] = low[parent] - reach, high[parent] + reach
            rows = wanted(place, low[place], high[place])
        if not len(rows):
            continue
        exact = scores(candidates, rows, anchors, place)
        scored += len(rows)
        take(place, rows, exact)
        slack = 1e-9 * np.abs(exact) if candidates.most * anchors.most * max(1, candidates.vectors.shape[1]) >= 2**53 else 0.0
        low[place, rows], high[place, rows] = exact - slack, exact + slack
    return scored


class Best:
    """The ``k`` best (score, id) per slot, better scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def worst(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else _LOWEST

    def add(self, found: np.ndarray, ids: np.ndarray) -> None:
        good = found >= self.worst
        found, ids = np.concatenate([self.scores, found[good]]), np.concatenate([self.ids, ids[good]])
        order = np.lexsort((ids, -found))[: self.k]
        self.scores, self.ids = found[order], ids[order]


def nearest_same_label(anchors: Anchors, groups: list[Block], k: int) -> list[Best]:
    """Each anchor's ``k`` best rows of its own label, itself left out."""
    best = [Best(k) for _ in anchors.ids]
    for candidates in groups:

        def wanted(place: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            fits = (candidates.labels == anchors.labels[place]) & (high >= best[place].worst)
            return np.flatnonzero(fits & (candidates.ids != anchors.ids[place]))

        def take(place: int, rows: np.ndarray, exact: np.ndarray) -> None:
            own = (candidates.labels[rows] == anchors.labels[place]) & (candidates.ids[rows] != anchors.ids[place])
            best[place].add(exact[own], candidates.ids[rows[own]])

        walk(anchors, candidates, wanted, take)
    return best


def window(score: int, percents: tuple[int, int]) -> tuple[int, int]:
    """The whole scores s with percents[0] * score <= 100 * s <= percents[1] * score."""
    return -(-percents[0] * score // 100), percents[1] * score // 100


def within_windows(anchors: Anchors, groups: list[Block], windows: list[list[tuple[int, int]]], k: int) -> list[list[Best]]:
    """For each window of each anchor, its ``k`` best rows of another label."""
    best = [[Best(k) for _ in own] for own in windows]
    for candidates in groups:

        def open_windows(place: int) -> list[tuple[int, int, Best]]:
            return [(max(lo, b.worst), hi, b) for (lo, hi), b in zip(windows[place], best[place])]

        def wanted(place: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            fits = np.zeros(len(low), bool)
            for lo, hi, _ in open_windows(place):
                if lo <= hi:
                    fits |= (high >= lo) & (low <= hi)
            return np.flatnonzero(fits & (candidates.labels != anchors.labels[place]))

        def take(place: int, rows: np.ndarray, exact: np.ndarray) -> None:
            other = candidates.labels[rows] != anchors.labels[place]
            for lo, hi, b in open_windows(place):
                fit = other & (exact >= lo) & (exact <= hi)
                if fit.any():
                    b.add(exact[fit], candidates.ids[rows[fit]])

        walk(anchors, candidates, wanted, take)
    return best


def _packed(size: int, scale: int, tree: bool):
    """Rows of one length, in the order they come, in blocks of ``size``."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[int, list[tuple[int, int, list[float]]]] = {}

        def block(dim: int, rows: list) -> pa.RecordBatch:
            nonlocal number
            number += 1
            vectors = whole_components([r[2] for r in rows], scale)
            ids, labels = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
            values = []
            if tree:
                order, parents, edges = spanning_tree(vectors)
                ids, labels, vectors = ids[order], labels[order], vectors[order]
                values = [parents, edges]
            binaries = [pa.array([v.tobytes()], pa.binary()) for v in (ids, labels, vectors, *values)]
            names = [f.split()[0] for f in (_ANCHORS if tree else _CANDIDATES).split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([dim], pa.int32()), *binaries], names)

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("id", "label", "vector"))):
                rows = waiting.setdefault(len(row[2]), [])
                rows.append(row)
                if len(rows) == size:
                    yield block(len(row[2]), waiting.pop(len(row[2])))
        for dim, rows in waiting.items():
            yield block(dim, rows)

    return mapped


def _nearest_pivot(pivots: dict[int, np.ndarray]):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, far = [], []
            for vector in batch["vector"].to_pylist():
                to = pivots.get(len(vector))
                distance = ((to - np.array(vector)) ** 2).sum(axis=1) if to is not None else np.zeros(1)
                near.append(int(distance.argmin()))
                far.append(float(distance.min()))
            columns = [*batch.columns, pa.array(near, pa.int32()), pa.array(far, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "pivot", "distance"])

    return mapped


def _rows(table: pa.Table) -> list[dict]:
    return table.sort_by("block").to_pylist()


def _result(rows: list[tuple]) -> pa.Table:
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
    names = [f.split()[0] for f in _FOUND.split(", ")]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def _positives_of_tile(k: int):
    def grouped(left: pa.Table, right: pa.Table) -> pa.Table:
        out, groups = [], [Block(row) for row in _rows(right)] if len(left) else []
        for row in _rows(left):
            anchors = Anchors(row)
            for place, best in enumerate(nearest_same_label(anchors, groups, k)):
                own = int(anchors.ids[place])
                out += [(own, row["block"], place, i, s) for i, s in zip(best.ids.tolist(), best.scores.tolist())]
        return _result(out)

    return grouped


def _negatives_of_tile(k: int, percents: tuple[int, int]):
    def grouped(left: pa.Table, right: pa.Table) -> pa.Table:
        out, groups = [], [Block(row) for row in _rows(right)] if len(left) else []
        for row in _rows(left):
            anchors = Anchors(row)
            windows: list[list[tuple[int, int]]] = [[] for _ in anchors.ids]
            for asked in row["asked"]:
                windows[asked["place"]] = [window(s, percents) for s in asked["scores"]]
            for place, slots in enumerate(within_windows(anchors, groups, windows, k)):
                found = {(i, s) for b in slots for i, s in zip(b.ids.tolist(), b.scores.tolist())}
                out += [(int(anchors.ids[place]), row["block"], place, i, s) for i, s in sorted(found)]
        return _result(out)

    return grouped


def _tiles(anchors: DataFrame, candidates: DataFrame, search) -> DataFrame:
    """``search`` on every tile: a group of anchor blocks and a group of candidate blocks of the same length."""
    n_anchors, n_candidates = anchors.count(), candidates.count()
    across = max(1, -(-n_anchors // ANCHOR_BLOCKS_PER_TILE))
    down = min(max(-(-n_candidates // CANDIDATE_BLOCKS_PER_TILE), -(-LEAST_TILES // across)), max(1, n_candidates))
    tasks = min(across * down, int(anchors.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def dealt(blocks: DataFrame, own: str, groups: int, other: str, times: int) -> DataFrame:
        group = F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
        placed = blocks.withColumn(own, group).withColumn(other, copies)
        return placed.repartition(tasks, "dim", "a", "c").groupBy("dim", "a", "c")

    return dealt(anchors, "a", across, "c", down).cogroup(dealt(candidates, "c", down, "a", across)).applyInArrow(search, _FOUND)


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percents: tuple[int, int] = (LEAST_PERCENT, MOST_PERCENT),
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Components become floor(scale * x); the score is their inner product. The positives of an anchor
    are the best other rows of its label; for each, the best rows of another label with
    percents[0] * positive_score <= 100 * negative_score <= percents[1] * positive_score follow. Better scores come
    first, ties by smaller vec_id; fewer rows are given if there are no more. Rows that lack a
    vec_id, label, vector or component, or whose component is not finite, take no part; rows are
    compared with rows of the same length. A vec_id stands for one row: of rows that share one,
    the first by label and vector takes part. A score or component beyond 64 bits stops the run with an
    error. Other columns are not read; an empty table gives no rows.
    """
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    rows = rows.select(
        F.col("vec_id").cast("bigint").alias("id"), is_anchor.alias("asks"),
        F.struct(F.col("label").cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("vector")).alias("row"),
    ).groupBy("id", "asks").agg(F.min("row").alias("row"))
    rows = staged(rows.select("id", "asks", "row.*"), "vectors")

    asking = rows.where("asks").select("id", "label", "vector")
    pivots: dict[int, list] = {}
    for row in asking.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).collect():
        pivots.setdefault(len(row["vector"]), []).append(row["vector"])
    near = asking.mapInArrow(_nearest_pivot({n: np.array(v) for n, v in pivots.items()}), "id bigint, label bigint, vector array<double>, pivot int, distance double")
    place = [F.size("vector"), "pivot", "distance", "id"]
    ordered = near.repartitionByRange(*place).sortWithinPartitions(*place).select("id", "label", "vector")
    anchors = staged(ordered.mapInArrow(_packed(ANCHOR_BLOCK, scale, True), _ANCHORS), "anchors")
    candidates = staged(rows.select("id", "label", "vector").mapInArrow(_packed(CANDIDATE_BLOCK, scale, False), _CANDIDATES), "candidates")

    first = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id"))
    found = _tiles(anchors, candidates, _positives_of_tile(positives)).withColumn("n", first).where(F.col("n") <= positives)
    found = staged(found.drop("n"), "positives")
    # At most ``positives`` scores per anchor and ANCHOR_BLOCK anchors per block are collected.
    per_anchor = found.groupBy("block", "place").agg(F.collect_list("score").alias("scores"))
    per_block = per_anchor.groupBy("block").agg(F.collect_list(F.struct("place", "scores")).alias("asked"))
    asked = staged(anchors.join(per_block, "block"), "asked")
    other = _tiles(asked, candidates, _negatives_of_tile(negatives, percents))
    pairs = found.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).join(
        other.select("anchor_id", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")), "anchor_id"
    )
    least, most = percents
    wide = {c: F.col(c).cast("decimal(20,0)") for c in ("positive_score", "negative_score")}
    fits = (wide["positive_score"] * least <= wide["negative_score"] * 100) & (wide["negative_score"] * 100 <= wide["positive_score"] * most)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    ranked = pairs.where(fits).withColumn("rank", rank).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
