"""Nearest neighbours by inner product: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample and sent to every task; every vector is put into its leaf. A
query takes leaves from a priority queue over the nodes seen so far. How many leaves are visited is
calibrated: for some queries the true neighbours are found by scanning all rows, and the visits
are widened until the wanted share of all of them lies in visited leaves, and of nearly each query's own at
least half. What that finds is measured on other queries. Where it takes more than half of the leaves, as
with vectors of little structure, the tree saves nothing: all leaves are visited, and the search is exact.
A query whose leaves hold too few candidates goes on. Neighbouring leaves make up cells of bounded size,
and a query is multiplied with the rows of the leaves that it visits in a cell; a leaf with many vectors, and
a cell with many visits, is split.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import saved, ship

#: Numbers in the sample that the tree is fitted on (rows times dimensions).
FITTED = 2_000_000
BRANCH = 16
#: Rows per leaf that the depth of the tree aims at, and the least sample rows that a leaf is cut from.
LEAF_ROWS = 256
SAMPLE_LEAF = 8
#: Queries that the visits are calibrated with, and as many others that the recall is measured with.
CALIBRATED = 100
RECALL = 0.97
#: The share of queries that may find less than half of their neighbours, by the calibration.
POOR = 0.01
#: Numbers in the vectors of one cell, and queries that visit it.
CELL_NUMBERS = 1 << 19
CELL_QUERIES = 4_096


@dataclass(frozen=True)
class Tree:
    """Nodes by number: the children of an inner node and the centre of each node."""

    centres: np.ndarray
    children: dict[int, np.ndarray]
    leaf: dict[int, int]

    @staticmethod
    def fit(rows: np.ndarray, leaves: int, seed: int = 0) -> Tree:
        chance = np.random.default_rng(seed)
        centres, children, leaf = [rows.mean(axis=0)], {}, {}
        waiting = [(0, rows, leaves)]
        while waiting:
            node, own, wanted = waiting.pop(0)
            groups = []
            if wanted > 1 and len(own) >= 2 * SAMPLE_LEAF:
                groups = kmeans(own, min(BRANCH, wanted, len(own) // SAMPLE_LEAF), chance)
            if len(groups) < 2:
                leaf[node] = len(leaf)
                continue
            children[node] = np.arange(len(centres), len(centres) + len(groups))
            for child, (centre, members) in zip(children[node].tolist(), groups):
                centres.append(centre)
                waiting.append((child, members, -(-wanted // len(groups))))
        return Tree(np.array(centres), children, leaf)

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest centre at every level."""
        out = np.zeros(len(rows), np.int64)
        waiting = [(0, np.arange(len(rows)))]
        while waiting:
            node, at = waiting.pop()
            if node in self.leaf:
                out[at] = self.leaf[node]
                continue
            own = self.children[node]
            nearest = np.argmin(distances(rows[at], self.centres[own]), axis=1)
            waiting += [
                (child, at[nearest == k]) for k, child in enumerate(own.tolist())
                if (nearest == k).any()
            ]
        return out

    def visits(self, query: np.ndarray, count: int) -> list[int]:
        """The first ``count`` leaves, taken by the inner product with their centres."""
        heap, found = [(0.0, 0)], []
        while heap and len(found) < count:
            _, node = heapq.heappop(heap)
            if node in self.leaf:
                found.append(self.leaf[node])
                continue
            own = self.children[node]
            for close, child in zip((self.centres[own] @ query).tolist(), own.tolist()):
                heapq.heappush(heap, (-close, child))
        return found

    def reach(self, query: np.ndarray, count: int, counted: np.ndarray, least: int) -> list[int]:
        """As ``visits``, going on until the leaves hold ``least`` of what is ``counted`` in them."""
        found = self.visits(query, count)
        if counted[found].sum() < least:
            every = self.visits(query, len(self.leaf))
            enough = int(np.searchsorted(np.cumsum(counted[every]), least)) + 1
            found = every[: max(count, enough)]
        return found


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, but for a number that is the same for all centres."""
    return (centres**2).sum(axis=1) - 2 * rows @ centres.T


def kmeans(
    rows: np.ndarray, k: int, chance: np.random.Generator, rounds: int = 8
) -> list[tuple[np.ndarray, np.ndarray]]:
    centres = np.unique(rows[chance.choice(len(rows), k, replace=False)], axis=0)
    for _ in range(rounds):
        nearest = np.argmin(distances(rows, centres), axis=1)
        used = np.unique(nearest)
        centres = np.array([rows[nearest == c].mean(axis=0) for c in used])
    nearest = np.argmin(distances(rows, centres), axis=1)
    return [(centres[c], rows[nearest == c]) for c in np.unique(nearest)]


def best(
    ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray, close: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact scores of the ``k`` nearest; ``close`` are scores up to rounding."""
    close = np.where(ids == query_id, -np.inf, close)
    least = np.partition(close, len(close) - k)[len(close) - k] if len(close) > k else -np.inf
    slack = 1e-9 * (abs(least) + 1) if np.isfinite(least) else 0
    at = np.flatnonzero((close >= least - slack) & np.isfinite(close))
    scores = (vectors[at] * query).sum(axis=1)
    order = np.lexsort((ids[at], -scores))[:k]
    return ids[at][order], scores[order]


def _matrix(column: pa.Array | pd.Series, size: int) -> np.ndarray:
    raw = b"".join(column.to_pylist() if isinstance(column, pa.Array) else column.tolist())
    return np.frombuffer(raw, "<f8").reshape(-1, size)


def usable(vector: Column) -> Column:
    """Not NULL, nothing NULL or not finite in it, and not zero."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~wrong & F.exists(vector, lambda x: x != 0)


def nearest(
    table: DataFrame,
    k: int = 20,
    query_every: int = 20,
    recall: float = RECALL,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> tuple[DataFrame, dict[str, float]]:
    """query_id, rank, vec_id, score of the ``k`` nearest found of every query, and the calibration: leaves,
    visits, recall and the share of poor queries (less than half found), both measured on queries of their own.

    Queries are the rows whose id is divisible by ``query_every``. Vectors that are NULL, zero, of
    another length than most, or hold NULL or non-finite numbers take no part, nor do NULL ids.
    Rows of equal id and vector count once; of an id with several vectors the best score counts.
    Ties go to the smaller id. Without candidates or queries there are no rows.
    """
    spark = table.sparkSession
    ship(spark)
    vector = F.col(vector_column).cast("array<double>")
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], schema), {"leaves": 0, "visits": 0, "recall": 1.0, "poor": 0.0}
    size = common["n"]
    rows = rows.where(F.size("vector") == size)

    fitted = max(64, FITTED // size)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(fitted).collect()
    tree = Tree.fit(np.array([r["vector"] for r in sample]), -(-common["count"] // LEAF_ROWS))
    tree_leaves = len(tree.leaf)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("vector").flatten().to_numpy().reshape(-1, size)
            raw = own.astype("<f8").tobytes()
            packed = [raw[a : a + 8 * size] for a in range(0, len(raw), 8 * size)]
            yield pa.record_batch(
                [batch.column("vec_id"), pa.array(tree.assign(own)), pa.array(packed, pa.binary())],
                ["vec_id", "leaf", "vector"],
            )

    index = saved(
        rows.mapInArrow(assign, "vec_id long, leaf long, vector binary").distinct(), "index"
    )
    queries = index.where(F.col("vec_id") % query_every == 0)
    visits, measured, poor = calibrate(index, queries, tree, size, k, recall)

    # A row for each leaf, of which there are no more than the sample allows.
    held = np.zeros(tree_leaves, np.int64)
    for leaf, count in index.groupBy("leaf").count().collect():
        held[leaf] = count
    cell_of, parts_of = cells(held, max(256, CELL_NUMBERS // size))
    used_cells = np.unique(cell_of[held > 0]).tolist()
    # Ids, each counted in one of its leaves: a query must meet ``k`` besides its own.
    counted = np.zeros(tree_leaves, np.int64)
    first = index.groupBy("vec_id").agg(F.min("leaf").alias("leaf"))
    for leaf, count in first.groupBy("leaf").count().collect():
        counted[leaf] = count

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            own = _matrix(batch.column("vector"), size)
            for name, query in zip(batch.column("vec_id").to_pylist(), own):
                if visits >= tree_leaves:
                    # All of a cell's leaves are meant where none is named.
                    rows += [(name, cell, [], query.tobytes()) for cell in used_cells]
                    continue
                leaves = np.sort(tree.reach(query, visits, counted, k + 1))
                leaves = leaves[held[leaves] > 0]
                cuts = np.flatnonzero(np.diff(cell_of[leaves])) + 1
                for group in np.split(leaves, cuts) if len(leaves) else []:
                    rows.append((name, int(cell_of[group[0]]), group.tolist(), query.tobytes()))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
                yield pa.record_batch(
                    [pa.array(x, t) for x, t in zip(zip(*rows), kinds)],
                    ["query_id", "cell", "leaves", "query"],
                )

    asked = saved(
        queries.select("vec_id", "vector").mapInArrow(
            visit, "query_id long, cell long, leaves array<long>, query binary"
        ),
        "visits",
    )
    met = asked.groupBy("cell").agg(F.ceil(F.count("*") / CELL_QUERIES).cast("int").alias("shares"))
    layout = spark.createDataFrame(
        list(zip(range(tree_leaves), cell_of.tolist(), parts_of.tolist())),
        "leaf long, cell long, parts int",
    )
    layout = saved(layout.join(met, "cell"), "layout")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    share = F.pmod(F.xxhash64("query_id"), F.col("shares")).cast("int")
    members = index.join(F.broadcast(layout), "leaf").select(
        "cell", part.alias("part"), every("shares").alias("share"), "vec_id", "leaf", "vector"
    )
    sizes = layout.groupBy("cell").agg(F.max("parts").alias("parts"), F.max("shares").alias("shares"))
    callers = asked.join(F.broadcast(sizes), "cell").select(
        "cell", every("parts").alias("part"), share.alias("share"), "query_id", "leaves", "query"
    )

    def compare(own: pd.DataFrame, calls: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(calls):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        own = own.sort_values("leaf", kind="stable")
        ids, vectors = own["vec_id"].to_numpy(), _matrix(own["vector"], size)
        names, starts = np.unique(own["leaf"].to_numpy(), return_index=True)
        ends = np.r_[starts[1:], len(ids)]
        query_ids, asking = calls["query_id"].to_numpy(), _matrix(calls["query"], size)
        out = []
        for begin in range(0, len(asking), 256):
            part = asking[begin : begin + 256]
            asked_leaves = calls["leaves"].iloc[begin : begin + 256]
            seen = np.zeros((len(part), len(names)), bool)
            for q, leaves in enumerate(asked_leaves):
                seen[q] = True if not len(leaves) else np.isin(names, leaves)
            close = np.full((len(part), len(ids)), -np.inf)
            if seen.all():
                close = part @ vectors.T
            else:
                for leaf in np.flatnonzero(seen.any(axis=0)):
                    who, rows = np.flatnonzero(seen[:, leaf]), slice(starts[leaf], ends[leaf])
                    close[who, rows] = part[who] @ vectors[rows].T
            for q, query in enumerate(part):
                name = query_ids[begin + q]
                found, scores = best(ids, vectors, name, query, close[q], k)
                out.append((np.full(len(found), name), found, scores))
        columns = [np.concatenate(x) for x in zip(*out)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

    by = ["cell", "part", "share"]
    pairs = members.groupBy(by).cogroup(callers.groupBy(by)).applyInPandas(
        compare, "query_id long, vec_id long, score double"
    )
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    found = saved(ranked.select("query_id", "rank", "vec_id", "score"), "nearest")
    return found, {"leaves": tree_leaves, "visits": visits, "recall": measured, "poor": poor}


def cells(held: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each leaf, and into how many parts that cell is split.

    Leaves in a row share a cell as long as it has at most ``most`` rows.
    """
    cell, filled = np.zeros(len(held), np.int64), 0
    for leaf, count in enumerate(held.tolist()):
        start = leaf > 0 and filled + count > most
        cell[leaf] = cell[leaf - 1] + start if leaf else 0
        filled = count if start else filled + count
    rows = np.bincount(cell, held)
    return cell, np.maximum(1, -(-rows // most))[cell].astype(np.int64)


def calibrate(
    index: DataFrame, queries: DataFrame, tree: Tree, size: int, k: int, recall: float
) -> tuple[int, float, float]:
    """Leaves to visit, and the recall and the share of poor queries measured, by a scan of all rows.

    Every other query of 2 * CALIBRATED settles the visits; the others measure what they find.
    """
    chosen = queries.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(2 * CALIBRATED).collect()
    if not chosen:
        return 1, 1.0, 0.0
    names = np.array([r["vec_id"] for r in chosen])
    asking = np.frombuffer(b"".join(r["vector"] for r in chosen), "<f8").reshape(-1, size)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = (np.zeros(0, np.int64), np.zeros((0, size)), np.zeros(0, np.int64))
        kept = [empty] * len(names)
        for batch in batches:
            ids, vectors = batch.column("vec_id").to_numpy(), _matrix(batch.column("vector"), size)
            leaf, close = batch.column("leaf").to_numpy(), asking @ vectors.T
            for q, (held, near, of) in enumerate(kept):
                low = np.argsort(-close[q], kind="stable")[: k + 1]
                held, near = np.r_[held, ids[low]], np.r_[near, vectors[low]]
                of = np.r_[of, leaf[low]]
                found, _ = best(held, near, names[q], asking[q], near @ asking[q], k)
                at = np.flatnonzero(np.isin(held, found))
                kept[q] = (held[at], near[at], of[at])
        for q, (held, near, of) in enumerate(kept):
            yield pa.record_batch(
                [
                    pa.array(np.full(len(held), q)), pa.array(held), pa.array(of),
                    pa.array((near * asking[q]).sum(axis=1)),
                ],
                ["q", "vec_id", "leaf", "score"],
            )

    large = {"spark.sql.execution.arrow.maxRecordsPerBatch": "8192"}
    pairs = saved(index.mapInArrow(scan, "q long, vec_id long, leaf long, score double"), "scan", large)
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    true = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    places = {q: {leaf: n for n, leaf in enumerate(tree.visits(asking[q], len(tree.leaf)))}
              for q in range(len(names))}
    # k rows for each of a fixed number of queries: how many visits it takes to find each.
    needed: dict[int, list[int]] = {}
    for q, leaf in true.select("q", "leaf").collect():
        needed.setdefault(q, []).append(places[q][leaf] + 1)
    if not needed:
        return 1, 1.0, 0.0
    return settled(needed, len(tree.leaf), recall)


def settled(needed: dict[int, list[int]], leaves: int, recall: float) -> tuple[int, float, float]:
    """Visits, recall and share of poor queries from the visits needed for each neighbour of each query."""
    fitting = [sorted(n) for q, n in sorted(needed.items()) if q % 2 == 0 or len(needed) == 1]
    pooled = np.sort(np.concatenate([fitting[0], *fitting[1:]]))
    visits = int(pooled[int(np.ceil(recall * len(pooled))) - 1])
    # To find half of a query's neighbours takes as many visits as the middle one of them does.
    halves = np.sort([own[(len(own) + 1) // 2 - 1] for own in fitting])
    visits = max(visits, int(halves[int(np.ceil((1 - POOR) * len(halves))) - 1]))
    if 2 * visits > leaves:
        return leaves, 1.0, 0.0
    others = [np.array(n) for q, n in needed.items() if q % 2 or len(needed) == 1]
    found = [(own <= visits).mean() for own in others]
    hits = np.concatenate(others) <= visits
    return visits, float(hits.mean()), float(np.mean(np.array(found) < 0.5))
