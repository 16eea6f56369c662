"""Approximate nearest neighbours: probed lists scanned by an adaptive dimension scan.

Unit vectors are rotated at random and dealt to lists of near ones. A query probes the
lists nearest to it. In a list, stored in blocks of columns, the distances grow block by
block, and after each block a hypothesis test drops the candidates whose full distance
would, at the present rate, exceed the query's best ones so far: after d of D rotated
dimensions the scaled partial distance is close to the whole one with an error that
shrinks as 1 / sqrt(d). What survives is measured exactly on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import groups, map_arrow, materialize
from barloom.llm.vectors import as_rows, cosines, matrix, unit

#: Vectors that the lists and the number of probes are fitted on, about: at least and at
#: most. Between them the sample grows with the root of the rows, as the lists do.
SAMPLE = 8192
MOST_SAMPLE = 65_536
#: Share of true neighbours that the probes must reach on the sample.
AIM = 0.99
#: Candidates of a list, and queries, that one group holds on average.
CHUNK = 8192
QUERIES = 1024
COLUMNS = 16
#: Width of the test in standard deviations of the partial distance.
CONFIDENCE = 3.0
SEED = 11


@dataclass
class Index:
    """Rotation, list centres, probes and, once known, ids per list, for one vector length."""

    rotation: np.ndarray
    centres: np.ndarray
    probes: int
    held: np.ndarray | None = None

    def probed(self, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of all lists that queries with these scores per list must look into.

        A query goes on to further lists until they hold more than ``k`` ids.
        """
        order = np.argsort(-score, axis=1, kind="stable")
        held = np.cumsum(self.held[order], axis=1)
        needed = (held <= k).sum(axis=1) + 1
        counts = np.minimum(np.maximum(needed, self.probes), order.shape[1])
        chosen = np.arange(order.shape[1])[None, :] < counts[:, None]
        return np.repeat(np.arange(len(order)), counts), order[chosen]


def _rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng((SEED, dim)).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def _centres(points: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    centres = points[rng.choice(len(points), lists, replace=False)]
    for _ in range(rounds):
        nearest = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        empty = np.bincount(nearest, minlength=lists) == 0
        sums[empty] = points[rng.integers(len(points), size=int(empty.sum()))]
        centres = unit(np.where(np.abs(sums).max(axis=1, keepdims=True) > 0, sums, points[:1]))
    return centres


def fit(sample: np.ndarray, rows: int, k: int) -> Index:
    """Index from sampled vectors; ``rows`` is the number that will be indexed.

    The number of probes is the smallest at which the queries of the sample find
    ``AIM`` of their ``k`` true neighbours in it.
    """
    points = unit(sample)
    rotation = _rotation(points.shape[1])
    points = points @ rotation
    lists = max(1, min(len(points) // 32, round(math.sqrt(rows) / 4)))
    centres = _centres(points, lists)
    queries = np.random.default_rng(SEED).choice(len(points), min(256, len(points)), replace=False)
    near = points[queries] @ points.T
    near[np.arange(len(queries)), queries] = -np.inf
    true = np.argsort(-near, axis=1)[:, : min(k, max(1, len(points) - 1))]
    home = (points @ centres.T).argmax(axis=1)
    order = np.argsort(-(points[queries] @ centres.T), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(lists), order.shape), axis=1)
    needed = np.take_along_axis(place, home[true], axis=1)
    found = np.cumsum(np.bincount(needed.reshape(-1), minlength=lists)) / needed.size
    return Index(rotation, centres, min(lists, int(np.searchsorted(found, AIM)) + 1))


def scan_list(query: np.ndarray, blocks: list[np.ndarray], k: int) -> np.ndarray:
    """Candidates of one list that may be among its ``k`` nearest to ``query``.

    ``blocks`` are the list's rotated unit vectors cut by columns.
    """
    n, dim = len(blocks[0]), len(query)
    cuts = np.cumsum([0] + [b.shape[1] for b in blocks])
    parts = [query[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    first = min(n, 16 * k)
    start = sum(((b[:first] - q) ** 2).sum(axis=1) for b, q in zip(blocks, parts))
    bound = np.partition(start, k - 1)[k - 1] if first >= k else np.inf
    alive = np.arange(first, n)
    partial = np.zeros(len(alive))
    for block, part, seen in zip(blocks, parts, cuts[1:].tolist()):
        partial = partial + ((block[alive] - part) ** 2).sum(axis=1)
        # At the last block the estimate is the distance; a little room keeps ties.
        slack = 1 + (CONFIDENCE / math.sqrt(seen) if seen < dim else 1e-9)
        keep = partial * (dim / seen) <= bound * slack * slack + 1e-12
        alive, partial = alive[keep], partial[keep]
        if not len(alive):
            break
    whole = np.concatenate((start, partial)) if len(alive) else start
    chosen = np.concatenate((np.arange(first), alive))
    if len(chosen) > k:
        bound = np.partition(whole, k - 1)[k - 1]
        chosen = chosen[whole <= bound * (1 + 1e-9) + 1e-9]
    return chosen


def _assign_task(indexes: dict[int, Index], k: int | None = None):
    """Task that gives each vector its list, or with ``k`` each query the lists it probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                vectors = rows.column(1)
                pick, lists = np.arange(len(rows)), np.zeros(len(rows), np.int64)
                if dim in indexes:
                    index = indexes[dim]
                    score = (unit(matrix(vectors)) @ index.rotation) @ index.centres.T
                    if k is None:
                        lists = score.argmax(axis=1)
                    else:
                        pick, lists = index.probed(score, k)
                taken = pa.array(pick)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(taken), vectors.take(taken), rows.column(2).take(taken), pa.array(lists)],
                    names=["vec_id", "vec", "dim", "list"],
                )

    return run


def _search_task(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 4):
            asks = table.column(4).to_numpy() == 1
            if not asks.any() or asks.all():
                continue
            ids = table.column(5).to_numpy()
            vectors = matrix(table.column(6))
            rotated = unit(vectors) @ _rotation(vectors.shape[1])
            # Rows that repeat an id with its vector are one candidate; they are all here.
            places = np.flatnonzero(~asks)
            if len(np.unique(ids[places])) < len(places):
                places = np.array(list({(ids[p], vectors[p].tobytes()): p for p in places.tolist()}.values()))
            own, rows = ids[places], vectors[places]
            blocks = [
                np.ascontiguousarray(rotated[places][:, a : a + COLUMNS]) for a in range(0, rotated.shape[1], COLUMNS)
            ]
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for at in np.flatnonzero(asks).tolist():
                # One more than asked for, as the query itself may be among them.
                chosen = scan_list(rotated[at], blocks, k + 1)
                chosen = chosen[own[chosen] != ids[at]]
                scores = cosines(vectors[at], rows[chosen])
                best = np.lexsort((own[chosen], -scores))[:k]
                out.append((np.full(len(best), ids[at]), own[chosen][best], scores[best]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in zip(*out)], names=["query_id", "vec_id", "score"]
            )

    return run


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: the ``k`` found for each query.

    ``is_query`` is a condition on the column ``vec_id``. Candidates are all rows but
    those with the query's own id, of its length; fewer than ``k`` candidates are all
    returned. Ties go to the smaller id. Null and zero vectors, vectors with a null or
    non-finite component and rows without an id take no part. Rows that repeat an id
    with one vector are one candidate. Extra columns are not read.
    """
    valid = as_rows(vectors, id_col, vector_col).where("vec_id is not null")
    valid = materialize(valid.withColumn("dim", F.size("vec")), "vectors")
    sizes = {r["dim"]: r["n"] for r in valid.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(64).collect()}
    rows = sum(sizes.values())
    wanted = min(max(SAMPLE, round(8 * math.sqrt(rows))), MOST_SAMPLE)
    # Drawn by a hash, so that no task hands on more than its part; copies are drawn once.
    mark = F.xxhash64("vec_id", "vec")
    drawn = valid.where(F.pmod(mark, F.lit(1 << 30)) < F.lit(min(1.0, wanted / max(rows, 1)) * (1 << 30)))
    sample = drawn.select("dim", "vec", mark.alias("mark")).dropDuplicates(["mark"]).orderBy("mark").collect()
    indexes = {}
    for dim, n in sizes.items():
        points = np.array([r["vec"] for r in sample if r["dim"] == dim])
        if len(points) > 32 * k:
            indexes[dim] = fit(points, n, k)
    kind = "vec_id long, vec array<double>, dim int, list long"
    listed = map_arrow(valid, _assign_task(indexes), kind)
    listed = materialize(listed, "lists")
    # Ids are counted in one of their lists only, so that sums over lists promise no less.
    ids = listed.groupBy("dim", "vec_id").agg(F.min("list").alias("list"))
    for dim, index in indexes.items():
        index.held = np.zeros(len(index.centres), np.int64)
    for row in ids.groupBy("dim", "list").agg(F.count("*").alias("n")).collect():
        if row["dim"] in indexes:
            indexes[row["dim"]].held[row["list"]] = row["n"]
    asked = map_arrow(valid.where(is_query), _assign_task(indexes, k), kind)
    # A large list is cut into chunks, and its queries into blocks: a group is bounded.
    held = listed.groupBy("dim", "list").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    wanted = asked.groupBy("dim", "list").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("turns"))
    plan = held.join(wanted, ["dim", "list"])
    deal = lambda df, asks, own, other, mine, theirs: (
        df.join(plan, ["dim", "list"])
        .withColumn(mine, F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int"))
        .withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        .select("dim", "list", "chunk", "turn", F.lit(asks).alias("asks"), "vec_id", "vec")
    )
    both = deal(listed, 0, "chunks", "turns", "chunk", "turn").union(deal(asked, 1, "turns", "chunks", "turn", "chunk"))
    key = ["dim", "list", "chunk", "turn"]
    together = both.repartition(*key).sortWithinPartitions(*key)
    found = map_arrow(together, _search_task(k), "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
