"""Near-duplicate vectors by sorted passes and neighbour windows as wide as they must be.

A pass concatenates the signs of random projections to a key and orders the vectors of a
label by it. Each vector is compared with those before it in a window: the ``WINDOW``
nearest ones, and beyond them all that share the key's first signs, its run. A pair at the
threshold shares these signs with a probability that follows from its angle alone, so the
number of passes that brings it to ``RECALL`` holds for any vectors: those with a common
mean or in a dense cone too, where fixed windows lose pairs. How many signs make a run is
measured on the vectors and decides only the cost; with none the run is the whole label.
A run that is too long for a task is cut into blocks, which are compared two by two.

The union of the passes needs one path between two near vectors, not every pair. All links
are then counted exactly inside each component, in blocks. Equal vectors are one row with
a count throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import components, discard, groups, map_arrow, materialize, named
from barloom.llm.vectors import as_rows, matrix, unit

THRESHOLD = 0.93
#: Rows before a vector that it is compared with at least, and as many comparisons as
#: moving a row once more costs.
WINDOW = 48
#: Probability that two vectors at the threshold meet in one of the passes.
RECALL = 0.9995
#: Signs in a key; signs fewer than a run's that rows of one task share; passes that one
#: job makes; passes on which the cost is measured; rows of a block, and of a run at most.
BITS = 62
ZONE = 2
PASSES_AT_ONCE = 8
TRIALS = 2
BLOCK = 1024
SEED = 7

_UNIT = "uid long, label long, dim int, vec array<double>, copies long"


def passes_of(signs: float, threshold: float, recall: float = RECALL) -> int:
    """Passes after which a pair at ``threshold`` has shared ``signs`` signs in one with ``recall``.

    A sign agrees with probability 1 - angle / pi, wherever the two vectors lie.
    """
    one = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** signs
    if one > 1 - 1e-12:
        return 1
    return max(1, math.ceil(math.log(1 - recall) / math.log1p(-one)))


def passes_needed(rows: int, threshold: float, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes for ``rows`` vectors that lie evenly, with buckets of less than ``window``.

    An estimate; :func:`signs_wanted` measures the vectors.
    """
    return passes_of(max(1.0, math.log2(max(2, rows) / window) + 1), threshold, recall)


def _keys_of(batch: pa.RecordBatch, k: int, dim: int) -> np.ndarray:
    """The signs of pass ``k``, the first one highest, as whole numbers."""
    planes = np.random.default_rng((SEED, k, dim)).normal(size=(dim, BITS))
    signs = (unit(matrix(batch.column(3))) @ planes) > 0
    return signs.astype(np.int64) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _key_task(first: int, last: int, signs: int, whole: bool):
    """Runs of some passes; if ``whole`` with the place in the order, and the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                for k in range(first, last):
                    key = _keys_of(rows, k, dim)
                    columns = [pa.array(np.full(rows.num_rows, k)), rows.column(1), rows.column(2), pa.array(key >> (BITS - signs))]
                    names = ["pass", "label", "dim", "sign"]
                    if whole:
                        columns += [pa.array(key), rows.column(0), rows.column(3)]
                        names += ["place", "uid", "vec"]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


_BUCKET = ["pass", "label", "dim", "sign"]
_KEYED = "pass long, label long, dim int, sign long"


def signs_wanted(plain: DataFrame, threshold: float, window: int = WINDOW) -> int:
    """Number of signs with which the passes are cheapest, by the sizes of buckets.

    A row costs, in each pass, as many comparisons as its run holds, and ``window`` for
    each block that it is sent to.
    """
    largest = plain.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    # Comparing all pairs costs less than moving the rows as often as more signs need.
    alone = largest + window * -(-largest // BLOCK)
    depths = [d for d in range(0, BITS + 1, 2) if d == 0 or passes_of(d, threshold) * window < alone]
    if len(depths) == 1:
        return 0
    keys = map_arrow(plain, _key_task(0, TRIALS, depths[-1], False), _KEYED)
    fine = keys.groupBy(*_BUCKET).agg(F.count("*").alias("n"))
    each = fine.withColumn("signs", F.explode(F.array(*map(F.lit, depths))))
    each = each.withColumn("sign", F.expr(f"shiftright(sign, {depths[-1]} - signs)"))
    sizes = each.groupBy("signs", *_BUCKET).agg(F.sum("n").cast("double").alias("n"))
    cost = F.col("n") * (F.col("n") + window * F.ceil(F.col("n") / BLOCK))
    costs = sizes.groupBy("signs").agg(F.sum(cost).alias("cost")).collect()
    return min((r["cost"] * passes_of(r["signs"], threshold), r["signs"]) for r in costs)[1]


def _meet_task(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A spanning forest of the links in each block, or between two blocks, of a bucket."""
        for table in groups(batches, 6):
            if table.num_rows < 2:
                continue
            i, j = table.column(4)[0].as_py(), table.column(5)[0].as_py()
            own, uids = table.column(6).to_numpy(), table.column(7).to_numpy()
            vectors = unit(matrix(table.column(8)))
            near = vectors @ vectors.T >= threshold
            if i != j:
                near &= (own == i)[:, None] != (own == i)
            a, b = _forest(near)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(uids[a]), pa.array(uids[b])], names=["a", "b"])

    return run


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of a symmetric relation; its diagonal does not count."""
    np.fill_diagonal(near, False)
    left = near.any(axis=1)
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    for root in np.flatnonzero(left):
        front = np.array([root]) if left[root] else np.empty(0, np.int64)
        left[root] = False
        while len(front):
            links = near[front] & left
            found = np.flatnonzero(links.any(axis=0))
            ends.append((front[links[:, found].argmax(axis=0)], found))
            left[found] = False
            front = found
    if not ends:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([a for a, _ in ends]), np.concatenate([b for _, b in ends])


def _window_task(threshold: float, window: int):
    """A spanning forest of the links that the windows of a sorted order meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _ordered(batches, window):
            signs, uids = table.column(3).to_numpy(), table.column(5).to_numpy()
            vectors = unit(matrix(table.column(6)))
            # Rows before ``at`` have been compared with each other.
            start = at = 0
            while at < len(uids):
                end = min(at + BLOCK, len(uids))
                here, sign = vectors[start:end], signs[start:end]
                place = np.arange(end - start)
                near = here @ here.T >= threshold
                near &= (np.abs(place[:, None] - place) <= window) | (sign[:, None] == sign)
                a, b = _forest(near)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(uids[start + a]), pa.array(uids[start + b])], names=["a", "b"])
                at = end
                start = max(0, min(end - window, int(np.searchsorted(signs, signs[end - 1]))))

    return run


def _ordered(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.Table]:
    """Stretches of one pass, label and length of a sorted stream, a few batches long.

    A stretch begins with the end of the one before: its last run, which is ``BLOCK`` rows
    at most, and no less than ``window`` rows.
    """
    held, new = None, 0
    for batch in batches:
        for part in groups([batch], 3):
            same = held is not None and all(held.column(c)[0] == part.column(c)[0] for c in range(3))
            if not same and held is not None:
                if new:
                    yield held
                held, new = None, 0
            held = part if held is None else pa.concat_tables([held, part])
            new += part.num_rows
            if new >= BLOCK:
                yield held
                signs = held.column(3).to_numpy()
                kept = max(0, min(len(signs) - window, int(np.searchsorted(signs, signs[-1]))))
                held, new = held.slice(kept), 0
    if new:
        yield held


def _met(plain: DataFrame, first: int, last: int, signs: int, threshold: float, window: int = WINDOW) -> DataFrame:
    """Links (a, b) that connect what is near in the windows of some passes."""
    runs = map_arrow(plain, _key_task(first, last, signs, False), _KEYED)
    large = runs.groupBy(*_BUCKET).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("blocks > 1")
    large = materialize(large, "runs")
    keyed = map_arrow(plain, _key_task(first, last, signs, True), f"{_KEYED}, place long, uid long, vec array<double>")
    marked = keyed.join(large, _BUCKET, "left")
    # Neighbouring runs go to one task, so that windows reach over their ends.
    order = ["pass", "label", "dim"]
    zoned = marked.where("blocks is null").withColumn("zone", F.expr(f"shiftright(sign, {ZONE})"))
    sorted_ = zoned.repartition(*order, "zone").sortWithinPartitions(*order, "place")
    found = map_arrow(sorted_.drop("blocks", "zone"), _window_task(threshold, window), "a long, b long")
    if not large.isEmpty():
        dealt = (
            marked.where("blocks is not null")
            .withColumn("own", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(*_BUCKET, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "uid", "vec")
        )
        blocks = [*_BUCKET, "i", "j"]
        together = dealt.repartition(*blocks).sortWithinPartitions(*blocks)
        found = found.union(map_arrow(together, _meet_task(threshold), "a long, b long"))
    found = materialize(found, "near")
    discard(large)
    return found


def _count_task(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 3):
            i, j = table.column(1)[0].as_py(), table.column(2)[0].as_py()
            own, uids, copies = (table.column(k).to_numpy() for k in (3, 4, 5))
            vectors = unit(matrix(table.column(6)))
            one = own == i
            if i == j:
                near = vectors @ vectors.T >= threshold
                np.fill_diagonal(near, False)
                n = near @ copies
            else:
                near = vectors[one] @ vectors[~one].T >= threshold
                n = np.empty(len(uids), np.int64)
                n[one], n[~one] = near @ copies[~one], copies[one] @ near
            yield pa.RecordBatch.from_arrays([pa.array(uids), pa.array(n)], names=["uid", "n"])

    return run


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    window: int = WINDOW,
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors are compared only where labels are equal and not null and lengths are equal.
    Null and zero vectors, and vectors with a null or non-finite component, link with
    nothing: they are their own component and kept. Repeated rows count as separate
    vectors that are linked. A null id is no component's name; a component without any
    id has a null one and all its rows are kept. Extra columns are not read.
    """
    label = named(label_col).cast("long").alias("label")
    valid = as_rows(vectors, id_col, vector_col, label).where("label is not null")
    # Equal vectors meet after partial counts, whatever share of the rows they are.
    units = valid.groupBy("label", "vec").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    units = materialize(
        units.select(F.monotonically_increasing_id().alias("uid"), "label", F.size("vec").alias("dim"), "vec", "copies", "first"),
        "vectors",
    )
    plain = units.select("uid", "label", "dim", "vec", "copies")
    edges = None
    signs = signs_wanted(plain, threshold, window)
    needed = passes_of(signs, threshold)
    for first in range(0, needed, PASSES_AT_ONCE):
        found = _met(plain, first, min(needed, first + PASSES_AT_ONCE), signs, threshold, window)
        edges = found if edges is None else edges.union(found)
    linked = components(edges)
    members = plain.join(linked.withColumnRenamed("node", "uid"), "uid")
    sizes = linked.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")
    dealt = (
        members.join(sizes, "component")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "uid", "copies", "vec")
    )
    together = dealt.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    counted = map_arrow(together, _count_task(threshold), "uid long, n long")
    counts = counted.groupBy("uid").agg(F.sum("n").alias("n"))
    roots = units.select("uid", "first").join(linked.withColumnRenamed("node", "uid"), "uid")
    names = roots.groupBy("component").agg(F.min("first").alias("least"))
    classes = (
        units.join(linked.withColumnRenamed("node", "uid"), "uid", "left")
        .join(names, "component", "left")
        .join(counts, "uid", "left")
        .select(
            "label",
            "vec",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.when(F.col("component").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"),
        )
    )
    classes = materialize(classes, "classes")
    everything = vectors.select(named(id_col).cast("long").alias("vec_id"), label, named(vector_col).cast("array<double>").alias("vec"))
    found = everything.join(classes, ["label", "vec"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return found.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("component_id").isNull() | F.col("vec_id").eqNullSafe(F.col("component_id")))
