"""Near-duplicate documents by SimHash, found with a Gray-order hierarchical index.

Fingerprints are made per document in one narrow pass. Equal fingerprints are merged
first, so copies cost nothing later. The index is a forest: an upper node holds the
fingerprints that share one of ``SEGMENTS`` masked bit patterns. Two fingerprints that
differ in at most ``SEGMENTS - 1`` bits agree in one segment at least, so the upper
nodes lose no pair. Below such a node the fingerprints stand in the order of their Gray
rank, and every run of ``FANOUT`` neighbours is a node whose pattern is the bits that
all of them share. A search walks pairs of nodes from the top, adds up the differing
shared bits, drops a pair of groups once they exceed the distance, and links two
groups as a whole once even their free bits cannot exceed it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import Forest, components, free_name, groups, map_arrow, materialize, named, slices

SHINGLE = 4
DISTANCE = 4
SEED = 42
FANOUT = 8
#: Fingerprints in one block; larger upper nodes are searched as pairs of blocks.
BLOCK = 4096
#: Pairs of nodes expanded at once, a bound on memory.
FRONTIER = 1 << 18


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the lower-cased word shingles; no words give zero."""
    data = b" ".join((text or "").encode().lower().split())
    if not data:
        return 0
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts = np.concatenate(([0], spaces + 1))
    ends = np.append(spaces, len(data))
    if len(starts) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(data[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        prints = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(prints.view(np.int64)), batch.column(2)], names=["doc_id", "fp", "mark"]
        )


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each 64-bit word in the reflected Gray sequence."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(pattern, mask of shared bits) of the nodes of each level, leaves first."""
    ones = prints.copy()
    any_ = prints.copy()
    levels = [(ones, np.full(len(prints), ~np.uint64(0)))]
    while len(ones) > 1:
        at = np.arange(0, len(ones), FANOUT)
        ones, any_ = np.bitwise_and.reduceat(ones, at), np.bitwise_or.reduceat(any_, at)
        levels.append((ones, ~(ones ^ any_)))
    return levels


def _search(left: list, right: list, same: bool, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Pairs of nodes (i, j, level) whose members are all within ``distance``."""
    top = max(len(left), len(right)) - 1
    left = left + [left[-1]] * (top + 1 - len(left))
    right = right + [right[-1]] * (top + 1 - len(right))
    stack = [(np.zeros(1, np.int64), np.zeros(1, np.int64), top)]
    while stack:
        a, b, level = stack.pop()
        if len(a) > FRONTIER:
            half = len(a) // 2
            stack += [(a[:half], b[:half], level), (a[half:], b[half:], level)]
            continue
        (pa_, ma), (pb, mb) = left[level], right[level]
        shared = ma[a] & mb[b]
        differ = np.bitwise_count((pa_[a] ^ pb[b]) & shared)
        keep = differ <= distance
        whole = keep & (differ + np.bitwise_count(~shared) <= distance)
        if whole.any():
            yield a[whole], b[whole], level
        keep &= ~whole
        a, b = a[keep], b[keep]
        if not len(a) or not level:
            continue
        # A side whose own tree is lower stays as it is until the levels meet.
        below_a, below_b = len(left[level - 1][0]), len(right[level - 1][0])
        grow_a, grow_b = below_a > len(pa_), below_b > len(pb)
        step_a, step_b = (FANOUT if grow_a else 1), (FANOUT if grow_b else 1)
        ca = (a[:, None] * step_a + np.arange(step_a))[:, :, None]
        cb = (b[:, None] * step_b + np.arange(step_b))[:, None, :]
        ca, cb = (x.reshape(-1) for x in np.broadcast_arrays(ca, cb))
        fits = (ca < below_a) & (cb < below_b)
        if same:
            fits &= ca <= cb
        stack.append((ca[fits], cb[fits], level - 1))


def links(left: np.ndarray, right: np.ndarray | None = None, distance: int = DISTANCE) -> np.ndarray:
    """Edges (two columns of fingerprints) that connect all that lie within ``distance``.

    With one argument inside it, with two between both. Edges are a spanning forest of
    the links, never all pairs.
    """
    left = left[np.argsort(gray_rank(left), kind="stable")]
    same = right is None
    if not same:
        right = right[np.argsort(gray_rank(right), kind="stable")]
    everything = left if same else np.concatenate((left, right))
    shift = 0 if same else len(left)
    tree = Forest(len(everything))
    mine = _levels(left)
    theirs = mine if same else _levels(right)
    found: list[tuple[int, int]] = []
    for a, b, level in _search(mine, theirs, same, distance):
        span = FANOUT**level
        if level == 0:
            for x, y in zip(a.tolist(), b.tolist()):
                if x + 0 != y + shift and tree.union(x, y + shift):
                    found.append((x, y + shift))
            continue
        for x, y in zip(a.tolist(), b.tolist()):
            first = x * span
            members = [*range(first, min(first + span, len(left))), *(
                shift + k for k in range(y * span, min((y + 1) * span, len(theirs[0][0])))
            )]
            for m in members[1:]:
                if m != first and tree.union(first, m):
                    found.append((first, m))
    if not found:
        return np.empty((0, 2), np.uint64)
    return everything[np.array(found)]


def _segments(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of ``distance + 1`` parts of the 64 bits."""
    cuts = [round(64 * k / (distance + 1)) for k in range(distance + 2)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:])]


def _search_task(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 4):
            i, j = table.column(2)[0].as_py(), table.column(3)[0].as_py()
            prints = table.column(5).to_numpy().view(np.uint64)
            if i == j:
                edges = links(prints, distance=distance)
            else:
                own = table.column(4).to_numpy() == i
                edges = links(prints[own], prints[~own], distance)
            if len(edges):
                edges = edges.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(edges[:, 0].copy()), pa.array(edges[:, 1].copy())], names=["a", "b"]
                )

    return run


def fingerprint_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fp``) within ``distance`` bits."""
    parts = _segments(distance)
    nodes = prints.select(
        "fp",
        F.posexplode(
            F.array(
                *[
                    F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
                    for shift, width in parts
                ]
            )
        ).alias("seg", "value"),
    )
    sizes = nodes.groupBy("seg", "value").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = nodes.join(sizes.where("blocks > 1"), ["seg", "value"], "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    keyed = dealt.select(
        "seg", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp"
    )
    # The rows of an upper node stand together; other nodes may share the task.
    together = keyed.repartition("seg", "value", "i", "j").sortWithinPartitions("seg", "value", "i", "j")
    return map_arrow(together, _search_task(distance), "a long, b long")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE
) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (long) and ``component_id``.

    ``component_id`` is the smallest id that can be reached over fingerprints at most
    ``distance`` bits apart. Null and blank texts have fingerprint zero and are linked
    like any other. Repeated ids stay as they are; a null id is never a component's
    smallest one unless the component has no other. Extra columns are not read.
    """
    return _classes(docs, distance, id_col, text_col).select("doc_id", "fp", "component_id")


def _classes(docs: DataFrame, distance: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``fp``, ``mark`` of the text, and ``root`` and ``component_id`` of the group."""
    text = named(text_col).cast("string")
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    prints = materialize(map_arrow(rows, _fingerprints, "doc_id long, fp long, mark long"), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    linked = components(fingerprint_links(distinct, distance))
    roots = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    named_roots = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = roots.join(named_roots, "root").select("fp", "root", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "mark", "root", "component_id")


def simhash_keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id.

    An id may occur in several groups, with texts that are no near copies; each group then
    keeps its own. Of rows with a group's smallest id the one of the smallest fingerprint
    stays, and of rows that are equal in id and text one. Rows without an id cannot be
    named by a group and all stay. Equal texts are told by 64 bits.
    """
    found = _classes(docs, DISTANCE, id_col, text_col).where("doc_id is not null")
    first = found.groupBy("root").agg(F.min(F.struct("doc_id", "fp", "mark")).alias("first"))
    ids, marks = free_name(docs, "kept_id"), free_name(docs, "kept_mark")
    keep = first.select(F.col("first.doc_id").alias(ids), F.col("first.mark").alias(marks)).distinct()
    own = free_name(docs, "own_mark")
    marked = docs.withColumn(own, F.xxhash64(named(text_col).cast("string")))
    kept = marked.join(keep, (named(id_col) == F.col(ids)) & (F.col(own) == F.col(marks)), "left_semi")
    # Both steps deal the rows out by id and mark, so the texts move once.
    return kept.dropDuplicates([id_col, own]).drop(own).union(docs.where(named(id_col).isNull()))
