"""Removal of long repeated byte strings by prefix-free parsing and suffix order.

Every window of ``LENGTH`` bytes has an anchor: its place of smallest hash of ``_GRAM``
bytes. The anchors cut a text into phrases and depend on a window's content alone, so equal windows
have equal anchors at the same offset. The windows of one anchor are a *unit*: its
phrase from one anchor to the next, with what the last window reaches over. A unit has
two keys, a hash of the ``CONTEXT`` bytes at its anchor, which any two equal windows
share, and a hash of all its bytes.

1. Equal texts become one row with a count. (A text repeated as a whole needs no more.)
2. Units whose anchor context occurs once hold no repeat and leave. This is the
   dictionary step: what is left are the phrases that occur again.
3. A unit that occurs again as a whole is repeated in full.
4. Others with a common anchor differ at their ends. Distinct ones are put in suffix
   order to the right of the anchor and in reversed order to its left; the common
   lengths of any two follow as minima over neighbours in these orders, and give the
   windows that both hold. An anchor with more than ``TOGETHER`` distinct units is not
   brought together: its windows are counted one by one, combined before the shuffle.

All counts are over all texts, so that no limit here drops a match; hashes only decide
what is compared with what inside one anchor context.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import discard, groups, map_arrow, materialize, named, slices
from barloom.sinks import scratch_dir

LENGTH = 200
CONTEXT = 40
#: Distinct units of one anchor context that a task compares at most.
TOGETHER = 4096
#: Pairs of units looked at in one go, a bound on memory.
_CELLS = 1 << 17
_GRAM = 8
_OFFSETS = LENGTH - CONTEXT + 1


def units(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first start, last start) of the units of a text, in order."""
    n = len(data)
    if n < LENGTH:
        none = np.empty(0, np.int64)
        return none, none, none
    grams = np.zeros(n - CONTEXT + 1, np.uint64)
    raw = np.frombuffer(data, np.uint8)
    for shift in range(_GRAM):
        # Aligned words of each shift; no copy of eight bytes per place is made.
        words = raw[shift : shift + (n - shift) // 8 * 8].view("<u8")
        grams[shift::8] = words[: len(grams[shift::8])]
    grams *= np.uint64(0x9E3779B97F4A7C15)
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    # The place is in the low bits, so that the leftmost of equal hashes is smallest.
    least = (grams & ~np.uint64(0xFFFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while size < _OFFSETS:
        step = min(size, _OFFSETS - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    anchors = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(anchors)) + 1
    first = np.concatenate(([0], cuts))
    return anchors[first], first, np.concatenate((cuts, [len(anchors)])) - 1


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _anchor_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor key, copies), added up over a slice of texts."""
    digest = xxhash.xxh3_64_intdigest
    for batch in slices(batches, 2):
        keys, counts = [], []
        for text, copies in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            data = text.encode()
            anchors = units(data)[0].tolist()
            keys += [digest(data[a : a + CONTEXT]) for a in anchors]
            counts += [copies] * len(anchors)
        if keys:
            distinct, at = np.unique(np.array(keys, np.uint64), return_inverse=True)
            total = np.bincount(at, counts).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(total)], names=["y", "c"])


_UNIT = "k long, m int, y long, x long, anchor int, first int, last int, c long"


def _unit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    names = [c.split()[0] for c in _UNIT.split(", ")]
    for batch in slices(batches, 2):
        own, y, x, places, sizes = [], [], [], [], []
        for text in batch.column(2).to_pylist():
            data = text.encode()
            found = units(data)
            anchors, first, last = (v.tolist() for v in found)
            y += [digest(data[a : a + CONTEXT]) for a in anchors]
            x += [digest(data[a : b + LENGTH]) for a, b in zip(first, last)]
            places.append(np.stack(found))
            sizes.append(len(anchors))
        own = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
        place = np.concatenate(places, axis=1).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(own), batch.column(1).take(own), _signed(y), _signed(x), *map(pa.array, place), batch.column(3).take(own)],
            names=names,
        )


_CONTEXT = "y long, k long, m int, anchor int, first int, single boolean, crowd boolean, bytes binary"


def _context_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the units that a text is asked for."""
    names = [c.split()[0] for c in _CONTEXT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
    for batch in slices(batches, 2):
        rows = []
        for k, m, text, wanted in zip(*(batch.column(c).to_pylist() for c in range(4))):
            data = text.encode()
            for w in wanted:
                part = data[w["first"] : w["last"] + LENGTH]
                rows.append((w["y"], k, m, w["anchor"], w["first"], w["single"], w["crowd"], part))
        for at in range(0, len(rows), 1 << 14):
            columns = zip(*rows[at : at + (1 << 14)])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _order(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank of each string, common lengths of neighbours in order, and lengths."""
    width = max(1, max(map(len, rows)))
    table = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)
    order = np.argsort(np.ascontiguousarray(table).view(f"V{width}").reshape(-1), kind="stable")
    differ = table[order[1:]] != table[order[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    rank = np.empty(len(rows), np.int64)
    rank[order] = np.arange(len(rows))
    return rank, common, np.array([len(r) for r in rows])


def _common(rank: np.ndarray, common: np.ndarray, lengths: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Common lengths of the strings ``rows`` with all: minima over their neighbours."""
    to = np.arange(len(rank))
    at = rank[rows][:, None]
    # Lengths are at most ``LENGTH``, so two bytes do, and none is larger than this.
    most = np.int16(LENGTH + 1)
    common, lengths = common.astype(np.int16), lengths.astype(np.int16)
    # From a string to the right: neighbours at, at + 1, ...; to the left: at - 1, ...
    by_rank = np.where(to > at, np.insert(common, 0, most), most)
    np.minimum.accumulate(by_rank, axis=1, out=by_rank)
    left = np.where(to < at, np.append(common, most), most)[:, ::-1]
    np.minimum(by_rank, np.minimum.accumulate(left, axis=1)[:, ::-1], out=by_rank)
    found = by_rank[:, rank]
    np.minimum(found, lengths, out=found)
    return np.minimum(found, lengths[rows][:, None], out=found)


def shared_offsets(contexts: list[bytes], anchors: list[int], wanted: np.ndarray) -> np.ndarray:
    """For units ``wanted``, which windows (by the anchor's offset) another unit holds.

    ``anchors`` are the places of the common anchor inside the contexts.
    """
    right = _order([c[a : a + LENGTH] for c, a in zip(contexts, anchors)])
    left = _order([c[:a][::-1] for c, a in zip(contexts, anchors)])
    out = np.zeros((len(wanted), _OFFSETS), bool)
    step = max(1, _CELLS // len(contexts))
    for at in range(0, len(wanted), step):
        rows = wanted[at : at + step]
        low = np.maximum(0, LENGTH - _common(*right, rows))
        high = np.minimum(_common(*left, rows), _OFFSETS - 1)
        low[np.arange(len(rows)), rows] = LENGTH
        i, j = np.nonzero(low <= high)
        marks = np.zeros((len(rows), _OFFSETS + 1), np.int32)
        np.add.at(marks, (i, low[i, j]), 1)
        np.add.at(marks, (i, high[i, j] + 1), -1)
        out[at : at + step] = np.cumsum(marks, axis=1)[:, :-1] > 0
    return out


_SPAN = "k long, m int, a int, b int"


def _suffix_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the units that occur once, among the distinct units of their anchor."""
    out: list[tuple[int, int, int, int]] = []
    for table in groups(batches, 1):
        singles = np.flatnonzero(table.column(5).to_numpy())
        if table.num_rows < 2 or not len(singles):
            continue
        k, m, anchor, first, data = (table.column(c).to_pylist() for c in (1, 2, 3, 4, 7))
        inside = [a - f for a, f in zip(anchor, first)]
        for row, shared in zip(singles.tolist(), shared_offsets(data, inside, singles)):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], shared.view(np.int8), [0]))))
            for low, after in zip(edges[::2].tolist(), edges[1::2].tolist()):
                # An offset is counted back from the anchor: the largest is the first start.
                out.append((k[row], m[row], anchor[row] - after + 1, anchor[row] - low + LENGTH))
        if len(out) >= 1 << 14:
            yield _spans(out)
            out = []
    if out:
        yield _spans(out)


def _spans(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["k", "m", "a", "b"])


def _window_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of a unit as a row, by two hashes."""
    for batch in batches:
        for row in range(batch.num_rows):
            k, m, first, data = (batch.column(c)[row].as_py() for c in (1, 2, 4, 7))
            n = len(data) - LENGTH + 1
            hashes = [xxhash.xxh3_128_intdigest(data[i : i + LENGTH]) for i in range(n)]
            mask = (1 << 64) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, k)),
                    pa.array(np.full(n, m, np.int32)),
                    pa.array(np.arange(first, first + n, dtype=np.int32)),
                    _signed([h >> 64 for h in hashes]),
                    _signed([h & mask for h in hashes]),
                ],
                names=["k", "m", "a", "h", "l"],
            )


def _apply_task(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            sizes, removed, runs, digests, kept = [], [], [], [], []
            for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                data = text.encode()
                rest = data
                gone = count = 0
                if spans:
                    marks = np.zeros(len(data) + 1, np.int64)
                    np.add.at(marks, [s["a"] for s in spans], 1)
                    np.add.at(marks, [s["b"] for s in spans], -1)
                    covered = np.cumsum(marks[:-1]) > 0
                    rest = np.frombuffer(data, np.uint8)[~covered].tobytes()
                    gone = len(data) - len(rest)
                    count = int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum())
                sizes.append(len(data))
                removed.append(gone)
                runs.append(count)
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            columns = [batch.column(0), batch.column(1), *(pa.array(v, pa.int64()) for v in (sizes, removed, runs)), pa.array(digests)]
            if keep:
                columns.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _RESULT.split(", ")] + ["kept"] * keep)

    return run


_RESULT = "k long, m int, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _bucketed(texts: DataFrame) -> tuple[DataFrame, str]:
    """``texts`` as a table bucketed by key, so that what is joined to it moves alone."""
    spark = texts.sparkSession
    n = min(100_000, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"texts_{uuid.uuid4().hex}"
    laid = texts.repartition(n, "k", "m")
    laid.write.option("path", scratch_dir(spark, "texts")).bucketBy(n, "k", "m").format("parquet").saveAsTable(name)
    return spark.table(name), name


def repeated_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_rest: bool = False
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` per document.

    Removed is every byte covered by a string of ``LENGTH`` bytes that starts anywhere
    else in any text, the same one included. Matches do not cross texts. With
    ``keep_rest`` the bytes left follow as ``kept``. Null texts count as empty, texts
    shorter than ``LENGTH`` bytes lose nothing. Equal rows repeat each other. Extra
    columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        named(id_col).cast("long").alias("doc_id"),
        F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"),
    ).select("doc_id", F.xxhash64("text").alias("k"), F.hash("text").alias("m"), "text")
    distinct = rows.groupBy("k", "m").agg(F.first("text").alias("text"), F.count("*").alias("c"))
    texts, table = _bucketed(distinct)
    long_texts = texts.where(F.octet_length("text") >= LENGTH).select("k", "m", "text", "c")

    again = map_arrow(long_texts, _anchor_task, "y long, c long").groupBy("y").agg(F.sum("c").alias("n"))
    again = materialize(again.where("n > 1").select("y"), "anchors")
    candidates = materialize(map_arrow(long_texts, _unit_task, _UNIT).join(again, "y"), "units")
    _release(spark)
    kinds = materialize(candidates.groupBy("y", "x").agg(F.sum("c").alias("n")), "kinds")
    # A unit whose anchor has one kind of unit needs no look at its bytes.
    by_anchor = kinds.groupBy("y").agg(F.count("*").alias("kinds"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("singles"))
    mixed = by_anchor.where("kinds > 1 and singles > 0").select("y", (F.col("kinds") > TOGETHER).alias("crowd"))
    classed = kinds.join(mixed, "y", "left").where("n > 1 or crowd is not null")
    known = materialize(candidates.join(classed, ["y", "x"]), "known")
    full = known.where("n > 1").select("k", "m", F.col("first").alias("a"), (F.col("last") + LENGTH).alias("b"))
    # One of each kind is enough to compare with.
    chosen = (
        known.where("crowd is not null")
        .groupBy("y", "x", "n", "crowd")
        .agg(F.min(F.struct("k", "m", "anchor", "first", "last")).alias("u"))
        .select("u.*", "y", (F.col("n") == 1).alias("single"), "crowd")
    )
    asked = chosen.groupBy("k", "m").agg(
        F.collect_list(F.struct("y", "anchor", "first", "last", "single", "crowd")).alias("wanted")
    )
    asking = texts.join(asked, ["k", "m"]).select("k", "m", "text", "wanted")
    contexts = materialize(map_arrow(asking, _context_task, _CONTEXT), "contexts")
    together = contexts.where("not crowd").repartition("y").sortWithinPartitions("y")
    partly = map_arrow(together, _suffix_task, _SPAN)
    windows = map_arrow(contexts.where("crowd"), _window_task, "k long, m int, a int, h long, l long")
    counted = windows.groupBy("h", "l").agg(F.count("*").alias("n")).where("n > 1").select("h", "l")
    crowded = windows.join(counted, ["h", "l"]).select("k", "m", "a", (F.col("a") + LENGTH).alias("b"))
    spans = materialize(full.union(partly).union(crowded), "spans")
    _release(spark)
    by_text = spans.groupBy("k", "m").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    work = texts.join(by_text, ["k", "m"], "left").select("k", "m", "text", "spans")
    result = map_arrow(work, _apply_task(keep_rest), _RESULT + (", kept binary" if keep_rest else ""))
    result = materialize(result, "result")
    for used in (again, candidates, kinds, known, contexts, spans, texts):
        discard(used)
    spark.sql(f"drop table {table}")
    return rows.select("doc_id", "k", "m").join(result, ["k", "m"]).drop("k", "m")


def _release(spark) -> None:
    """Let Spark's cleaner see that the shuffles of finished steps are not used again."""
    spark._jvm.System.gc()
