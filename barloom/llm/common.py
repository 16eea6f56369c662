"""Helpers shared by the corpus operators: scratch tables, Arrow batches, components."""

from __future__ import annotations

import functools
import io
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from barloom.sinks import scratch_dir

SLICE_ROWS = 512
SLICE_BYTES = 8 << 20


@functools.cache
def _ship(application: str) -> None:
    """Give the library to the application's Python workers, once, by the shared folder."""
    context = SparkContext.getOrCreate()
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    package = Path(__file__).resolve().parent.parent
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    target = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark, "library") + "/barloom.zip")
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(target)
    out.write(archive.getvalue())
    out.close()
    context.addPyFile(store.makeQualified(target).toString())


def map_arrow(df: DataFrame, task: Callable, schema) -> DataFrame:
    """``df.mapInArrow(task, schema)`` on executors that need not have the library."""
    _ship(df.sparkSession.sparkContext.applicationId)
    return df.mapInArrow(task, schema)


def apply_arrow(grouped: GroupedData, task: Callable, schema) -> DataFrame:
    """``grouped.applyInArrow(task, schema)`` on executors that need not have the library."""
    _ship(grouped.session.sparkContext.applicationId)
    return grouped.applyInArrow(task, schema)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the cluster's shared scratch folder and read again.

    This cuts the lineage: a lost executor never makes Spark recompute what is before.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that :func:`materialize` made."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that begins with ``base`` and that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def named(column: str) -> Column:
    """A top-level column by its literal name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def slices(batches: Iterable[pa.RecordBatch], text: int = 1) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one slice holds few rows and few bytes of the ``text`` column.

    One row is never cut: a slice has one row at least, however long its text is.
    """
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        column = batch.column(text)
        lengths = pc.fill_null(pc.binary_length(column), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < n:
            before = ends[at - 1] if at else 0
            to = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
            to = min(max(to, at + 1), at + SLICE_ROWS, n)
            yield batch.slice(at, to - at)
            at = to


def groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of equal values in the first ``keys`` columns of a sorted stream.

    The columns compared must be non-null integers. One group is held at a time, plus
    one batch.
    """
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(n - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), n]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over small integers, for links found inside one task."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph given as edges (a, b) of longs.

    ``component`` is the smallest node that can be reached. Nodes without an edge do not
    occur. Alternating star contractions: every step is a grouped minimum, combined
    before its shuffle, and a join that adaptive execution can split where a star is
    large. Rounds grow with the logarithm of the longest path.
    """
    spark = edges.sparkSession
    pairs = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    pairs = materialize(pairs.distinct(), "links")
    mark = _mark(pairs)
    while mark[0]:
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where("a <> b").distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        )
        following = materialize(small.select("e.*").where("a <> b").distinct(), "links")
        discard(pairs)
        discard(large)
        pairs, before, mark = following, mark, _mark(following)
        if mark == before:
            break
    if not mark[0]:
        return spark.createDataFrame([], "node long, component long")
    roots = pairs.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _mark(pairs: DataFrame) -> tuple[int, int]:
    row = pairs.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"] or 0
