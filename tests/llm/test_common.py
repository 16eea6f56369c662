import random

import pyarrow as pa
import pytest

from barloom.llm import common


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)]
    edges += [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2000 + i) for i in range(200)] + [(5, 5)]
    tree = common.Forest(3000)
    for a, b in edges:
        tree.union(a, b)
    touched = {x for a, b in edges if a != b for x in (a, b)}
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    got = {r.node: r.component for r in common.components(df).collect()}
    assert got == {x: tree.find(x) for x in touched}


def test_no_edges(spark):
    assert common.components(spark.createDataFrame([(3, 3)], "a long, b long")).count() == 0


def test_slices_keep_every_row_and_bound_bytes(monkeypatch):
    monkeypatch.setattr(common, "SLICE_BYTES", 100)
    texts = ["x" * n for n in (0, 10, 90, 500, 1, 99, 101)] + [None, "y"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["i", "t"])
    parts = list(common.slices([batch, batch.slice(0, 0)]))
    assert [r for p in parts for r in p.column(0).to_pylist()] == list(range(len(texts)))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 100 for p in parts)


def test_groups_join_batches():
    keys = [1, 1, 2, 2, 2, 3, 3, 4]
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 3])], names=["k"]) for i in range(0, 8, 3)]
    assert [t.column(0).to_pylist() for t in common.groups(batches, 1)] == [[1, 1], [2, 2, 2], [3, 3], [4]]
