import random

import numpy as np
import pytest
import xxhash

from barloom.llm import simhash
from barloom.llm.common import Forest
from tests.llm.cases import LONG, ROWS, documents, words


def _fingerprint(text):
    """By the words of the contract, one shingle after the other."""
    import re

    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(prints):
    tree = Forest(len(prints))
    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= 4:
                tree.union(i, j)
    return [tree.find(i) for i in range(len(prints))]


def test_fingerprints():
    rng = random.Random(1)
    texts = [r[1] for r in ROWS if r[1] != LONG] + [words(rng, n, "aBcÄé\x1c　 \t") for n in range(40)]
    assert [simhash.fingerprint(t) for t in texts] == [_fingerprint(t) for t in texts]


def _near(rng, n):
    base = rng.integers(0, 2**63, n, dtype=np.uint64)
    flips = base[: n // 2].copy()
    for _ in range(5):
        at = rng.integers(0, 64, len(flips)).astype(np.uint64)
        flips ^= (np.uint64(1) << at) * (rng.random(len(flips)) < 0.7).astype(np.uint64)
    # A dense ball: more fingerprints near one another than a group of the index holds.
    ball = base[0] ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64))
    return np.unique(np.concatenate((base, flips, ball)))


@pytest.mark.parametrize("n", [1, 2, 50, 900])
def test_links_equal_brute_force(n):
    prints = _near(np.random.default_rng(n), n)
    edges = simhash.links(prints)
    place = {p: i for i, p in enumerate(prints.tolist())}
    tree = Forest(len(prints))
    for a, b in edges.tolist():
        assert bin(a ^ b).count("1") <= 4
        assert tree.union(place[a], place[b]), "edges are a forest"
    assert [tree.find(i) for i in range(len(prints))] == _components(prints.tolist())


@pytest.mark.parametrize("block", [4096, 16])
def test_distributed_index_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    prints = _near(np.random.default_rng(8), 500).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in prints], "fp long").repartition(4)
    edges = simhash.fingerprint_links(df).collect()
    place = {p: i for i, p in enumerate(prints)}
    tree = Forest(len(prints))
    for a, b in edges:
        tree.union(place[a], place[b])
    assert [tree.find(i) for i in range(len(prints))] == _components([p & (2**64 - 1) for p in prints])


def test_documents(spark):
    rng = random.Random(6)
    text = words(rng, 300)
    rows = [*ROWS, (20, text, "en", "a"), (21, text + " tail", "en", "a"), (22, words(rng, 300), "en", "a")]
    docs = documents(spark, rows)
    got = {}
    for r in simhash.simhash_groups(docs).collect():
        got.setdefault(r.doc_id, set()).add((r.fp & (2**64 - 1), r.component_id))
    prints = [_fingerprint(r[1]) if r[1] != LONG else simhash.fingerprint(LONG) for r in rows]
    roots = _components(prints)
    least = {}
    for root, r in zip(roots, rows):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    expected = {}
    for p, root, r in zip(prints, roots, rows):
        expected.setdefault(r[0], set()).add((p, least.get(root)))
    assert got == expected
    kept = simhash.simhash_keep(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({i for i in least.values()})
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_texts_that_share_an_id_stay_apart(spark):
    one, two = "the quick brown fox jumps over the lazy dog", "entirely other words stand in this second text here"
    rows = [
        (1, one, "en", "a"), (1, two, "en", "a"), (1, one, "en", "b"), (2, two, "en", "a"), (3, one, "en", "a"),
        (None, one, "en", "a"), (None, one, "en", "a"), (9, None, "en", "a"), (8, "", "en", "a"), (8, " ", "en", "a"),
    ]
    docs = documents(spark, rows)
    kept = simhash.simhash_keep(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id or 0, r.text) for r in kept.collect()), key=str)
    # Texts without words are one group; its smallest id is 8, and one of its two texts stays.
    blank = [g for g in got if g[0] == 8]
    assert sorted(g for g in got if g[0] != 8) == sorted([(0, one), (0, one), (1, two), (1, one)])
    assert len(blank) == 1 and blank[0][1] in ("", " ") and len(got) == 5
