import collections
import hashlib
import random

import numpy as np
import pytest

from barloom.llm import repeats
from tests.llm.cases import ROWS, documents, words


def _brute(texts):
    seen = collections.Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for t in texts:
        covered = np.zeros(len(t) + 1, int)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                covered[i] += 1
                covered[i + 200] -= 1
        gone = np.cumsum(covered)[: len(t)] > 0
        rest = bytes(b for b, c in zip(t, gone) if not c)
        runs = sum(1 for j in range(len(t)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return out


def _texts():
    rng = random.Random(5)
    passages = [words(rng, rng.randrange(30, 120)) for _ in range(20)]
    texts = [None, "", "a" * 199, "a" * 200, "a" * 700, "ab" * 300, "b" * 200, "xyz" * 400, passages[0], passages[0]]
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(passages) if rng.random() < 0.5 else words(rng, 60)
            if rng.random() < 0.4:
                i = rng.randrange(len(p))
                p = p[:i] + rng.choice("XYZ") + p[i:]
            if rng.random() < 0.3:
                p = p[rng.randrange(len(p)) :]
            parts.append(p)
        texts.append(rng.choice([" ", "", "é"]).join(parts))
    return [*texts, "\0" * 300 + passages[1] + "\0" * 50, "\0" * 250]


@pytest.mark.parametrize("together", [4096, 2])
def test_equals_brute_force(spark, monkeypatch, together):
    """Also where an anchor has more distinct units than are compared together."""
    monkeypatch.setattr(repeats, "TOGETHER", together)
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.repeated_bytes(docs).collect()}
    expected = _brute([(t or "").encode() for t in texts])
    assert [found[i] for i in range(len(texts))] == expected
    assert sum(e[1] for e in expected) > 10_000


def test_units_cover_every_window_once():
    rng = random.Random(1)
    for text in (words(rng, 400), "a" * 900, "abc" * 300, "x" * 200, "y" * 199):
        data = text.encode()
        anchors, first, last = repeats.units(data)
        starts = [s for a, b in zip(first.tolist(), last.tolist()) for s in range(a, b + 1)]
        assert starts == list(range(max(0, len(data) - 199)))
        assert all(a <= p and p + repeats.CONTEXT <= b + repeats.LENGTH for p, a, b in zip(last, first, last) if p >= a)
        assert ((anchors >= last) & (anchors <= first + 160)).all()


@pytest.mark.parametrize("n", [2, 3, 9, 150])
def test_shared_offsets_equal_brute_force(n):
    rng = random.Random(n)
    base = "".join(rng.choice("abcd ") for _ in range(400)).encode()
    contexts, anchors = [], []
    for _ in range(n):
        left = rng.randrange(0, 161)
        right = rng.randrange(max(40, 200 - left), 201)
        part = bytearray(base[200 - left : 200 + right])
        for _ in range(rng.randrange(3)):
            part[rng.randrange(len(part))] = rng.choice(b"abcd\0")
        contexts.append(bytes(part))
        anchors.append(left)
    seen = collections.defaultdict(set)
    for i, (c, a) in enumerate(zip(contexts, anchors)):
        for d in range(161):
            if d <= a and 200 - d <= len(c) - a:
                seen[d, c[a - d : a - d + 200]].add(i)
    expected = np.zeros((n, 161), bool)
    for (d, _), owners in seen.items():
        if len(owners) > 1:
            expected[list(owners), d] = True
    assert (repeats.shared_offsets(contexts, anchors, np.arange(n)) == expected).all()


def test_documents(spark):
    docs = documents(spark)
    out = repeats.repeated_bytes(docs, keep_rest=True).collect()
    assert len(out) == len(ROWS)
    kept = {r.doc_id: bytes(r.kept) for r in out if r.doc_id is not None}
    # The long text and the run of one letter repeat themselves; the rest is short.
    assert kept[5] == kept[6] == kept[8] == b"" and kept[2] == b"" and kept[7] == b"123 456 --- !!!"
    assert repeats.repeated_bytes(docs.limit(0)).count() == 0
