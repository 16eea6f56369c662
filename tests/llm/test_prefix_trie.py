import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from barloom.llm import prefix_trie, queries
from barloom.llm.prefix_trie import as_they_are, marked_turns, share_openings

SCHEMA = "conv_id long, turn long, role string, text string, mark string, path int, part string, shard long, n long"


def _table(spark, rows):
    """Turns with columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, "m", 1, "p", 2, 3) for r in rows], SCHEMA).repartition(3)


def _conversations(rows, shared):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append((turn is not None, turn or 0, mark, (role, text)))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    if not shared:
        return own
    first = lambda c: c - (c % 100 if c >= 0 else -(-c % 100))
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(first(c), [])[: h[c]] + turns[h[c] :] for c, turns in own.items()}


def _brute_force(rows, shared=True):
    convs = _conversations(rows, shared)
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return {
        (
            min(m),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(m),
            children[node],
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    }


def _rows(n=230, seed=5):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), n):
        turns = rng.choice([0, 1, 1, 2, 3, 4, 7, 9])
        for t in range(turns):
            text = rng.choice(["hi", "é", "hi", "", None, "x" * 5]) if t < 6 else f"{c}"
            rows.append((c, t, rng.choice(["user", None, "assistant"]) if t else "user", text))
    return rows


AWKWARD = [
    (None, 0, "user", "no conversation"),
    (1000, None, "user", "null turn is first"),
    (1000, 0, "user", "then this"),
    (1000, 0, "user", "then this"),
    (1000, 0, None, None),
    (1001, 0, "user", "long " * 20_000),
    (-5, 0, "user", "negative"),
    (-105, 3, "user", "negative"),
    (0, 0, "a", "b1"),
    (0, 1, "a:", "b"),
    (0, 2, "a", ":b"),
]


def _got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("shards", [None, 1, 60])
def test_trie_equals_brute_force(spark, shards):
    rows = _rows() + AWKWARD
    turns = marked_turns(_table(spark, rows))
    assert _got(prefix_trie.prefix_trie(share_openings(turns), shards)) == _brute_force(rows)


def test_runs_of_equal_conversations_are_cut(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 20)
    same = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(3)]
    longer = [(1000 + c, t, "user", f"turn {t}") for c in range(40) for t in range(3 + c % 4)]
    rows = same + longer + _rows(40)
    got = prefix_trie.prefix_trie(as_they_are(marked_turns(_table(spark, rows))), 30)
    assert _got(got) == _brute_force(rows, shared=False)


def test_deep_common_openings(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "DEEP", 4)
    rows = [(c, t, "user", f"{t}" if t < 12 else f"{c} {t}") for c in range(60) for t in range(14)]
    got = prefix_trie.prefix_trie(as_they_are(marked_turns(_table(spark, rows))), 12)
    assert _got(got) == _brute_force(rows, shared=False)


def test_skeleton_holds_every_node_that_spans_shards(spark):
    rng = random.Random(2)
    found = sorted((b"".join(rng.choice([b"a", b"b"]) * 16 for _ in range(rng.randrange(6))), c) for c in range(500))
    skeleton = prefix_trie.Skeleton(prefix_trie.separators(found[::5], 25))
    shards = defaultdict(set)
    for path, conv in found:
        for at in range(0, len(path) + 1, 16):
            shards[path[:at]].add(skeleton.shard(path, conv))
    assert sorted(skeleton.shard(p, c) for p, c in found) == [skeleton.shard(p, c) for p, c in found]
    known = {path[:at] for path, _ in skeleton.cuts for at in range(0, len(path) + 1, 16)}
    assert len(skeleton.cuts) > 10 and {p for p, s in shards.items() if len(s) > 1} <= known


def test_empty_table_and_one_without_turns(spark):
    assert _got(prefix_trie.prefix_trie(share_openings(marked_turns(_table(spark, []))))) == set()
    # crc32("7") % 6 turns are skipped, and family 0 is not there.
    rows = [(7, 0, "user", "alone")]
    assert _got(prefix_trie.prefix_trie(share_openings(marked_turns(_table(spark, rows))))) == _brute_force(rows)


def test_registered_query_against_sql(spark, tmp_path):
    rows = _rows(90) + AWKWARD
    _table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = _got(queries.op13_prefix_trie(spark, str(tmp_path)))
    duck = duckdb.connect()
    duck.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert got == set(duck.execute(prefix_trie.TRIE_SQL).fetchall()) == _brute_force(rows)
