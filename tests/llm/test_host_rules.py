import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from barloom.llm import host_rules, queries
from tests.llm.cases import ROWS, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def _got(df):
    return sorted(
        (r.doc_id is not None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        for r in df.collect()
    )


def _expected(rows):
    return sorted((i is not None, i or 0, *_measures(t)) for i, t, *_ in rows)


def _texts():
    rng = random.Random(3)
    vocabulary = ["a", "b", "é", "漢", "#x", "$$", "w w", " "]
    rows = [
        (100 + i, "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "\r\n", "\t", "  ", "\x0b"]) for _ in range(i)), "en", f"s{i % 4}")
        for i in range(60)
    ]
    return rows + [(900, "a b c a b c", "en", "s1"), (901, "a a a a", "en", None), (902, "a\n\n a\na\n#|<>", "", "s1")]


def test_measures_equal_brute_force(spark):
    rows = ROWS + _texts()
    assert _got(host_rules.measure(documents(spark, rows))) == _expected(rows)


def test_a_repeated_window_is_counted_over_a_long_text(spark):
    text = " ".join(f"w{i}" for i in range(30_000)) + " w7 w8 w9"
    (row,) = host_rules.measure(documents(spark, [(1, text, "en", "a")])).collect()
    assert (row.n_words, row.n_repeat_words) == (30_003, 6)


def test_hosts_of_urls(spark):
    names = ["http://WWW.Example.org:80/a?b=c", "https://blog.x.net/#t", "src1", " ", "", None, "http://", "a b"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(host_rules.host(df["n"])).collect()]
    assert got == ["example.org", "blog.x.net", "src1", None, None, None, "http://", "a b"]


GOOD = " ".join(f"word{i}" for i in range(60))


def _hosts(counts):
    """Documents of each host: so many good ones and so many short ones."""
    rows = []
    for name, (good, bad) in counts.items():
        rows += [(len(rows) + k, GOOD, "en", name) for k in range(good)]
        rows += [(len(rows) + k, "too short", "en", name) for k in range(bad)]
    return rows


def _rates(counts):
    """Shrunken rates of the rule ``short``, by the textbook formulas."""
    p = {h: b / (g + b) for h, (g, b) in counts.items()}
    n = {h: g + b for h, (g, b) in counts.items()}
    mean = sum(p.values()) / len(p)
    spread = mean * (1 - mean)
    excess = sum(x * x for x in p.values()) / len(p) - mean**2 - spread * sum(1 / m for m in n.values()) / len(n)
    strength = max(spread / excess - 1, 0) if excess * 1e6 > spread else 1e6
    return {h: (counts[h][1] + mean * strength) / (n[h] + strength) for h in counts}


def test_rates_are_shrunk_by_what_hosts_have_in_common(spark):
    counts = {"bad": (1, 40), "tiny": (0, 1), "big": (300, 3), **{f"h{i}": (20, i % 3) for i in range(30)}}
    measured = host_rules.measure(documents(spark, _hosts(counts)))
    got = {r.host: r.rate_short for r in host_rules.host_rates(measured).collect()}
    assert got == pytest.approx(_rates(counts), rel=1e-6)
    # One document says little about its host, forty say much.
    assert got["tiny"] < 0.6 and got["bad"] > 0.9


def test_verdicts_reach_the_documents(spark):
    counts = {"bad": (2, 40), "half": (1, 1), **{f"h{i}": (20, 1) for i in range(30)}}
    rows = _hosts(counts) + [(5000, GOOD, "en", None), (5001, "x", "en", None), (5002, GOOD, "en", None)]
    kept, failed = defaultdict(set), defaultdict(set)
    for r in host_rules.judge(documents(spark, rows)).collect():
        kept[r.host].add((r.base_failed, r.kept))
        failed[r.host].add(r.host_failed)
    assert kept["bad"] == {(False, False), (True, False)}
    assert failed["bad"] == {True} and failed["half"] == failed["h3"] == failed[None] == {False}
    assert kept["half"] == kept["h3"] == kept[None] == {(False, True), (True, False)}


def test_hosts_that_differ_by_chance_only_share_their_rate(spark):
    rates = host_rules.host_rates(host_rules.measure(documents(spark, _hosts({"a": (3, 1), "b": (3, 1)}))))
    assert {round(r.rate_short, 4) for r in rates.collect()} == {0.25}


def test_empty_table_and_only_nulls(spark):
    assert host_rules.judge(documents(spark, [])).collect() == []
    (row,) = host_rules.judge(documents(spark, [(None, None, None, None)])).collect()
    assert (row.n_words, row.base_failed, row.kept) == (0, True, False)


def test_only_built_in_expressions(spark):
    plan = host_rules.measure(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ColumnarToRow", "")


def test_registered_query_against_sql(spark, tmp_path):
    rows = ROWS + _texts() + _hosts({"bad": (3, 40), **{f"h{i}": (4, 1) for i in range(12)}})
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_host_rules(spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    key = lambda row: [(v is not None, v or 0) for v in row]
    expected = duck.execute(host_rules.HOST_RULES_SQL).fetchall()
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(expected, key=key)
    assert {r.kept for r in got.collect() if r.doc_id and r.n_words == 60} == {True, False}
