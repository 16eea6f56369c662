import base64
import hashlib
import random
import time

import pytest

from barloom.llm import warc
from barloom.sinks import scratch_dir

SCHEMA = "page_id long, url string, html string, payload string, digest int, first int"


def _expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        key = (html or "").encode()
        if i is not None and len(key) >= least:
            first[key] = min(first.get(key, i), i)
    out = []
    for i, _, html in rows:
        key = (html or "").encode()
        to = first.get(key)
        revisit = to is not None and to != i
        digest = base64.b32encode(hashlib.sha1(key).digest()).decode()
        out.append((i, len(key), digest, "revisit" if revisit else "response", to if revisit else None))
    return sorted(map(str, out))


def _rows():
    rng = random.Random(4)
    noise = "".join(chr(rng.randrange(32, 0x2FF)) for _ in range(60_000))
    magic = "\x1f\x8b\x08 WARC/1.1\r\n\r\n" * 20
    rows = [(i, f"http://x/{i} ü\r\n", rng.choice(["same", None, "", magic, noise[i * 100 : i * 300 + 50]])) for i in range(60)]
    return rows + [(None, None, "same"), (None, "u", "lonely"), (5, "again", "same"), (-3, "u", magic), (99, "u", noise)]


@pytest.mark.parametrize("split", [97, 5_000, 1 << 30])
def test_round_trip_at_any_split(spark, monkeypatch, split):
    monkeypatch.setattr(warc, "FILE_BYTES", 30_000)
    rows = _rows()
    pages = spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SCHEMA).repartition(4)
    files = warc.write_warc(pages, scratch_dir(spark, "warc"))
    back = warc.read_warc(files, split, payload=True).collect()
    got = sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in back)
    assert got == _expected(rows)
    assert all(r.intact for r in back)
    assert sorted(bytes(r.payload) for r in back if r.payload is not None and r.page_id is None) == [b"lonely"]


def test_least_bytes_and_listing(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = scratch_dir(spark, "warc")
    warc.write_warc(pages, folder, least_bytes=3)
    back = warc.read_warc(warc.list_warc(spark, f"{folder}/*.warc.gz")).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in back) == [
        (1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3),
    ]


def test_bytes_between_records_are_passed_over(spark, tmp_path):
    one = warc._record(1, "u", b"one", warc.base32("ab" * 20), None)
    two = warc._record(2, "u", b"two", warc.base32("cd" * 20), 1)
    data = b"junk \x1f\x8b\x08 junk" + one + b"\x1f\x8b\x08\x00" * 9 + two + b"\x1f\x8b"
    (tmp_path / "a.warc.gz").write_bytes(data)
    files = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz", len(data))], "path string, bytes long")
    for split in (1, 50, 10_000):
        back = warc.read_warc(files, split).collect()
        assert sorted((r.page_id, r.record_type, r.intact) for r in back) == [(1, "response", False), (2, "revisit", True)]


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_warc(warc.write_warc(empty, scratch_dir(spark, "warc"))).count() == 0


def test_every_reference_is_a_record_of_the_archive(spark):
    rows = _rows()
    pages = spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SCHEMA).repartition(4)
    back = warc.read_warc(warc.write_warc(pages, scratch_dir(spark, "warc"))).collect()
    responses = {r.record_id: r for r in back if r.record_type == "response"}
    revisits = [r for r in back if r.record_type == "revisit"]
    assert len(revisits) > 10 and len({r.record_id for r in back}) == len(back)
    for r in revisits:
        to = responses[r.refers_to_record]
        assert (to.page_id, to.payload_digest) == (r.refers_to, r.payload_digest)


class _Store:
    """One file in memory that counts what is read of it."""

    def __init__(self, data):
        self.data, self.read_bytes = data, 0

    def open_input_file(self, path):
        return self

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return None

    def size(self):
        return len(self.data)

    def seek(self, position):
        self.at = position

    def read(self, n):
        self.read_bytes += n
        self.at += n
        return self.data[self.at - n : self.at]


def test_reading_is_linear_in_long_and_in_many_records():
    rng = random.Random(6)
    long = rng.randbytes(24 << 20)
    member = warc._record(1, "u", long, warc.base32(hashlib.sha1(long).hexdigest()), None)
    small = warc._record(2, "u", b"small", warc.base32("ab" * 20), None)
    for data, n in ((member, 1), (small * 20_000, 20_000), (small + member + small, 3)):
        store = _Store(data)
        found = list(warc._records(store, "a", 0, len(data)))
        assert len(found) == n and found[0][0] == 0
        assert store.read_bytes <= len(data) + 2 * warc.READ_BYTES
    assert warc._parsed(found[1][1])[2] == long
    assert [o for o, _ in found] == [0, len(small), len(small) + len(member)]


def test_time_grows_with_the_length_of_a_record():
    def seconds(n):
        payload = random.Random(1).randbytes(n)
        member = warc._record(1, "u", payload, warc.base32("ab" * 20), None)
        begin = time.perf_counter()
        assert len(list(warc._records(_Store(member), "a", 0, len(member)))) == 1
        return time.perf_counter() - begin

    seconds(1 << 20)
    assert seconds(64 << 20) < 8 * 3 * max(seconds(8 << 20), 0.01)
