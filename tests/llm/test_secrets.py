import hashlib
import random
import re

import pytest

from barloom.llm import secrets
from barloom.llm.automaton import compile_rules, scan
from tests.llm.cases import ROWS, documents

# The three base kinds in the engine of the standard library.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def _spans(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def test_random_texts_equal_separate_searches():
    rng = random.Random(3)
    parts = ["password", "Token", "secret", "api_key", "APIKEY", "=", " : ", ":", "'", '"', "abc", "x" * 5, "0" * 11]
    parts += ["deadbeef" * 3, "AKIA", "A1B2C3D4E5F6G7H8", "é", " ", "\n", "AKIAAKIAXX", "token=token=", "=secret", "kK", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(6000)]
    data = [t.encode() for t in texts]
    n = 0
    for text, raw, spans in zip(texts, data, secrets.find_spans(data)):
        base = [s for s in secrets.in_code_points(raw, spans) if s[0] != "private_key"]
        assert base == _spans(text)
        n += len(base)
    assert n > 5000


def test_extra_rule_and_redaction():
    text = b"-----BEGIN RSA PRIVATE KEY-----\npassword=abcdefabcdefabcdefabcdef!"
    (spans,) = secrets.find_spans([text])
    assert [s[0] for s in spans] == ["private_key", "assign", "hex"]
    assert secrets.redact(text, spans) == b"[private_key]\n[assign]!"


def _key(rng, n=1190):
    import base64

    body = base64.b64encode(bytes(rng.randrange(256) for _ in range(n))).decode()
    return [body[a : a + 64] for a in range(0, len(body), 64)]


@pytest.mark.parametrize("line_end", ["\n", "\r\n", "\\n", "\n> "])
@pytest.mark.parametrize("fields", [[], ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0A1B2C3D4E5F60718293A4B5C6D7E8F9", ""]])
@pytest.mark.parametrize("last", ["-----END RSA PRIVATE KEY-----", None])
def test_no_byte_of_a_key_is_left(line_end, fields, last):
    """A whole key goes, and one that was cut off before its last line."""
    lines = _key(random.Random(5))
    key = line_end.join(["-----BEGIN RSA PRIVATE KEY-----", *fields, *lines, *([last] if last else [])])
    texts = [f"before {key}\nSome words after it.", f"é secret={key}", key, f"{key}\n\n{key}\nand on"]
    clean = [secrets.redact(t.encode(), s).decode() for t, s in zip(texts, secrets.find_spans([t.encode() for t in texts]))]
    assert clean[0] == "before [private_key]\nSome words after it."
    assert clean[1].startswith("é [assign]") and not any(line in clean[1] for line in lines)
    assert clean[2] == "[private_key]" and clean[3] == "[private_key]\n\n[private_key]\nand on"


def test_words_after_a_lone_first_line_stay():
    text = b"-----BEGIN PRIVATE KEY-----\nis the first line of a key - see RFC 7468.\n-----BEGIN CERTIFICATE-----\n-----END PRIVATE KEY-----"
    (spans,) = secrets.find_spans([text])
    assert secrets.redact(text, spans) == b"[private_key]" + text[27:]


@pytest.mark.parametrize("lanes", [1, 3, 64, 5000])
def test_lanes_do_not_change_matches(lanes):
    import numpy as np

    dfa = compile_rules(["ab+c?", "b[0-9]{2,3}", "x(y|zz)*w"], search=True)
    rng = random.Random(lanes)
    data = "".join(rng.choice("abc0123xyzw ,") for _ in range(4000)).encode()
    place, rule = scan(dfa, np.frombuffer(data, np.uint8), lanes)
    got = set(zip(place.tolist(), rule.tolist()))
    text = data.decode()
    ends = {}
    for k, pattern in enumerate(["ab+c?", "b[0-9]{2,3}", "x(y|zz)*w"]):
        p = re.compile(pattern)
        for i in range(len(text)):
            for j in range(i + 1, min(len(text), i + 40) + 1):
                if p.fullmatch(text, i, j):
                    ends[j - 1] = ends.get(j - 1, 0) | 1 << k
    assert {(p, r) for p, r in got} == set(ends.items())


def test_no_text():
    assert secrets.find_spans([]) == [] and secrets.find_spans([b"", b""]) == [[], []]


def test_documents(spark):
    rows = [*ROWS, (30, "ü token: 'abcdef123' " + "a0" * 20_000 + " AKIA" + "X" * 16, "en", "a")]
    docs = documents(spark, rows)
    got = sorted(
        (str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.digest(secrets.scan_secrets(docs)).collect()
    )
    expected = []
    for i, text, *_ in rows:
        spans = _spans(text or "")
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        n = [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        expected.append((str(i), *n, hashlib.sha256(written.encode()).hexdigest()))
    assert got == sorted(expected)
    clean = secrets.redact_secrets(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert clean.where("doc_id = 30").first().text == "ü [assign]' [hex] [access]"
    assert clean.where("doc_id = 1").first().text == rows[0][1]
    assert secrets.scan_secrets(docs.limit(0)).count() == 0
