import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from barloom.llm import bpe
from tests.llm.cases import ROWS, documents


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.DEFAULT_VOCABULARY)


def test_random_texts_equal_the_library(library):
    own = bpe.vocabulary(bpe.DEFAULT_VOCABULARY)
    rng = random.Random(3)
    letters = "abcdeéßñ  \n\t'\x1c\x85　ſ²½٣क्ि漢字😀👩‍👧ABC123.,!?-_=<|>\r\x0b\x00​Ⅻ"
    pieces = ["don't", "<|endoftext|>", " the", "  ", "hello", "aaaaaaaa", "I'll", "----", "     x"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) if rng.random() < 0.3 else rng.choice(letters) for _ in range(rng.randrange(40)))
        expected = library.encode(text, add_special_tokens=False).ids
        packed = own.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == expected
        assert own.decode(packed) == library.decode(expected, skip_special_tokens=False)


def test_one_long_word_takes_linear_time(library):
    own = bpe.vocabulary(bpe.DEFAULT_VOCABULARY)
    for text in ("ab" * 5000 + "é" * 3000, "=" * 5000, "tokentokens" * 700):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(own.encode("a" * 1_000_000)) % 4 == 0


def test_memory_is_bounded_without_changing_ids(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    small = bpe.Bpe(bpe.DEFAULT_VOCABULARY)
    text = " ".join(f"word{i % 40} and more{i}" for i in range(300))
    assert small.encode(text) == bpe.vocabulary(bpe.DEFAULT_VOCABULARY).encode(text)


def test_documents(spark, library):
    docs = documents(spark)
    out = bpe.encode_documents(docs, keep_ids=True)
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect())
    expected = []
    for i, text, *_ in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append(
            (
                str(i),
                len(ids),
                hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest(),
            )
        )
    assert got == sorted(expected)
    back = bpe.decode_documents(out)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(r[0]), r[1] or "") for r in ROWS)
    assert bpe.encode_documents(docs.limit(0)).count() == 0
