"""Byte-level BPE by dynamic programming over the prefixes of a word.

An encoded prefix is known by its last token alone, and that token is unique: it is the
one token that ends the prefix and stands correctly next to the last token of what is
before it. The automaton of all tokens gives, by its suffix links, every token that ends
at a byte; a pair test tells whether BPE would ever merge across two tokens. One last
token is stored per prefix, and following them back from the end gives the ids. Time is
linear in the length of a word, so a word of megabytes is no special case.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from barloom.llm.common import map_arrow, named, slices

DEFAULT_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Words, and pairs of tokens, remembered by a task at most (each is kept twice over).
REMEMBERED = 300_000

# How the byte-level scheme cuts a text into words.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_SPACE = r"[\p{White_Space}]"
_WORDS = regex.compile(
    _CONTRACTIONS
    + r"| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    + rf"|{_SPACE}+(?!\P{{White_Space}})|{_SPACE}+"
)
# The same cut for texts of ASCII alone; the controls 28 to 31 are no white space here.
_ASCII_WORDS = re.compile(
    _CONTRACTIONS
    + r"| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"
)


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Bpe:
    """Tables of one vocabulary file, and the encoder over them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = _byte_letters()
        vocabulary = data["model"]["vocab"]
        self.bytes_of: dict[int, bytes] = {
            i: bytes(letters[c] for c in t) for t, i in vocabulary.items() if all(c in letters for c in t)
        }
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self._cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self._merge: dict[tuple[int, int], int] = {}
        self._made: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left, right, joined = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self._merge[left, right] = rank
            self._made.setdefault(joined, (rank, left, right))
        # Tokens along the right and left edge of each token: (token, made at, merged away at).
        self._right: dict[int, tuple] = {}
        self._left: dict[int, tuple] = {}
        self._automaton = ahocorasick.Automaton()
        taken = set(self.special.values())
        for token, text in self.bytes_of.items():
            if token in taken or (len(text) > 1 and not self._reachable(token)):
                continue
            self._automaton.add_word(text.decode("latin-1"), (token, len(text)))
        self._automaton.make_automaton()
        self._pairs: dict[int, bool] = {}
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        top = max(self.bytes_of) + 1
        self._text_of = [self.bytes_of.get(i, b"") for i in range(top)]

    def _edge(self, token: int, side: int) -> tuple[tuple[int, int, int], ...]:
        """(token, rank it is made at, rank it is merged away at), outermost last."""
        known = self._left if side == 1 else self._right
        if token not in known:
            edge, end, at = [], 1 << 60, token
            while True:
                made = self._made.get(at)
                edge.append((at, made[0] if made else -1, end))
                if not made:
                    break
                end, at = made[0], made[side]
            known[token] = tuple(edge)
        return known[token]

    def _apart(self, left: int, right: int, before: int = 1 << 60) -> bool:
        """Whether no merge earlier than ``before`` joins a part of both tokens.

        The parts next to the cut are the right edge of one and the left edge of the
        other token. A merge of two such parts happens if both exist at its rank; at
        equal ranks the leftmost goes first.
        """
        a, b = self._edge(left, 2), self._edge(right, 1)
        i = j = 0
        while i < len(a) and j < len(b):
            (x, x_made, x_end), (y, y_made, y_end) = a[i], b[j]
            rank = self._merge.get((x, y), -1)
            if rank >= 0 and max(x_made, y_made) < rank < min(x_end, before) and rank <= y_end:
                return False
            if x_made >= y_made:
                i += 1
            else:
                j += 1
        return True

    def _reachable(self, token: int) -> bool:
        made = self._made.get(token)
        return bool(made) and self._apart(made[1], made[2], made[0])

    def encode_word(self, word: str) -> bytes:
        """Ids of one word as little-endian unsigned 32-bit integers."""
        text = word if word.isascii() else word.encode().decode("latin-1")
        pairs = self._pairs
        last, size = [0] * (len(text) + 1), [0] * (len(text) + 1)
        done = -1
        for at, (token, length) in self._automaton.iter(text):
            if at == done:
                continue
            end = at + 1
            if end != length:
                before = last[end - length]
                pair = before << 32 | token
                fits = pairs.get(pair)
                if fits is None:
                    if len(pairs) >= 2 * REMEMBERED:
                        pairs.clear()
                    fits = pairs[pair] = self._apart(before, token)
                if not fits:
                    continue
            last[end], size[end], done = token, length, at
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at -= size[at]
        ids.reverse()
        return array("I", ids).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a word that the newer memory lacks."""
        ids = self._new.get(word) or self._old.get(word) or self.encode_word(word)
        if len(self._new) >= REMEMBERED:
            self._old, self._new = self._new, {}
        if len(word) <= 64:
            self._new[word] = ids
        return ids

    def encode(self, text: str, specials: bool = True) -> bytes:
        """Ids of ``text``; strings of added tokens become those tokens if ``specials``."""
        if specials and any(s in text for s in self.special):
            parts = self._cut.split(text)
            return b"".join(
                np.uint32(self.special[p]).astype("<u4").tobytes() if k % 2 else self.encode(p, False)
                for k, p in enumerate(parts)
            )
        words = (_ASCII_WORDS if text.isascii() else _WORDS).findall(text)
        out = list(map(self._new.get, words))
        at = -1
        for _ in range(out.count(None)):
            at = out.index(None, at + 1)
            out[at] = self._word(words[at])
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of packed ids; bytes that are no UTF-8 become replacement characters."""
        texts = self._text_of
        return b"".join([texts[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode(errors="replace")


@functools.cache
def vocabulary(path: str) -> Bpe:
    """The tables of ``path``, made once per process."""
    return Bpe(path)


_ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = DEFAULT_VOCABULARY,
    keep_ids: bool = False,
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every whole text.

    With ``keep_ids`` the ids follow as ``ids``, packed as little-endian unsigned 32-bit
    integers. A null text counts as empty: no tokens, digests of nothing. Nothing is
    shuffled; repeated rows give repeated results, extra columns are not read. ``path``
    must be readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in slices(batches):
            packed = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
            columns = [
                batch.column(0),
                pa.array([len(p) // 4 for p in packed], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                pa.array([hashlib.sha256(bpe.decode(p).encode()).hexdigest() for p in packed]),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.array(packed, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, _ENCODED + (", ids binary" if keep_ids else ""))


def decode_documents(encoded: DataFrame, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``doc_id`` and ``text`` from packed ``ids``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in slices(batches):
            texts = [bpe.decode(p or b"") for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, text string")
