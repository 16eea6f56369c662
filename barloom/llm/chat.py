"""Chat formatting at the level of tokens.

Role and text of every turn are encoded on their own, and reserved ids are spliced
between them, so no text can ever produce a control token. The loss mask comes from
prefix sums: segment lengths give the places where loss begins and ends, marked by +1
and -1, and the running sum of the marks is the mask. Control strings inside texts are
escaped reversibly, so that the rendered text is unambiguous too.

Template of a turn: start, role, separator, text, end. Rendered:
``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line end.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.bpe import DEFAULT_VOCABULARY, Bpe, vocabulary
from barloom.llm.common import map_arrow, named, slices

LOSS_ROLE = "assistant"
# Control strings; their ids follow the vocabulary's last one in this order.
CONTROL = ("<|im_start|>", "<|im_sep|>", "<|im_end|>\n")

_OPENING = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left; :func:`unescape` gives the text back."""
    return _OPENING.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def reserved(bpe: Bpe) -> tuple[int, int, int]:
    first = max(bpe.bytes_of) + 1
    return first, first + 1, first + 2


def _encode_task(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        controls = [np.uint32(i).astype("<u4").tobytes() for i in reserved(bpe)]
        extra = sum(map(len, CONTROL))
        for batch in slices(batches):
            ids, lengths, loss, chars = [], [], [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist()):
                shown_role, shown = escape(role or ""), escape(text or "")
                parts = [controls[0], bpe.encode(shown_role, False), controls[1], bpe.encode(shown, False), controls[2]]
                ids.append(b"".join(parts))
                lengths.append([len(p) // 4 for p in parts])
                loss.append(role == LOSS_ROLE)
                chars.append(len(shown_role) + len(shown) + extra)
            # One running sum over the tokens of all turns of the slice.
            ends = np.cumsum(np.array(lengths), axis=None).reshape(-1, 5)
            marks = np.zeros(int(ends[-1, -1]) + 1, np.int8)
            under = np.array(loss)
            np.add.at(marks, ends[under, 2], 1)
            np.add.at(marks, ends[under, 3], -1)
            mask = np.cumsum(marks[:-1], dtype=np.int8).tobytes()
            begins = [0, *ends[:-1, -1].tolist()]
            masks = [mask[a:b] for a, b in zip(begins, ends[:, -1].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(3),
                    pa.array(ids, pa.binary()),
                    pa.array(masks, pa.binary()),
                    pa.array(chars, pa.int64()),
                ],
                names=["conv_id", "turn", "ids", "mask", "chars"],
            )

    return run


def _number_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position and first token of each turn, running over a sorted partition."""
    last, position, token = object(), 0, 0
    for batch in batches:
        positions, tokens = [], []
        for conv, ids in zip(batch.column(0).to_pylist(), batch.column(2)):
            if conv != last:
                last, position, token = conv, 0, 0
            positions.append(position)
            tokens.append(token)
            position += 1
            token += len(ids.as_buffer()) // 4
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(positions, pa.int64()),
                pa.array(tokens, pa.int64()),
                *batch.columns[2:],
            ],
            names=["conv_id", "position", "first_token", "ids", "mask", "chars"],
        )


def format_conversations(turns: DataFrame, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """One row per turn: ``conv_id``, ``position``, ``first_token``, ``ids``, ``mask``, ``chars``.

    ``turns`` has conv_id, turn, role and text. The tokens of a conversation are the
    rows' ``ids`` (packed, unsigned 32 bits) in order of ``position``; ``mask`` has one
    byte per token, 1 under loss. A conversation is never held as a whole, so one of any
    length passes. Null texts and roles count as empty, null turns come first, equal
    turns stand in the order of their tokens, null conversation ids are one
    conversation. Extra columns are not read.
    """
    rows = turns.select(
        named("conv_id").cast("long").alias("conv_id"),
        named("text").cast("string").alias("text"),
        named("role").cast("string").alias("role"),
        named("turn").cast("long").alias("turn"),
    )
    encoded = map_arrow(rows, _encode_task(path), "conv_id long, turn long, ids binary, mask binary, chars long")
    laid = encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids")
    return map_arrow(
        laid, _number_task, "conv_id long, position long, first_token long, ids binary, mask binary, chars long"
    )


def parse_turn(bpe: Bpe, ids: np.ndarray, controls: tuple[int, int, int] | None = None) -> tuple[str, str]:
    """(role, text) from the tokens of one turn; ``controls`` are the vocabulary's reserved ids."""
    return tuple(unescape(shown) for shown in _shown(bpe, ids, controls or reserved(bpe)))


def _shown(bpe: Bpe, ids: np.ndarray, controls: tuple[int, int, int]) -> list[str]:
    """Role and text of a turn as they are rendered, control strings escaped."""
    start, sep, end = controls
    middle = int(np.flatnonzero(ids == sep)[0])
    if ids[0] != start or ids[-1] != end:
        raise ValueError("not a turn")
    return [bpe.decode(p.tobytes()) for p in (ids[1:middle], ids[middle + 1 : -1])]


def _digest_task(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        controls, extra = reserved(bpe), sum(map(len, CONTROL))
        done: list[tuple] = []
        last, state = object(), None

        def close() -> None:
            if state is not None:
                turns, loss, n, under, chars = state
                done.append((last, n, turns.hexdigest(), under, loss.hexdigest(), chars))

        for batch in batches:
            for conv, packed, mask in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if conv != last or state is None:
                    close()
                    last, state = conv, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                ids = np.frombuffer(packed, "<u4")
                shown = _shown(bpe, ids, controls)
                role, text = map(unescape, shown)
                state[0].update(f"{role}\n{text}\n".encode())
                under = unescape(bpe.decode(ids[np.frombuffer(mask, np.uint8) == 1].tobytes()))
                state[1].update(under.encode())
                state[2] += 1
                state[3] += len(under)
                state[4] += sum(map(len, shown)) + extra
            if len(done) >= 4096:
                yield _digests(done)
                done.clear()
        close()
        if done:
            yield _digests(done)

    return run


_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in _DIGEST.split(", ")]
    )


def read_back(formatted: DataFrame, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Digests per conversation of what the tokens and the mask of its turns hold.

    All numbers, that of rendered characters too, come from the decoded tokens.
    """
    laid = (
        formatted.select("conv_id", "position", "ids", "mask")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "position")
    )
    return map_arrow(laid, _digest_task(path), _DIGEST)
