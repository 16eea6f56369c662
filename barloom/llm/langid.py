"""Language identification by a bidirectional gated recurrent network over bytes.

Trained with numpy by backpropagation through time on a bounded sample; every byte of a
text is labelled, and a document's probabilities are the mean over its bytes. Long texts
are read in stretches of ``STRETCH`` bytes, all of them, so that cost and memory are the
same per byte for any length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import map_arrow, materialize, named, slices

#: Labelled rows of each language that are trained on at most, and characters of each.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 512
#: Rows that are trained on at most, divided evenly among the languages; one each is sure.
TOTAL_ROWS = 25_600
#: Rows of a language that are hashed into the draw, as a multiple of those trained on.
SPARE = 4
#: Languages that ``STEPS`` steps learn; more languages take as many times more steps.
LANGUAGES = 64
STRETCH = 64
HIDDEN = 8
STEPS = 300
BATCH = 128
SEED = 20240607
UNDETERMINED = "und"
#: Byte classes are the bytes themselves; one more stands for padding.
_PAD = 256
_LETTER = regex.compile(r"\p{L}")
_LANES = 2048
#: Labels up to which a batch is whole; of more, batches are smaller and memory the same.
_WIDE = 1024


@dataclass
class Model:
    """Weights; the gates' columns are reset, update, candidate."""

    labels: list[str]
    weights: dict[str, np.ndarray]


def _gate(x: np.ndarray) -> np.ndarray:
    """The piecewise linear logistic function."""
    return np.clip(0.25 * x + 0.5, 0, 1)


def _initial(labels: int, hidden: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    w = {"bias": np.zeros(labels, np.float32)}
    for d in "fb":
        w[f"in_{d}"] = rng.normal(0, 0.3, (257, 3 * hidden)).astype(np.float32)
        w[f"re_{d}"] = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32)
        w[f"rb_{d}"] = np.zeros(hidden, np.float32)
        w[f"out_{d}"] = rng.normal(0, hidden**-0.5, (hidden, labels)).astype(np.float32)
    return w


def _run(w: dict[str, np.ndarray], d: str, codes: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states (time, lane, hidden) of one direction, and what training needs."""
    gates, recur, bias = w[f"in_{d}"], w[f"re_{d}"], w[f"rb_{d}"]
    hidden = recur.shape[0]
    h = np.zeros((codes.shape[1], hidden), np.float32)
    states = np.empty((len(codes), codes.shape[1], hidden), np.float32)
    kept = []
    for t in range(len(codes)):
        x, u = gates[codes[t]], h @ recur
        rz = _gate(x[:, : 2 * hidden] + u[:, : 2 * hidden])
        r, z = rz[:, :hidden], rz[:, hidden:]
        part = u[:, 2 * hidden :] + bias
        n = np.tanh(x[:, 2 * hidden :] + r * part)
        kept.append((h, r, z, n, part))
        h = n + z * (h - n)
        states[t] = h
    return states, kept


def _back(
    w: dict[str, np.ndarray], d: str, codes: np.ndarray, kept: list, upper: np.ndarray, g: dict
) -> None:
    """Gradients of one direction through time; ``upper`` is the loss's by state."""
    recur = w[f"re_{d}"]
    hidden = recur.shape[0]
    carry = np.zeros_like(upper[0])
    by_time = np.empty((*codes.shape, 3 * hidden), np.float32)
    for t in range(len(codes) - 1, -1, -1):
        h, r, z, n, part = kept[t]
        dh = upper[t] + carry
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * (0.25 * ((z > 0) & (z < 1)))
        dr = dn * part * (0.25 * ((r > 0) & (r < 1)))
        inner = np.concatenate((dr, dz, dn * r), axis=1)
        by_time[t] = np.concatenate((dr, dz, dn), axis=1)
        g[f"re_{d}"] += h.T @ inner
        g[f"rb_{d}"] += inner[:, 2 * hidden :].sum(axis=0)
        carry = dh * z + inner @ recur.T
    order = np.argsort(codes, axis=None, kind="stable")
    values, at = np.unique(codes.reshape(-1)[order], return_index=True)
    g[f"in_{d}"][values] += np.add.reduceat(by_time.reshape(-1, 3 * hidden)[order], at, axis=0)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: Sequence[str], labels: Sequence[str], hidden: int = HIDDEN, steps: int = STEPS) -> Model:
    """Fit on stretches drawn evenly over the labels; runs with equal input agree."""
    names = sorted(set(labels))
    if len(names) < 2:
        return Model(names, {})
    rng = np.random.default_rng(SEED)
    pools = []
    for name in names:
        rows = [_stretches(t.encode())[0] for t, l in zip(texts, labels) if l == name and t]
        pools.append(np.concatenate(rows) if rows else np.full((1, STRETCH), _PAD))
    w = _initial(len(names), hidden, rng)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    batch = max(1, BATCH * _WIDE // max(_WIDE, len(names)))
    steps = steps * BATCH // batch * -(-len(names) // LANGUAGES)
    for step in range(1, steps + 1):
        picked = rng.integers(0, len(names), batch)
        codes = np.stack([pools[k][rng.integers(len(pools[k]))] for k in picked]).T
        forward, kept_f = _run(w, "f", codes)
        backward, kept_b = _run(w, "b", codes[::-1])
        scores = _softmax(forward @ w["out_f"] + backward[::-1] @ w["out_b"] + w["bias"])
        error = scores.copy()
        error[:, np.arange(batch), picked] -= 1
        error *= ((codes != _PAD) / max(1, (codes != _PAD).sum()))[:, :, None].astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["bias"] += error.sum(axis=(0, 1))
        g["out_f"] += np.einsum("tbh,tbl->hl", forward, error, optimize=True)
        g["out_b"] += np.einsum("tbh,tbl->hl", backward[::-1], error, optimize=True)
        _back(w, "f", codes, kept_f, error @ w["out_f"].T, g)
        _back(w, "b", codes[::-1], kept_b, (error @ w["out_b"].T)[::-1], g)
        rate = 0.02 * min(1.0, 2 - 2 * step / (steps + 1))
        for k in w:
            np.clip(g[k], -1, 1, out=g[k])
            first[k] += 0.1 * (g[k] - first[k])
            second[k] += 0.01 * (g[k] ** 2 - second[k])
            w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    return Model(names, w)


def _stretches(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes in rows of ``STRETCH``, the last one padded, and the true lengths."""
    n = max(1, -(-len(data) // STRETCH))
    codes = np.full(n * STRETCH, _PAD, np.int64)
    codes[: len(data)] = np.frombuffer(data, np.uint8)
    lengths = np.full(n, STRETCH)
    lengths[-1] = len(data) - (n - 1) * STRETCH
    return codes.reshape(n, STRETCH), lengths


class Labeller:
    """Position probabilities of many stretches at once, one byte a step.

    Arrays stand feature by lane, so that every gate is one contiguous block. The slope
    and offset of the reset and update gates are part of the weights.
    """

    def __init__(self, model: Model):
        w = model.weights
        self.hidden = hidden = w["re_f"].shape[0]
        slope = np.concatenate((np.full(2 * hidden, 0.25), np.ones(hidden))).astype(np.float32)
        offset = np.concatenate((np.full(2 * hidden, 0.5), np.zeros(hidden))).astype(np.float32)
        self.bias = w["bias"][:, None]
        self.ways = [
            tuple(
                np.ascontiguousarray(m)
                for m in ((w[f"in_{d}"] * slope + offset).T, (w[f"re_{d}"] * slope).T, w[f"rb_{d}"][:, None], w[f"out_{d}"].T)
            )
            for d in "fb"
        ]

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        """Sum of the position probabilities of each column of ``codes`` (time, lane)."""
        steps, lanes = codes.shape
        two = 2 * self.hidden
        logits = np.empty((steps, len(self.bias), lanes), np.float32)
        for way, (gates, recur, bias, out) in enumerate(self.ways):
            h = np.zeros((self.hidden, lanes), np.float32)
            x = np.empty((3 * self.hidden, lanes), np.float32)
            u = np.empty_like(x)
            part = np.empty((len(self.bias), lanes), np.float32)
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                np.take(gates, codes[t], axis=1, out=x, mode="clip")
                np.matmul(recur, h, out=u)
                rz, n = x[:two], u[two:]
                rz += u[:two]
                np.maximum(rz, 0, out=rz)
                np.minimum(rz, 1, out=rz)
                n += bias
                n *= rz[: self.hidden]
                n += x[two:]
                np.tanh(n, out=n)
                h -= n
                h *= rz[self.hidden :]
                h += n
                if way == 0:
                    np.matmul(out, h, out=logits[t])
                else:
                    logits[t] += np.matmul(out, h, out=part)
        total = np.zeros((len(self.bias), lanes), np.float32)
        for t in range(steps):
            score = logits[t]
            score += self.bias
            score -= score.max(axis=0)
            np.exp(score, out=score)
            score *= (codes[t] != _PAD) / score.sum(axis=0)
            total += score
        return total.T


def predict(model: Model, texts: Sequence[str | None]) -> list[tuple[str, float]]:
    """(label, probability) of each text; ``und`` and 0 without a letter or a model."""
    out = [(UNDETERMINED, 0.0)] * len(texts)
    wanted = [k for k, t in enumerate(texts) if t and _LETTER.search(t)]
    if not wanted or not model.labels:
        return out
    if len(model.labels) == 1:
        for k in wanted:
            out[k] = (model.labels[0], 1.0)
        return out
    labeller = Labeller(model)
    cut = [_stretches(texts[k].encode()) for k in wanted]
    codes = np.concatenate([c for c, _ in cut])
    lengths = np.concatenate([n for _, n in cut])
    owner = np.repeat(np.arange(len(wanted)), [len(c) for c, _ in cut])
    total = np.zeros((len(wanted), len(model.labels)))
    lanes = max(1, _LANES * LANGUAGES // max(LANGUAGES, len(model.labels)))
    for at in range(0, len(codes), lanes):
        np.add.at(total, owner[at : at + lanes], labeller(np.ascontiguousarray(codes[at : at + lanes].T)).astype(np.float64))
    total /= np.bincount(owner, lengths)[:, None]
    best = total.argmax(axis=1)
    for k, b, row in zip(wanted, best.tolist(), total):
        out[k] = (model.labels[b], float(min(1.0, max(0.0, row[b]))))
    return out


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept out of training; a null id is."""
    return F.coalesce(F.crc32(named(id_col).cast("string")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Train on a bounded sample of labelled rows that are not held out.

    Every language is learned. Per language the ``SAMPLE_ROWS`` rows that come first by a
    hash of their id, or an even part of ``TOTAL_ROWS`` if that is less, and of each
    ``SAMPLE_CHARS`` characters from a place that the hash chooses. Languages are counted
    first, so that about ``SPARE`` times as many rows are all that is shuffled.
    """
    rows = docs.where(~held_out(id_col) & named(lang_col).isNotNull() & (F.length(named(text_col)) > 0)).select(
        named(lang_col).cast("string").alias("lang"),
        F.xxhash64(named(id_col)).alias("h"),
        named(text_col).cast("string").alias("text"),
    )
    counts = materialize(rows.groupBy("lang").agg(F.count("*").alias("of")), "languages")
    found = counts.count()
    if not found:
        return train([], [])
    each = max(1, min(SAMPLE_ROWS, TOTAL_ROWS // found))
    # At least 64 rows are expected in a draw, so that none comes out empty.
    share = F.lit(float(SPARE * max(each, 16))) / F.col("of")
    rows = rows.join(counts, "lang").where(F.pmod("h", F.lit(1 << 20)) / F.lit(1 << 20) < share)
    first = Window.partitionBy("lang").orderBy("h")
    room = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    chosen = (
        rows.withColumn("at", F.pmod(F.col("h"), room).cast("int") + 1)
        .select("lang", "h", F.col("text").substr(F.col("at"), F.lit(SAMPLE_CHARS)).alias("text"))
        .withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= each)
        .select("lang", "text", "h")
        .collect()
    )
    chosen = sorted((r["lang"], r["h"], r["text"]) for r in chosen)
    return train([r[2] for r in chosen], [r[0] for r in chosen])


def _predict_task(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = predict(model, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found]), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score``, a row per document.

    Only the text is read for a prediction. Null texts and texts without a letter are
    ``und`` with score 0. Nothing is shuffled; the weights are a few thousand numbers.
    """
    rows = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text"))
    found = map_arrow(rows, _predict_task(model), "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.0) -> DataFrame:
    """``docs`` without those whose text is ``und`` or scores below ``least``; columns stay.

    With a model that learned no language, every text that has a letter stays.
    """
    column = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            texts = batch.column(column).to_pylist()
            if model.labels:
                keep = [f[0] != UNDETERMINED and f[1] >= least for f in predict(model, texts)]
            else:
                keep = [bool(t and _LETTER.search(t)) for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_arrow(docs, run, docs.schema)
