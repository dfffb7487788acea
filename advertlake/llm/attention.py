"""Quality classifier with attention over passages, learned from labels of whole documents.

A document is a bag of passages of consecutive words. Every passage is encoded: signs of its words' hashes summed up,
and shares that describe its style. A gated attention weighs the passages, and the weighted passage representation is
scored. Weights are learned from the label of the bag alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from advertlake.llm.kernels import LOWER_VALUES, Block, prefix_hash, span_hash, text_blocks, words_of
from advertlake.llm.samples import labelled_sample

PASSAGE_WORDS = 64
SIGNS = 32  # hashed dimensions
HIDDEN = 16
GATE = 8

# Bounds of the sample the model is fitted to.
TRAIN_ROWS = 2000
TRAIN_CHARS = 20_000

_STYLE = np.zeros((6, 256), bool)
_STYLE[0, 65:91] = True  # capitals
_STYLE[1, 48:58] = True  # digits
_STYLE[2, [ord(c) for c in "#*$%&|<>@{}[]\\^~_="]] = True
_STYLE[3, [ord(c) for c in ".,;:!?\"'()-"]] = True
_STYLE[4, 10] = True
_STYLE[5, 128:] = True
FEATURES = SIGNS + len(_STYLE) + 6


def encode_passages(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a block, and the row of each; a text without words has one passage of zeros."""
    words = words_of(block)
    per_row = np.maximum(-(-words.per_row // PASSAGE_WORDS), 1)
    row = np.repeat(np.arange(block.rows), per_row)
    first_word = np.concatenate(([0], np.cumsum(words.per_row)))
    first_passage = np.concatenate(([0], np.cumsum(per_row)))[:-1]
    begin = first_word[row] + (np.arange(len(row)) - first_passage[row]) * PASSAGE_WORDS
    end = np.minimum(begin + PASSAGE_WORDS, first_word[row + 1])
    size = end - begin
    out = np.zeros((len(row), FEATURES), np.float32)
    full = size > 0
    if not full.any():
        return out, row
    b, e, n = begin[full], end[full], size[full].astype(np.float32)
    hashes = span_hash(prefix_hash(block.data, LOWER_VALUES), words.starts, words.ends)

    def sums(values: np.ndarray) -> np.ndarray:
        """Sums over the words of each passage; passages follow each other without gaps."""
        return np.add.reduceat(values, b, axis=0, dtype=np.float32)

    signs = np.unpackbits((hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.uint8).reshape(-1, 4), axis=1)
    out[full, :SIGNS] = (2 * sums(signs) - n[:, None]) / np.sqrt(n)[:, None]
    low, high = words.starts[b], words.ends[e - 1]
    length = (high - low).astype(np.float32)
    for k, kind in enumerate(_STYLE):
        total = np.concatenate(([0], np.cumsum(kind[block.data], dtype=np.int64)))
        out[full, SIGNS + k] = 4 * (total[high] - total[low]) / length
    at = SIGNS + len(_STYLE)
    for k, lag in enumerate((1, 2, 3, 4)):
        same = np.zeros(len(hashes), np.uint8)
        same[lag:] = (hashes[lag:] == hashes[:-lag]) & (words.row[lag:] == words.row[:-lag])
        out[full, at + k] = 2 * sums(same) / n
    out[full, at + 4] = (high - low) / n / 8
    out[full, at + 5] = n / PASSAGE_WORDS
    return out, row


@dataclass(frozen=True)
class GatedAttention:
    """Weights of the passage layer, the attention's two branches and the score."""

    passage: np.ndarray  # FEATURES + 1 x HIDDEN
    content: np.ndarray  # HIDDEN x GATE
    gate: np.ndarray  # HIDDEN x GATE
    attend: np.ndarray  # GATE
    score: np.ndarray  # HIDDEN + 1

    def forward(self, x: np.ndarray, row: np.ndarray) -> dict[str, np.ndarray]:
        """All passages at once; rows ascend and every row has a passage."""
        begin = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        h = np.tanh(x @ self.passage[:-1] + self.passage[-1])
        t, s = np.tanh(h @ self.content), 1 / (1 + np.exp(-np.clip(h @ self.gate, -60, 60)))
        e = (t * s) @ self.attend
        e = np.exp(np.clip(e - np.maximum.reduceat(e, begin)[row], -60, 0))
        a = e / np.add.reduceat(e, begin)[row]
        z = np.add.reduceat(a[:, None] * h, begin, axis=0)
        logit = z @ self.score[:-1] + self.score[-1]
        return {"begin": begin, "h": h, "t": t, "s": s, "a": a, "z": z, "p": 1 / (1 + np.exp(-np.clip(logit, -60, 60)))}

    def backward(self, x: np.ndarray, row: np.ndarray, f: dict[str, np.ndarray], error: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weights for errors of the documents' logits."""
        score = np.append(f["z"].T @ error, error.sum())
        dz = error[:, None] * self.score[:-1]
        da = (dz[row] * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["begin"])[row])
        dt, ds = de[:, None] * self.attend * f["s"], de[:, None] * self.attend * f["t"]
        dt *= 1 - f["t"] ** 2
        ds *= f["s"] * (1 - f["s"])
        dh = f["a"][:, None] * dz[row] + dt @ self.content.T + ds @ self.gate.T
        dx = dh * (1 - f["h"] ** 2)
        passage = np.vstack((x.T @ dx, dx.sum(axis=0)))
        return [passage, f["h"].T @ dt, f["h"].T @ ds, (f["t"] * f["s"]).T @ de, score]

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.passage, self.content, self.gate, self.attend, self.score]


def fit_attention(
    texts: Sequence[str], labels: Sequence[int], *, steps: int = 150, rate: float = 0.02, decay: float = 1e-3, seed: int = 7
) -> GatedAttention:
    """Gradient steps over all bags. Both labels weigh the same; without both of them every score is a half."""
    rng = np.random.default_rng(seed)
    weights = [
        rng.normal(0, FEATURES**-0.5, (FEATURES + 1, HIDDEN)),
        rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        rng.normal(0, GATE**-0.5, GATE),
        np.zeros(HIDDEN + 1),
    ]
    y = np.asarray(labels, float)
    if len(set(labels)) < 2:
        return GatedAttention(*weights)
    parts, first = [], 0
    for block in text_blocks(pa.array(texts, pa.string())):
        x, row = encode_passages(block)
        parts.append((x.astype(np.float64), row + first))
        first += block.rows
    x, row = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    balance = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    one, two = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        model = GatedAttention(*weights)
        f = model.forward(x, row)
        for k, g in enumerate(model.backward(x, row, f, (f["p"] - y) * balance)):
            g = g + decay * weights[k]
            one[k] = 0.9 * one[k] + 0.1 * g
            two[k] = 0.999 * two[k] + 0.001 * g * g
            weights[k] = weights[k] - rate * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.999**step)) + 1e-8)
    return GatedAttention(*[w.astype(np.float32) for w in weights])


def score_texts(text: Column, model: GatedAttention) -> Column:
    """Probability of label 1 for every whole text; a null text scores as an empty one."""

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for block in text_blocks(texts):
            x, row = encode_passages(block)
            out.append(model.forward(x, row)["p"].astype(np.float64))
        return pa.array(np.concatenate(out), pa.float64())

    return score.asNondeterministic()(text)


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether an id belongs to the fold whose labels are never learned from; a null id does not."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def fit_passage_classifier(documents: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS, max_chars: int = TRAIN_CHARS) -> GatedAttention:
    """Fit to ``labels.quality`` of ids that are not held out, on at most ``rows`` texts of at most ``max_chars``."""
    allowed = ~held_out(F.col("doc_id"))
    return fit_attention(*labelled_sample(documents, labels, "quality", rows=rows, max_chars=max_chars, allowed=allowed))


def score_documents(documents: DataFrame, model: GatedAttention) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row; repeated rows score alike, an empty table gives no rows."""
    scored = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_texts(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
