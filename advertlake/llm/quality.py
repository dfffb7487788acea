"""Quality rules: counts over whole texts and a calibrated hashed n-gram regression against fixed thresholds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from advertlake.llm.kernels import (
    CONTINUED,
    LOWER_VALUES,
    PLACES,
    U64,
    Block,
    Words,
    mix,
    prefix_hash,
    shingle_hashes,
    span_hash,
    text_blocks,
    words_of,
)
from advertlake.llm.samples import labelled_sample

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WINDOW = 5

# Bounds of the sample the regression is fitted to, and the fixed threshold on its calibrated probability. The threshold
# is low: only texts that the model is sure of go, as a lost good document costs more than a kept bad one.
TRAIN_ROWS = 2000
TRAIN_CHARS = 20_000
KEEP_FROM = 0.05

FOLDS = 4  # of the labelled texts, each left out of one fit
BITS = 18  # of the hashed n-grams' buckets
SCALE = 20.0  # what a text's n-gram shares are multiplied by

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def repeated_rows(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Flags of entries whose (row, hash) occurs twice or more; rows ascend."""
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    same = np.zeros(len(r) + 1, bool)
    same[1:-1] = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
    out = np.empty(len(r), bool)
    out[order] = same[:-1] | same[1:]
    return out


def base_counts(block: Block, words: Words) -> dict[str, np.ndarray]:
    """Per row: words, their code points, symbols, repeated lines, and words in windows found twice or more."""
    prefix = prefix_hash(block.data)
    letters = np.concatenate(([0], np.cumsum(~CONTINUED[block.data], dtype=np.int64)))
    chars = np.bincount(words.row, letters[words.ends] - letters[words.starts], block.rows).astype(np.int64)

    # lines end at a newline or with the text; only those with a word count
    newline = np.flatnonzero(block.data == 10)
    line_ends = np.sort(np.concatenate((newline, block.offsets[1:])))
    line_starts = np.sort(np.concatenate((newline + 1, block.offsets[:-1])))
    worded = np.searchsorted(words.starts, line_ends) > np.searchsorted(words.starts, line_starts)
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    row = block.row_of(line_starts)
    order = np.lexsort((span_hash(prefix, line_starts, line_ends), row))
    h, r = span_hash(prefix, line_starts, line_ends)[order], row[order]
    again = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
    dup_lines = np.bincount(r[1:][again], minlength=block.rows)

    full = words.per_row >= WINDOW
    hashes, rows = shingle_hashes(span_hash(prefix, words.starts, words.ends), words, WINDOW)
    hashes, rows = hashes[full[rows]], rows[full[rows]]
    twice = repeated_rows(rows, hashes)
    first_word = np.concatenate(([0], np.cumsum(words.per_row)))[:-1]
    first_window = np.concatenate(([0], np.cumsum(np.maximum(words.per_row - WINDOW + 1, 0))))[:-1]
    at = (np.arange(len(rows)) - first_window[rows] + first_word[rows])[twice]
    cover = np.zeros(len(words.starts) + 1, np.int32)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    return {
        "n_words": words.per_row.astype(np.int64),
        "word_chars": chars,
        "n_symbols": block.per_row(_IS_SYMBOL[block.data]),
        "n_dup_lines": dup_lines.astype(np.int64),
        "n_repeat_words": np.bincount(words.row[covered], minlength=block.rows).astype(np.int64),
    }


def hashed_grams(block: Block, words: Words) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Buckets and rows of single words and pairs (case folded), and of runs of four bytes."""
    shift = U64(64 - BITS)
    w = span_hash(prefix_hash(block.data, LOWER_VALUES), words.starts, words.ends)
    together = words.row[1:] == words.row[:-1]
    pairs = mix(w[:-1] * PLACES[0] + w[1:] * PLACES[1])[together]
    word = (np.concatenate((w, pairs)) >> shift).astype(np.int32), np.concatenate((words.row, words.row[1:][together]))
    if len(block.data) < 4:
        return word, (np.zeros(0, np.int32), np.zeros(0, np.int64))
    d = block.data.astype(np.uint32)
    runs = d[:-3] | d[1:-2] << np.uint32(8) | d[2:-1] << np.uint32(16) | d[3:] << np.uint32(24)
    per_row = np.diff(block.offsets)
    row = np.repeat(np.arange(block.rows), per_row)
    inside = row[:-3] == row[3:]
    char = (mix(runs[inside].astype(np.uint64) + U64(7)) >> shift).astype(np.int32), row[:-3][inside]
    return word, char


@dataclass(frozen=True)
class HashedRegression:
    """Logistic regression over the shares of hashed n-grams, with a calibration of its logits."""

    word: np.ndarray
    char: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    @staticmethod
    def _mean(weights: np.ndarray, grams: tuple[np.ndarray, np.ndarray], rows: int) -> np.ndarray:
        n = np.maximum(np.bincount(grams[1], minlength=rows), 1)
        return np.bincount(grams[1], weights[grams[0]], rows) / n

    def logits(self, block: Block, words: Words) -> np.ndarray:
        word, char = hashed_grams(block, words)
        return self.bias + SCALE * (self._mean(self.word, word, block.rows) + self._mean(self.char, char, block.rows))

    def probabilities(self, block: Block, words: Words) -> np.ndarray:
        z = self.slope * self.logits(block, words) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def folds(labels: np.ndarray) -> np.ndarray:
    """The fold of every row: the rows of each label are dealt out in turn, so that the folds have as many of each."""
    out = np.empty(len(labels), np.int64)
    for label in (0, 1):
        own = np.flatnonzero(labels == label)
        out[own] = np.arange(len(own)) % FOLDS
    return out


def fit_regression(texts: Sequence[str], labels: Sequence[int], *, steps: int = 12, rate: float = 0.05) -> HashedRegression:
    """The mean of models that each leave out a fold, calibrated on the logits that every text got while it was left out.

    So all rows of the rarer label are held back once, and the calibration can be as sure as their number allows.
    Without both labels every text scores 1.
    """
    y = np.asarray(labels, float)
    if len(set(labels)) < 2:
        zero = np.zeros(1 << BITS, np.float32)
        return HashedRegression(zero, zero, 20.0)
    n = len(y)
    parts = []
    for block in text_blocks(pa.array(texts, pa.string())):
        grams = hashed_grams(block, words_of(block))
        parts.append([(g, (r + block.first).astype(np.int32)) for g, r in grams])
    families = [tuple(np.concatenate(x) for x in zip(*[p[k] for p in parts])) for k in range(2)]
    totals = [np.maximum(np.bincount(r, minlength=n), 1) for _, r in families]
    fold = folds(y)
    mean, mean_bias, left_out = [np.zeros(1 << BITS) for _ in families], 0.0, np.zeros(n)
    for k in range(FOLDS):
        weights, bias, logits = _descend(families, totals, y, fold != k, steps, rate)
        left_out[fold == k] = logits[fold == k]
        mean = [m + w / FOLDS for m, w in zip(mean, weights)]
        mean_bias += bias / FOLDS
    slope, shift = calibration(left_out, y)
    return HashedRegression(mean[0].astype(np.float32), mean[1].astype(np.float32), mean_bias, slope, shift)


def _descend(
    families: list[tuple[np.ndarray, np.ndarray]], totals: list[np.ndarray], y: np.ndarray, learned: np.ndarray, steps: int, rate: float
) -> tuple[list[np.ndarray], float, np.ndarray]:
    """Weights, bias and the logits of all rows, fitted to the ``learned`` rows."""
    n = len(y)
    share = learned / max(learned.sum(), 1)
    weights = [np.zeros(1 << BITS) for _ in families]
    first, second = [0.0, 0.0], [0.0, 0.0]
    bias = 0.0

    def logits() -> np.ndarray:
        return bias + SCALE * sum(np.bincount(r, w[g], n) / t for (g, r), w, t in zip(families, weights, totals))

    for step in range(1, steps + 1):
        error = (1 / (1 + np.exp(-logits())) - y) * share
        for k, ((g, r), t) in enumerate(zip(families, totals)):
            slope = np.bincount(g, (error / t * SCALE)[r], 1 << BITS)
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.99 * second[k] + 0.01 * slope * slope
            weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        bias -= error.sum()
    return weights, bias, logits()


def calibration(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that fit probabilities to labels held back, with targets drawn in a little from 0 and 1."""
    ones = labels.sum()
    zeros = len(labels) - ones
    if not ones or not zeros:
        return 1.0, 0.0
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    def loss(x: np.ndarray) -> float:
        z = x[0] * logits + x[1]
        return float((np.logaddexp(0, z) - target * z).sum() + 0.05 * (x[0] - 1) ** 2)

    at = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(at[0] * logits + at[1], -500, 500)))
        w = p * (1 - p) + 1e-9
        gradient = np.array([((p - target) * logits).sum() + 0.1 * (at[0] - 1), (p - target).sum()])
        curve = np.array([[(w * logits * logits).sum() + 0.1, (w * logits).sum()], [(w * logits).sum(), w.sum()]])
        step = np.linalg.solve(curve, gradient)
        while loss(at - step) > loss(at) and abs(step).max() > 1e-9:
            step = step / 2
        at = at - step
    a, b = at
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


VERDICT = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
    "base_failed:boolean,probability:double,kept:boolean>"
)


def verdict(text: Column, model: HashedRegression, keep_from: float = KEEP_FROM) -> Column:
    """Counts, the base rules' verdict, the calibrated probability and the final verdict of a text.

    A null or empty text has no words and fails. The calculation is marked as one not to repeat, so that a filter on
    it does not scan texts twice.
    """

    @arrow_udf(VERDICT)
    def judge(texts: pa.Array) -> pa.Array:
        found: dict[str, list[np.ndarray]] = {}
        for block in text_blocks(texts):
            words = words_of(block)
            for name, values in {**base_counts(block, words), "probability": model.probabilities(block, words)}.items():
                found.setdefault(name, []).append(values)
        out = {name: np.concatenate(v) for name, v in found.items()} or {n: np.zeros(0) for n in _COUNTED}
        failed = (out["n_words"] < LEAST_WORDS) | (100 * out["n_repeat_words"] > MOST_REPEATED_PERCENT * out["n_words"])
        columns = [pa.array(out[n], pa.int64()) for n in _COUNTED[:-1]]
        kept = ~failed & (out["probability"] >= keep_from)
        columns += [pa.array(failed), pa.array(out["probability"], pa.float64()), pa.array(kept)]
        return pa.StructArray.from_arrays(columns, [*_COUNTED[:-1], "base_failed", "probability", "kept"])

    return judge.asNondeterministic()(text)


_COUNTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "probability")


def fit_quality(documents: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS, max_chars: int = TRAIN_CHARS) -> HashedRegression:
    """The regression fitted to ``labels.quality`` on at most ``rows`` whole texts of at most ``max_chars`` each."""
    return fit_regression(*labelled_sample(documents, labels, "quality", rows=rows, max_chars=max_chars))


def judge_quality(documents: DataFrame, model: HashedRegression, keep_from: float = KEEP_FROM) -> DataFrame:
    """Counts and verdicts per row of ``documents``; repeated rows are judged each, an empty table gives no rows."""
    judged = documents.select("doc_id", verdict(F.col("text"), model, keep_from).alias("_v"))
    names = [*_COUNTED[:-1], "base_failed", "kept", "probability"]
    return judged.select("doc_id", *[F.col(f"_v.{n}").alias(n) for n in names])


def keep_good(documents: DataFrame, model: HashedRegression, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``documents`` that the rules keep, with their own columns."""
    judged = documents.select(F.struct("*").alias("row"), verdict(F.col("text"), model, keep_from).alias("verdict"))
    return judged.filter("verdict.kept").select("row.*")
