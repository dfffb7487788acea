"""Bounded samples of labelled documents, for fitting models."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from advertlake.session import stage

FEW = 8  # labelled documents of one side


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    *,
    rows: int,
    max_chars: int,
    allowed: Column | None = None,
) -> tuple[list[str], list[int]]:
    """Whole texts and 0/1 labels of at most ``rows`` documents of at most ``max_chars`` characters.

    The documents with the smallest hashes of their ids are taken, so the choice is repeatable and independent of the
    order of rows. Labels are first matched with the ids of documents that fit, a narrow pass without texts but for their
    lengths, and then chosen among, so that labels of other documents take no place; only the chosen texts are moved.
    ``allowed`` is a condition on ``doc_id``. Ids whose labels contradict each other and null labels are left out. A side
    with fewer than ``FEW`` documents is warned of: a model of one side alone tells nothing apart.
    """
    given = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    if allowed is not None:
        given = given.filter(allowed)
    given = given.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_other")).filter("label = _other")
    fits = F.length("text") <= max_chars
    there = documents.filter(fits).select("doc_id")
    known = given.select("doc_id", "label").join(there, "doc_id", "left_semi")
    chosen = stage(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "labelled-ids")
    found = (
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most ``rows`` ids
        .filter(fits)
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
        .orderBy("doc_id")
        .collect()
    )
    for side in (0, 1):
        n = sum(r["label"] == side for r in found)
        if n < FEW:
            warnings.warn(f"{n} documents with label {side} of {label}: a model fitted to them is not to be relied on", stacklevel=2)
    return [r["text"] for r in found], [r["label"] for r in found]
