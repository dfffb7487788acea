"""Token counts from an exact histogram of encoded lengths.

Documents are aggregated by their number of ids. Sums over the histogram from its long end answer, for every context
limit, how many documents and ids are longer, what truncation at the limit keeps, and every quantile. No document is
looked at again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from advertlake.llm.encode import ENCODE_BYTES, default_tokenizer_path, encoder
from advertlake.llm.kernels import text_blocks


def encoded_lengths(documents: DataFrame, *, tokenizer: str | None = None) -> DataFrame:
    """``n_tokens`` of every row's whole text; a null or empty text has none. Other columns are not read."""
    file = tokenizer or default_tokenizer_path()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file)
        for batch in batches:
            texts = batch.column("text")
            counts = np.zeros(batch.num_rows, np.int64)
            for cut in text_blocks(texts, ENCODE_BYTES):
                rows = slice(cut.first, cut.first + cut.rows)
                counts[rows] = encode.encode(texts[rows].fill_null("").to_pylist())[1]
            # the task's own histogram, so the shuffle gets a row per length and not per document
            values, n = np.unique(counts, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], names=["n_tokens", "n_docs"])

    return documents.select("text").mapInArrow(lengths, "n_tokens bigint, n_docs bigint")


def length_histogram(documents: DataFrame, *, tokenizer: str | None = None) -> DataFrame:
    """One row per distinct length, with sums from the long end.

    ``n_docs`` documents have ``n_tokens`` ids; ``docs_from`` and ``tokens_from`` count documents of at least this
    length and their ids; ``docs_upto`` documents of at most this length; ``truncated_total`` is what is left of all
    documents when each is cut to this length. An empty table gives no rows; repeated rows count each.
    """
    counted = encoded_lengths(documents, tokenizer=tokenizer).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    # as many rows as there are distinct lengths, which the longest text bounds
    down = Window.orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    size = F.col("n_tokens") * F.col("n_docs")
    return counted.select(
        "n_tokens",
        "n_docs",
        F.sum("n_docs").over(down).alias("docs_from"),
        F.sum(size).over(down).alias("tokens_from"),
        F.sum("n_docs").over(up).alias("docs_upto"),
        (F.sum(size).over(up) + F.col("n_tokens") * (F.sum("n_docs").over(down) - F.col("n_docs"))).alias("truncated_total"),
    )


def totals_at(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """For stated context limits: documents and ids in all, documents cut, ids kept."""
    asked = histogram.sparkSession.createDataFrame([(int(x),) for x in limits], "context bigint")
    longer = F.col("n_tokens") > F.col("context")
    kept = F.least("n_tokens", "context") * F.col("n_docs")
    return (
        asked.join(F.broadcast(histogram), F.lit(True), "left")  # a few stated limits beside one row per length
        .groupBy("context")
        .agg(
            F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
            F.coalesce(F.sum(F.col("n_tokens") * F.col("n_docs")), F.lit(0)).alias("total_tokens"),
            F.coalesce(F.sum(F.when(longer, F.col("n_docs"))), F.lit(0)).alias("docs_cut"),
            F.coalesce(F.sum(kept), F.lit(0)).alias("tokens_kept"),
        )
    )


def quantiles(histogram: DataFrame, shares: Sequence[float]) -> dict[float, int | None]:
    """The smallest length that at least each share of the documents does not exceed; None for an empty table."""
    out: dict[float, int | None] = {}
    total = histogram.agg(F.max("docs_upto")).first()[0]
    for share in shares:
        out[share] = (
            None
            if total is None
            else histogram.filter(F.col("docs_upto") >= F.lit(share) * F.lit(total)).agg(F.min("n_tokens")).first()[0]
        )
    return out
