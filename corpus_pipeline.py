"""From raw documents to token files: the stages of a training-data run, each over all rows its predecessor kept.

Every stage takes documents as they come: a null text counts as empty, ids may be null or repeat, every row is a document
of its own, and further columns of any name are carried to the last stage but one. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from advertlake.llm import decontaminate, mixing, ngram_join, quality, tokenfiles
from advertlake.llm.queries import prepared, table
from advertlake.session import remove, scratch_path, scratch_scope, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the regression keep; the labels are those of the labelled rows among them.

    Null, empty and short texts fail the base rules. Repeated rows share their verdict. Where the labels name one side
    alone, or no document, the regression keeps all that the base rules keep, with a warning.
    """
    return quality.keep_good(docs, quality.fit_quality(docs, table(prepared(spark), sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, that with the smallest id (a null id comes last); of repeated rows one.

    Documents without words are linked with nothing and all stay.
    """
    prepared(spark)
    return ngram_join.keep_representatives(docs)


def benchmark_overlaps(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts have none. Repeated rows share their verdict.

    Benchmark rows without an id count like others, those without words are never found.
    """
    return decontaminate.without_contaminated(docs, table(prepared(spark), sf_dir, "benchmark"), short_items=True)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the target weights. A null source, language or topic is a value like others.

    Documents without words have no tokens, so they weigh nothing. Which rows are drawn depends on ids alone, so repeated
    rows go together.
    """
    prepared(spark)
    return mixing.sample_to_targets(docs).select("row.*")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Files of token ids, and a row per document read back from them; a null or empty text has the end id alone.

    Documents are in ascending order of their ids, null first; rows of one id follow each other in any order.
    """
    path = scratch_path(prepared(spark), "pipeline-tokens")
    tokenfiles.write_token_files(docs, path)
    return tokenfiles.read_digests(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_overlaps),
    ("target_mix", target_mix),
    ("token_files", token_files),
]

# The first stage's model has no SQL form; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written, and the next one reads what was written.

    What a stage stages on its way goes when it is written, but for the last one's token files, and so does what its
    predecessor wrote.
    """
    docs, path = table(prepared(spark), sf_dir, "documents"), None
    for name, apply in STAGES[:-1]:
        before, path = path, scratch_path(spark, name)
        with scratch_scope(spark, f"{name}-work"):
            docs = stage(apply(spark, docs, sf_dir), name, path)
        if before is not None:
            remove(spark, before)
    name, apply = STAGES[-1]
    docs = stage(apply(spark, docs, sf_dir), name)
    remove(spark, path)
    return docs
