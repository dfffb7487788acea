"""Role class and skill flags for clean adverts, and term counts over their text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from advertlake.functions import text as X
from advertlake.functions.taxonomy import ROLE_CLASSIFIER_VERSION, SKILLS, Taxonomy
from advertlake.schema import FLAGS_SCHEMA, SNAPSHOT_KEY


def advert_text() -> Column:
    """``title. description`` with nulls as empty text."""
    return F.concat(
        F.coalesce(F.col("title"), F.lit("")), F.lit(". "), F.coalesce(F.col("description"), F.lit(""))
    )


def with_hits(df: DataFrame, text: Column, taxonomy: Taxonomy = SKILLS, output: str = "hits") -> DataFrame:
    """Add the array of matched terms. Row-local: the scan of the text needs no shuffle."""
    return df.withColumn(output, X.find_terms(X.normalize_text(text), taxonomy))


def add_role_class(df: DataFrame, **rules) -> DataFrame:
    return df.withColumn("role_class", X.role_class(F.col("category_tag"), F.col("title"), **rules))


def enrich_ads(
    clean: DataFrame,
    *,
    taxonomy: Taxonomy = SKILLS,
    classifier_version: str = ROLE_CLASSIFIER_VERSION,
    **role_rules,
) -> DataFrame:
    """The flags table: keys, text, role class, mention counters and both versions."""
    scanned = with_hits(add_role_class(clean, **role_rules), advert_text(), taxonomy)
    hits = F.col("hits")
    counters = [X.group_mentions(hits, g, taxonomy).alias(c) for g, c in taxonomy.columns.items()]
    carried = [c for c in FLAGS_SCHEMA.names if c in scanned.columns]
    return scanned.select(
        *carried,
        X.mentioned(hits).alias("ai_mentioned"),
        X.total_mentions(hits).alias("ai_total_mentions"),
        *counters,
        F.lit(taxonomy.version).alias("taxonomy_version"),
        F.lit(classifier_version).alias("role_classifier_version"),
    )


def exploded_hits(
    df: DataFrame, text: Column, taxonomy: Taxonomy = SKILLS, by: Sequence[str] = ()
) -> DataFrame:
    """One row per hit.

    For a plain explode the optimizer would filter on the size of the array first and so scan every
    text three times; the outer form is not rewritten, and its null rows are dropped afterwards.
    """
    scanned = with_hits(df, text, taxonomy)
    return scanned.select(*by, F.explode_outer("hits").alias("term")).filter("term is not null")


def term_counts(
    df: DataFrame, *, text: Column | None = None, taxonomy: Taxonomy = SKILLS, by: Sequence[str] = ()
) -> DataFrame:
    """Hits per term (and group columns ``by``). Exploded hits combine before the shuffle."""
    return (
        exploded_hits(df, advert_text() if text is None else text, taxonomy, by)
        .groupBy(*by, "term")
        .agg(F.count(F.lit(1)).alias("mentions"))
    )


def with_group(terms: DataFrame, taxonomy: Taxonomy = SKILLS) -> DataFrame:
    """Term to taxonomy group. The dictionary is a literal list, so its broadcast has a fixed size."""
    lookup = taxonomy.table(terms.sparkSession).select("term", F.col("group").alias("term_group"))
    return terms.join(F.broadcast(lookup), "term")


def join_flags(fact: DataFrame, flags: DataFrame, *, columns: Sequence[str], key: Sequence[str] = SNAPSHOT_KEY) -> DataFrame:
    """Snapshot facts with flag columns, matched on the snapshot key.

    Both sides hold a key once, so the join cannot multiply rows; adaptive execution picks the
    strategy from the real sizes.
    """
    return fact.join(flags.select(*key, *columns), list(key), "inner")
