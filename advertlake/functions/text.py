"""Free-text normalisation and dictionary matching."""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from advertlake.functions.scalars import is_ascii, to_squeeze
from advertlake.functions.taxonomy import (
    ROLE_NON_TECHNICAL,
    ROLE_TECHNICAL,
    ROLE_UNKNOWN,
    SKILLS,
    TECHNICAL_TAGS,
    TECHNICAL_TITLE_WORDS,
    Taxonomy,
)

# A word character is any Unicode letter, digit or underscore. Accents split off by NFKD are marks,
# not word characters, so a term may end right before one.
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
NOT_AFTER_WORD = f"(?<!{WORD})"
NOT_BEFORE_WORD = f"(?!{WORD})"


@F.arrow_udf(T.StringType())
def _nfkd(text: pa.Array) -> pa.Array:
    return pc.utf8_normalize(text, form="NFKD")


def nfkd(text: Column) -> Column:
    """Unicode NFKD, the one step Spark has no built-in for.

    Pure ASCII text is its own normal form, so the Arrow batch carries a null for it and only the
    other texts travel to the Python worker.
    """
    return F.coalesce(_nfkd(F.when(~is_ascii(text), text)), text)


def normalize_text(text: Column) -> Column:
    """NFKD, markup and control characters to spaces, white space collapsed, lower case; null as ''."""
    given = F.coalesce(text, F.lit(""))
    out = F.regexp_replace(nfkd(given), "<[^>]+>", " ")
    out = F.replace(out, F.lit("&nbsp;"), F.lit(" "))
    # Control characters and white space in one pass. The class for ASCII text is a bit map.
    narrow = F.regexp_replace(out, to_squeeze(r"[\x00-\x20\x7f]"), " ")
    wide = F.regexp_replace(out, to_squeeze(r"[\x00-\x20\x7f\x85\p{Z}]"), " ")
    return F.lower(F.btrim(F.when(is_ascii(given), narrow).otherwise(wide)))


def term_pattern(taxonomy: Taxonomy = SKILLS) -> str:
    """One pattern over all terms, group 1: whole words, longer terms before their parts.

    The pattern consumes the character in front of a term (the text gets one blank in front), so most
    positions are rejected by a single class test, and a term that starts with no known letter by a
    second. Terms with the same first letter share a branch; within it the longest comes first.
    Terms end in word characters, so the consumed character never belongs to the hit before it.
    """
    by_letter: dict[str, list[str]] = {}
    for term in sorted(taxonomy.terms, key=len, reverse=True):
        by_letter.setdefault(term[0], []).append(re.escape(term[1:]))
    branches = "|".join(f"{re.escape(letter)}(?:{'|'.join(rest)})" for letter, rest in by_letter.items())
    letters = "".join(map(re.escape, by_letter))
    return f"{NOT_WORD}(?=[{letters}])({branches}){NOT_BEFORE_WORD}"


def find_terms(normalized: Column, taxonomy: Taxonomy = SKILLS) -> Column:
    """All non-overlapping hits in reading order, as an array of terms."""
    padded = F.concat(F.lit(" "), normalized)
    return F.regexp_extract_all(padded, F.lit(term_pattern(taxonomy)), F.lit(1))


def mentioned(hits: Column) -> Column:
    return F.size(hits) > 0


def total_mentions(hits: Column) -> Column:
    return F.size(hits).cast("long")


def group_mentions(hits: Column, group: str, taxonomy: Taxonomy = SKILLS) -> Column:
    terms = list(taxonomy.groups[group])
    return F.size(F.filter(hits, lambda hit: hit.isin(terms))).cast("long")


def term_mentions(hits: Column) -> Column:
    """Map of term to number of hits."""
    return F.map_from_entries(
        F.transform(
            F.array_distinct(hits),
            lambda term: F.struct(
                term.alias("key"),
                F.size(F.filter(hits, lambda hit: hit == term)).cast("long").alias("value"),
            ),
        )
    )


def skill_match(hits: Column, taxonomy: Taxonomy = SKILLS) -> Column:
    """The whole match of one text: flag, total, counts by group (present groups only) and by term."""
    per_group = F.map_from_entries(
        F.array(
            *[
                F.struct(F.lit(group).alias("key"), group_mentions(hits, group, taxonomy).alias("value"))
                for group in taxonomy.groups
            ]
        )
    )
    return F.struct(
        mentioned(hits).alias("mentioned"),
        total_mentions(hits).alias("total_mentions"),
        F.map_filter(per_group, lambda _, n: n > 0).alias("groups"),
        term_mentions(hits).alias("terms"),
    )


def word_list_pattern(words: tuple[str, ...]) -> str:
    body = "|".join(word.replace("*", f"{WORD}*") for word in words)
    return f"{NOT_AFTER_WORD}(?:{body}){NOT_BEFORE_WORD}"


def role_class(
    tag: Column,
    title: Column,
    *,
    technical_tags: tuple[str, ...] = TECHNICAL_TAGS,
    title_words: tuple[str, ...] = TECHNICAL_TITLE_WORDS,
) -> Column:
    """Category decides first, title words rescue the rest, nothing at all is unknown."""
    tag_text = F.lower(F.btrim(F.coalesce(tag, F.lit(""))))
    title_text = F.lower(F.btrim(F.coalesce(title, F.lit(""))))
    return (
        F.when(tag_text.isin(list(technical_tags)), ROLE_TECHNICAL)
        .when(title_text.rlike(word_list_pattern(title_words)), ROLE_TECHNICAL)
        .when((tag_text != "") | (title_text != ""), ROLE_NON_TECHNICAL)
        .otherwise(ROLE_UNKNOWN)
    )
