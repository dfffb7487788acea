"""Matching of texts with dictionaries of any size: word n-grams meet a table of terms in an equi-join.

The pattern of ``functions.text`` is one alternation over all terms, which is fastest for some hundred of them. Here each
run of words of a text that is as long as some term becomes a key. The join with the dictionary is an ordinary equi-join:
adaptive execution broadcasts a dictionary that is small enough and shuffles otherwise, with a filter of the dictionary's
keys in front of the shuffle. Both ways give the same hits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from advertlake.functions.text import NOT_WORD, WORD
from advertlake.session import stage


def prepared_dictionary(terms: DataFrame, term: str = "term") -> DataFrame:
    """``term, words``: distinct terms that start and end with a word character, and their numbers of words."""
    known = terms.select(F.col(term).alias("term")).filter(F.col("term").rlike(f"^{WORD}(.*{WORD})?$")).distinct()
    return stage(known.withColumn("words", F.regexp_count("term", F.lit(f"{WORD}+"))), "dictionary")


def word_grams(
    texts: DataFrame, text: Column, lengths: Sequence[int], key: Sequence[str], starts: DataFrame | None = None
) -> DataFrame:
    """``key, at, words, term``: every run of words with one of the ``lengths``, as it stands in the text.

    ``at`` is the place of its first word. Between words a run holds whatever the text has there, so it equals a term
    only if the separators do. With ``starts``, only runs whose first word is listed there as ``start``.
    """
    tokens = F.regexp_extract_all(text, F.lit(f"{WORD}+{NOT_WORD}*"), F.lit(0))
    words = F.regexp_extract_all(text, F.lit(f"{WORD}+"), F.lit(0))
    cut = texts.select(*key, tokens.alias("_tokens"), words.alias("_words"))
    n, most = F.size("_words"), F.lit(max(lengths))
    # Places are made before they become rows, which would each carry the whole text otherwise. The outer forms, because
    # a plain one is preceded by a filter that makes them again.
    places = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda at: F.struct(
            at.alias("at"), F.get("_words", at).alias("_first"),
            F.slice("_tokens", at + 1, most).alias("_to"), F.slice("_words", at + 1, most).alias("_of"),
        ),
    )
    placed = cut.select(*key, F.inline_outer(F.when(n > 0, places))).filter("_first is not null")
    if starts is not None:
        placed = placed.join(starts.select(F.col("start").alias("_first")), "_first", "left_semi")
    # what the text has up to the last word, and that; null beyond the end of the text
    runs = [
        F.struct(F.lit(m).alias("words"), F.concat(F.array_join(F.slice("_to", 1, m - 1), ""), F.get("_of", F.lit(m - 1))).alias("term"))
        for m in lengths
    ]
    return placed.select(*key, "at", F.inline_outer(F.array(*runs))).filter("term is not null")


def dictionary_hits(texts: DataFrame, dictionary: DataFrame, *, key: Sequence[str], text: Column) -> DataFrame:
    """``key, at, term``: all hits that do not overlap, in reading order the longest term at each place.

    ``dictionary`` comes from ``prepared_dictionary``; ``key`` identifies a text, whose normalized form is ``text``. A
    null text has no hits. The terms found are as many as ``find_terms`` gives for a pattern of the same dictionary.
    """
    # as many numbers as terms have lengths
    lengths = sorted(r["words"] for r in dictionary.select("words").distinct().collect())
    if not lengths:
        return texts.select(*key, F.lit(0).alias("at"), F.lit("").alias("term")).limit(0)
    starts = dictionary.select(F.regexp_extract("term", f"^{WORD}+", 0).alias("start")).distinct()
    grams = word_grams(texts, text, lengths, key, starts)
    found = grams.join(dictionary.select("term"), "term")
    longest = found.groupBy(*key, "at").agg(F.max(F.struct("words", "term")).alias("hit"))
    # hits that could overlap stand in one chain; a hit that begins behind all ends before it opens a new one
    order = Window.partitionBy(*key).orderBy("at")
    spans = longest.select(*key, "at", (F.col("at") + F.col("hit.words")).alias("end"), F.col("hit.term").alias("term"))
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("at") >= reach, F.lit(True))
    chained = spans.withColumn("_opens", opens.cast("int")).withColumn("_chain", F.sum("_opens").over(order))
    chains = chained.groupBy(*key, "_chain").agg(F.sort_array(F.collect_list(F.struct("at", "end", "term"))).alias("hits"))
    # a chain is a few words long, unless terms overlap all the way
    taken = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<at:int,term:string>>").alias("kept")),
        lambda done, hit: F.when(
            hit["at"] >= done["end"],
            F.struct(
                hit["end"].alias("end"),
                F.concat(done["kept"], F.array(F.struct(hit["at"].alias("at"), hit["term"].alias("term")))).alias("kept"),
            ),
        ).otherwise(done),
    )
    return chains.select(*key, F.inline(taken["kept"]))
