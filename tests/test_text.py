import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from advertlake.functions import text as X
from advertlake.functions.taxonomy import SKILLS, Taxonomy
from advertlake.operators import enrich as E


def scan(spark, texts, taxonomy=SKILLS):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = E.with_hits(df, F.col("t"), taxonomy).orderBy("i").collect()
    return [list(r.hits) for r in rows]


def match(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    return E.with_hits(df, F.col("t")).select(X.skill_match(F.col("hits")).alias("m")).first().m


def naive_hits(text, terms):
    """Walk over the text; at each word start try the longest term first."""
    t = unicodedata.normalize("NFKD", text or "").lower()
    word = lambda c: c.isalnum() or c == "_"
    found, i = [], 0
    while i < len(t):
        if i == 0 or not word(t[i - 1]):
            for term in sorted(terms, key=len, reverse=True):
                end = i + len(term)
                if t.startswith(term, i) and (end == len(t) or not word(t[end])):
                    found.append(term)
                    i = end - 1
                    break
        i += 1
    return found


def test_acronyms_need_word_boundaries(spark):
    hit = match(spark, "We need experience with AI and ML pipelines.")
    assert hit.mentioned and hit.terms == {"ai": 1, "ml": 1} and hit.groups == {"general_ai": 2}
    none = match(spark, "Please aim for a good email layout; available skills matter.")
    assert not none.mentioned and none.total_mentions == 0 and none.terms == {} and none.groups == {}


def test_phrases_belong_to_groups(spark):
    hit = match(spark, "Deep learning plus LLMs required; also TensorFlow.")
    assert hit.groups == {"machine_learning": 1, "generative_ai": 1, "ml_tools": 1}
    assert hit.terms == {"deep learning": 1, "llms": 1, "tensorflow": 1}


@pytest.mark.parametrize(
    ("text", "hits"),
    [
        ("smart automation", ["smart automation"]),
        ("smart  automation and automation", ["smart automation", "automation"]),
        ("AI-powered AI", ["ai-powered", "ai"]),
        ("generative AI", ["generative ai"]),
        ("llms llm LLM,LLMs", ["llms", "llm", "llm", "llms"]),
        ("ai ai ai", ["ai", "ai", "ai"]),
        ("aí", ["ai"]),
        ("éai", ["ai"]),
        ("ai_x x_ai ai2", []),
        ("ßai aiß œai", []),
        ("ＡＩ", ["ai"]),
        ("machine<br>learning", ["machine learning"]),
        ("machine&nbsp;learning gpt-4.", ["machine learning", "gpt-4"]),
        ("scikit-learn/sklearn", ["scikit-learn", "sklearn"]),
        ("", []),
        (None, []),
    ],
)
def test_overlaps_and_boundaries(spark, text, hits):
    assert scan(spark, [text]) == [hits]


def test_agrees_with_a_naive_walk_over_random_texts(spark):
    rng = random.Random(5)
    pieces = [*SKILLS.terms, " ", " ", "-", ",", "_", "s", "é", "ß", "ai", "ml", "́", "x", "2", "."]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    for text, hits in zip(texts, scan(spark, texts)):
        assert hits == naive_hits(text, SKILLS.terms), text


def test_normalisation(spark):
    given = ["<p>AI&nbsp;skills</p>", "A\x00B\x7fC", "  X   Y ", "café", None, "a<b\n>c", "&amp; ﬁ", " z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, t string")
    got = [r.n for r in df.select("i", X.normalize_text(F.col("t")).alias("n")).orderBy("i").collect()]
    assert got == ["ai skills", "a b c", "x y", "café", "", "a c", "&amp; fi", "z"]


def test_ascii_texts_are_not_sent_to_python(spark):
    df = spark.createDataFrame([("plain",)], "t string")
    plan = df.select(X.normalize_text(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "octet_length" in plan


@pytest.mark.parametrize(
    ("tag", "title", "role"),
    [
        ("it-jobs", "Software Developer", "technical"),
        ("engineering-jobs", "Mechanical Engineer", "technical"),
        (" IT-Jobs ", None, "technical"),
        ("marketing-jobs", "Marketing Executive", "non-technical"),
        ("", "Senior Data Scientist", "technical"),
        ("hr-jobs", "Engineering Lead", "technical"),
        ("hr-jobs", "Full-Stack wizard", "technical"),
        ("hr-jobs", "Javascript", "non-technical"),
        ("hr-jobs", "Databases", "technical"),
        (None, "Nurse", "non-technical"),
        (None, None, "unknown"),
        ("", " ", "unknown"),
    ],
)
def test_role_class(spark, tag, title, role):
    df = spark.createDataFrame([(tag, title)], "category_tag string, title string")
    assert E.add_role_class(df).first().role_class == role


def test_taxonomy_is_whole_and_checked(spark):
    table = SKILLS.table(spark)
    assert {r["group"]: r["count"] for r in table.groupBy("group").count().collect()} == {
        "general_ai": 7, "machine_learning": 13, "ml_tools": 8, "generative_ai": 22,
    }
    assert SKILLS.group_of("rag") == "generative_ai"
    with pytest.raises(ValueError):
        Taxonomy({"g": ["c++"]}, {"g": "n"}, "1")


def test_term_counts_by_country_and_group(spark):
    ads = spark.createDataFrame(
        [("gb", "AI role", "uses AI and RAG"), ("us", None, "rag"), ("us", "Nurse", None)],
        "country string, title string, description string",
    )
    total = {r.term: r.mentions for r in E.term_counts(ads).collect()}
    assert total == {"ai": 2, "rag": 2}
    by_country = {(r.country, r.term): r.mentions for r in E.term_counts(ads, by=["country"]).collect()}
    assert by_country == {("gb", "ai"): 2, ("gb", "rag"): 1, ("us", "rag"): 1}
    grouped = {(r.term, r.term_group) for r in E.with_group(E.term_counts(ads)).collect()}
    assert grouped == {("ai", "general_ai"), ("rag", "generative_ai")}
