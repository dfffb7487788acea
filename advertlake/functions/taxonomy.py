"""The versioned skill dictionary and the role rules, as plain data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Skill groups and their terms, version 1.0.
TAXONOMY_VERSION = "1.0"
SKILL_GROUPS: dict[str, list[str]] = {
    "general_ai": [
        "artificial intelligence",
        "ai",
        "ml",
        "data science",
        "automation",
        "smart automation",
        "ai-powered",
    ],
    "machine_learning": [
        "machine learning",
        "deep learning",
        "neural network",
        "neural networks",
        "natural language processing",
        "nlp",
        "computer vision",
        "reinforcement learning",
        "predictive modeling",
        "predictive modelling",
        "recommendation system",
        "data mining",
        "forecasting",
    ],
    "ml_tools": [
        "tensorflow",
        "pytorch",
        "scikit-learn",
        "sklearn",
        "keras",
        "xgboost",
        "lightgbm",
        "hugging face",
    ],
    "generative_ai": [
        "generative ai",
        "genai",
        "large language model",
        "large language models",
        "llm",
        "llms",
        "foundation model",
        "openai",
        "chatgpt",
        "gpt-4",
        "gpt-5",
        "claude",
        "gemini",
        "copilot",
        "langchain",
        "retrieval augmented generation",
        "rag",
        "vector database",
        "vector db",
        "prompt engineering",
        "stable diffusion",
        "midjourney",
    ],
}
# Counter column of each group in the flags table.
GROUP_COLUMNS = {
    "general_ai": "ai_general_ai",
    "machine_learning": "ai_machine_learning",
    "ml_tools": "ai_ml_tools",
    "generative_ai": "ai_generative_ai",
}

# Role rules, version 1.0. A trailing * stands for any run of word characters.
ROLE_CLASSIFIER_VERSION = "1.0"
TECHNICAL_TAGS = ("it-jobs", "engineering-jobs")
TECHNICAL_TITLE_WORDS = (
    "engineer*",
    "developer",
    "programmer",
    "software",
    "devops",
    "sre",
    "architect",
    "data*",
    "scientist",
    "analyst",
    "ml",
    "ai",
    "backend",
    "frontend",
    "full[- ]?stack",
    "platform",
    "cloud",
    "infrastructure",
    "cyber",
    "python",
    "sql",
    "java",
    "machine[- ]?learning",
    "nlp",
)
ROLE_TECHNICAL = "technical"
ROLE_NON_TECHNICAL = "non-technical"
ROLE_UNKNOWN = "unknown"


@dataclass(frozen=True)
class Taxonomy:
    """Groups of lower-case terms, the counter column of each group, and a version."""

    groups: Mapping[str, Sequence[str]]
    columns: Mapping[str, str]
    version: str

    def __post_init__(self) -> None:
        for term in self.terms:
            edges = term[:1] + term[-1:]
            if term != term.lower() or not edges or not all(c.isalnum() or c == "_" for c in edges):
                raise ValueError(f"a term is lower case and starts and ends with a word character: {term!r}")

    @property
    def terms(self) -> list[str]:
        return [term for terms in self.groups.values() for term in terms]

    def group_of(self, term: str) -> str:
        return next(group for group, terms in self.groups.items() if term in terms)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(group, term, self.version) for group, terms in self.groups.items() for term in terms]
        return spark.createDataFrame(rows, "group string, term string, version string")


SKILLS = Taxonomy(SKILL_GROUPS, GROUP_COLUMNS, TAXONOMY_VERSION)
