"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell of source, language and topic. The cells' mass is raked: scaled in turn so that each marginal
meets its target, until all do, and never beyond what a cell holds, so that no document is needed twice. Scarce values
bound the share of the tokens with which that is possible, so the stated share is sampled or else the largest one that
meets all targets. A cell's raked mass over its tokens is its sampling probability, and the sample meets the targets in
expectation. Only the cells come to the driver: as many as the target lists span, whatever the corpus holds.

With a share that has to be kept, as ``sample_sql`` states it, a fixed number of rounds cuts masses off at what cells
hold. Such a sample can miss its targets; like targets that contradict each other, this is warned of with the marginals.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "(other)"
ROUNDS = 25
SHARE = 0.5  # of the tokens that the sample shall have
SEED = 11

# A marginal share closer than this to its target meets it. Rounds and halvings bound the search for the share.
CLOSE = 1e-7
MOST_ROUNDS = 300
HALVINGS = 12

# Topics as ordered rules on the case-folded text; the first that holds gives the topic.
TOPIC_RULES = (("license", "licensed under"), ("table", " | "), ("contact", "@"))
NO_TOPIC = "prose"

# Fixed values of the query: what share of the tokens every value of a dimension shall have.
TARGETS: dict[str, dict[str, float]] = {
    "source": {"src0": 0.15, "src1": 0.08, "src2": 0.08, "src3": 0.08, OTHER: 0.61},
    "lang": {"en": 0.52, "de": 0.18, "fr": 0.18, "es": 0.11, OTHER: 0.01},
    "topic": {"prose": 0.9, "license": 0.03, "table": 0.02, "contact": 0.05},
}

WORD = r"[^\x20\x09-\x0D]+"


def topic_of(text: Column) -> Column:
    folded = F.lower(F.coalesce(text, F.lit("")))
    out = F.lit(NO_TOPIC)
    for topic, phrase in reversed(TOPIC_RULES):
        out = F.when(F.contains(folded, F.lit(phrase)), topic).otherwise(out)
    return out


def bucket(value: Column, named: Mapping[str, float]) -> Column:
    """A value that has a target of its own, or the one for all others, nulls included."""
    return F.when(value.isin([n for n in named if n != OTHER]), value).otherwise(OTHER)


def token_count(text: Column) -> Column:
    """Words of a text, the tokens that weights are stated in."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def uniform(doc_id: Column, seed: int) -> Column:
    """A repeatable number from 0 to below 1 for an id; rows of one id share it, and so do rows without an id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


@dataclass(frozen=True)
class Raked:
    """Cells in order, their probabilities, how far the worst marginal is off its target, as a share of what was wanted,
    the share of the tokens that is sampled, and for each dimension's values (target, marginal share of the sample)."""

    probabilities: dict[tuple[str, str, str], float]
    error: float
    share: float = 0.0
    marginals: dict[str, dict[str, tuple[float, float]]] = field(default_factory=dict)


@dataclass(frozen=True)
class _Cells:
    """Cells that hold tokens and have targets, with each dimension's values, the cells' places in them, and goals."""

    names: list[str]
    keys: list[tuple[str, str, str]]
    tokens: np.ndarray
    values: list[list[str]]
    at: list[np.ndarray]
    goals: list[np.ndarray]

    @classmethod
    def of(cls, cells: Mapping[tuple[str, str, str], int], targets: Mapping[str, Mapping[str, float]]) -> _Cells:
        names = list(targets)
        keys = sorted(k for k, n in cells.items() if n > 0 and all(targets[d].get(v, 0) > 0 for d, v in zip(names, k)))
        values = [sorted({k[d] for k in keys}) for d in range(len(names))]
        at = [np.array([values[d].index(k[d]) for k in keys], np.int64) for d in range(len(names))]
        goals = []
        for d, name in enumerate(names):
            goal = np.array([targets[name][v] for v in values[d]])
            goals.append(goal / goal.sum())
        return cls(names, keys, np.array([cells[k] for k in keys], float), values, at, goals)

    def error(self, mass: np.ndarray, wanted: float) -> float:
        return max(float(abs(np.bincount(at, mass) / wanted - goal).max()) for at, goal in zip(self.at, self.goals))

    def raked(self, mass: np.ndarray, wanted: float) -> Raked:
        total, marginals = mass.sum(), {}
        for name, values, at, goal in zip(self.names, self.values, self.at, self.goals):
            got = np.bincount(at, mass) / total
            marginals[name] = {v: (float(g), float(x)) for v, g, x in zip(values, goal, got)}
        probabilities = {k: float(p) for k, p in zip(self.keys, mass / self.tokens)}
        return Raked(probabilities, self.error(mass, wanted), float(total / self.tokens.sum()), marginals)

    def bounded(self, share: float) -> tuple[np.ndarray, float]:
        """The mass nearest to the tokens that meets the goals of ``share`` within what cells hold, and its error.

        Each value's factor is solved for exactly, cells that are full counted in; the factors of full cells go on
        beyond 1, so that a later round can take back what an earlier one filled.
        """
        wanted = share * self.tokens.sum()
        factor = np.full(len(self.keys), share)
        members = [[np.flatnonzero(at == v) for v in range(len(goal))] for at, goal in zip(self.at, self.goals)]
        for _ in range(MOST_ROUNDS):
            for groups, goal in zip(members, self.goals):
                for own, g in zip(groups, goal):
                    own = own[np.argsort(-factor[own], kind="stable")]
                    f, t = factor[own], self.tokens[own]
                    full = np.concatenate(([0.0], np.cumsum(t)[:-1]))
                    scale = (g * wanted - full) / np.cumsum((f * t)[::-1])[::-1]
                    fits = np.flatnonzero(scale * f <= 1)
                    factor[own] = f * (scale[fits[0]] if len(fits) else 1 / f[-1])
            mass = np.minimum(factor, 1) * self.tokens
            error = self.error(mass, wanted)
            if error < CLOSE:
                break
        return mass, error


def rake(
    cells: Mapping[tuple[str, str, str], int],
    targets: Mapping[str, Mapping[str, float]],
    rounds: int = ROUNDS,
    share: float = SHARE,
) -> Raked:
    """Iterative proportional fitting over the cells that hold tokens, for a share that has to be kept.

    A value without tokens gives up its share to the others of its dimension in proportion. A value with target 0 or
    none has probability 0. Targets that contradict each other or ask for more than the cells hold leave an ``error``.
    """
    known = _Cells.of(cells, targets)
    if not known.keys:
        return Raked({}, 0.0)
    tokens = known.tokens
    wanted = share * tokens.sum()
    mass = tokens * share
    for _ in range(rounds):
        for at, goal in zip(known.at, known.goals):
            mass = np.minimum(mass * (goal * wanted / np.bincount(at, mass))[at], tokens)
    return known.raked(mass, wanted)


def rake_within_reach(
    cells: Mapping[tuple[str, str, str], int],
    targets: Mapping[str, Mapping[str, float]],
    rounds: int = ROUNDS,
    share: float = SHARE,
) -> Raked:
    """As ``rake``, with ``share`` or else the largest share below it with which every marginal meets its target.

    Only targets that contradict each other on these cells, which no share can meet, leave an ``error``.
    """
    known = _Cells.of(cells, targets)
    if not known.keys:
        return Raked({}, 0.0)
    total = known.tokens.sum()
    # no value can give more than it holds
    high = min(share, *(float((np.bincount(at, known.tokens) / (goal * total)).min()) for at, goal in zip(known.at, known.goals)))
    mass, error = known.bounded(high)
    reached = (mass, high) if error < CLOSE else None
    low = 0.0
    for _ in range(HALVINGS if reached is None else 0):
        middle = (low + high) / 2
        mass, error = known.bounded(middle)
        if error < CLOSE:
            low, reached = middle, (mass, middle)
        else:
            high = middle
    if reached is None:
        return rake(cells, targets, rounds, share)
    return known.raked(reached[0], reached[1] * total)


def described(documents: DataFrame, targets: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """``row`` (the columns of ``documents``), ``cell`` (bucketed source, language and topic) and ``n_tokens``."""
    cell = F.struct(
        bucket(F.col("source"), targets["source"]).alias("source"),
        bucket(F.col("lang"), targets["lang"]).alias("lang"),
        bucket(topic_of(F.col("text")), targets["topic"]).alias("topic"),
    )
    return documents.select(F.struct("*").alias("row"), cell.alias("cell"), token_count(F.col("text")).alias("n_tokens"))


def raked_cells(
    documents: DataFrame,
    targets: Mapping[str, Mapping[str, float]] = TARGETS,
    rounds: int = ROUNDS,
    share: float | None = None,
) -> Raked:
    """The raked cells of ``documents`` for a ``share`` that has to be kept, or else for the one within reach.

    Warns with the marginals if they miss their targets.
    """
    sums = described(documents.select("text", "source", "lang"), targets).groupBy("cell").agg(F.sum("n_tokens").alias("n"))
    # at most one row per combination of target values
    cells = {(r["cell"]["source"], r["cell"]["lang"], r["cell"]["topic"]): r["n"] for r in sums.collect()}
    raked = rake_within_reach(cells, targets, rounds) if share is None else rake(cells, targets, rounds, share)
    if raked.error >= CLOSE:
        missed = [f"{v} {x:.4f} for {g:.4f}" for m in raked.marginals.values() for v, (g, x) in m.items() if abs(x - g) >= 5e-5]
        warnings.warn(f"sample misses its targets (error {raked.error:.4f}): {', '.join(missed)}", stacklevel=2)
    return raked


def rated(documents: DataFrame, raked: Raked, targets: Mapping[str, Mapping[str, float]] = TARGETS) -> DataFrame:
    """``described`` rows with their ``probability``; those of cells without tokens have probability 0."""
    rows = [(*k, p) for k, p in raked.probabilities.items()]
    known = documents.sparkSession.createDataFrame(rows, "s string, l string, t string, p double")
    same = (F.col("cell.source") == F.col("s")) & (F.col("cell.lang") == F.col("l")) & (F.col("cell.topic") == F.col("t"))
    joined = described(documents, targets).join(F.broadcast(known), same, "left")  # bounded by the target lists
    return joined.select("row", "cell", "n_tokens", F.coalesce("p", F.lit(0.0)).alias("probability"))


def sample_to_targets(
    documents: DataFrame,
    targets: Mapping[str, Mapping[str, float]] = TARGETS,
    *,
    rounds: int = ROUNDS,
    seed: int = SEED,
    share: float | None = None,
) -> DataFrame:
    """The sampled rows of ``documents`` (``doc_id, text, source, lang`` and any others): ``row, cell, n_tokens, probability``.

    Without a ``share`` the sample meets the targets, with ``SHARE`` of the tokens or the most that does.

    A row stays if its id's number is below its cell's probability, so a run can be repeated row by row. Null sources
    and languages count as other ones; rows of a cell without words are not sampled; an empty table gives none.
    """
    rows = rated(documents, raked_cells(documents, targets, rounds, share), targets)
    return rows.filter(uniform(F.col("row.doc_id"), seed) < F.col("probability"))


def sample_sql(
    targets: Mapping[str, Mapping[str, float]] = TARGETS, rounds: int = ROUNDS, seed: int = SEED, share: float = SHARE
) -> str:
    """The same sample in SQL, the rounds written out one by one."""
    names = list(targets)
    topic = "CASE " + " ".join(f"WHEN contains(lower(t), '{p}') THEN '{v}'" for v, p in TOPIC_RULES) + f" ELSE '{NO_TOPIC}' END"

    def bucketed(column: str, name: str) -> str:
        listed = ", ".join(f"'{v}'" for v in targets[name] if v != OTHER)
        return f"CASE WHEN {column} IN ({listed}) THEN {column} ELSE '{OTHER}' END"

    goals = "\nUNION ALL ".join(f"SELECT '{d}' AS dim, '{v}' AS value, {x}::DOUBLE AS goal" for d in names for v, x in targets[d].items())
    steps = [
        f"""WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
e AS (SELECT doc_id, {bucketed("source", "source")} AS source, {bucketed("lang", "lang")} AS lang,
  {bucketed("topic", "topic")} AS topic, CAST(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens,
  CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM (SELECT *, {topic} AS topic FROM d)),
goals AS ({goals}),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM e GROUP BY ALL HAVING sum(n_tokens) > 0),
m0 AS MATERIALIZED (SELECT source, lang, topic, tokens, tokens * {share}::DOUBLE AS m FROM cells
  JOIN goals a ON a.dim = 'source' AND a.value = source AND a.goal > 0
  JOIN goals b ON b.dim = 'lang' AND b.value = lang AND b.goal > 0
  JOIN goals c ON c.dim = 'topic' AND c.value = topic AND c.goal > 0)"""
    ]
    for d in names:
        steps.append(
            f"g_{d} AS MATERIALIZED (SELECT value, goal / sum(goal) OVER () AS goal FROM goals WHERE dim = '{d}' AND value IN (SELECT {d} FROM m0))"
        )
    steps.append(f"wanted AS MATERIALIZED (SELECT sum(tokens) * {share}::DOUBLE AS w FROM m0)")
    k = 0
    for _ in range(rounds):
        for d in names:
            steps.append(
                f"m{k + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, least(m * (goal * w / sum(m) OVER (PARTITION BY {d})), tokens) AS m FROM m{k} JOIN g_{d} ON value = {d}, wanted)"
            )
            k += 1
    last = f"""p AS (SELECT source, lang, topic, m / tokens AS p FROM m{k})
SELECT doc_id, source, lang, topic, n_tokens, round(p, 9) AS probability FROM e JOIN p USING (source, lang, topic) WHERE u < p"""
    return ",\n".join([*steps, last])
