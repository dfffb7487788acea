"""Secret scans over a ledger of content-addressed versions, in DataFrame functions only.

Every version of a file is addressed by the SHA-256 of its text. The ledger holds, for every blob scanned so far, the
spans each rule version found in it. A load scans only pairs of blob and rule version that the ledger lacks, each blob
once however many paths hold it, and the findings are joined back to every path.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from advertlake.operators.windows import keep_first
from advertlake.session import stage


@dataclass(frozen=True)
class Rule:
    """``group`` of every leftmost non-overlapping match of ``pattern`` must have ``least`` characters.

    A changed pattern needs a new ``version``: blobs are then scanned again for this rule alone.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds in their order. A run of too few characters is dropped, not searched again, which a
# minimum inside the pattern gives for the last two, as no shorter tail of a run can reach it.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{24,}"),
)
# Further spans of this method: headers of private keys.
RULES = (*BASE_RULES, Rule("pem", 1, r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----"))

SPANS = "array<struct<start:bigint,end:bigint>>"
RESULTS = f"array<struct<rule:string,spans:{SPANS}>>"
LEDGER_SCHEMA = f"blob binary, results {RESULTS}"

_BLOCK = 256  # matches whose positions are summed up together


def address(text: Column) -> Column:
    """SHA-256 of a whole text, a null being the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _spans(text: Column, rule: Rule) -> Column:
    """Spans of a rule, in code points.

    Splitting at the pattern gives the texts between the matches, and their lengths the positions. Sums run inside
    blocks of matches and over the blocks, so a text with very many matches stays cheap.
    """
    pattern = F.lit(rule.pattern)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else hits
    parts = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x)).alias("gap"),
        F.transform(hits, lambda x: F.length(x)).alias("hit"),
        F.transform(counted, lambda x: F.length(x)).alias("counted"),
    )
    # the last part is the text behind the last match, without a match of its own
    matches = F.filter(parts, lambda x: x["hit"].isNotNull())
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(matches) - 1) / _BLOCK), F.lit(0)).cast("int")),
        lambda i: F.slice(matches, i * _BLOCK + 1, _BLOCK),
    )
    size = lambda x: (x["gap"] + x["hit"]).cast("bigint")
    zero = F.lit(0).cast("bigint")
    nothing = F.array().cast(SPANS)

    def inside(block: Column) -> Column:
        start = F.struct(zero.alias("at"), nothing.alias("out"))

        def step(acc: Column, x: Column) -> Column:
            first = acc["at"] + x["gap"]
            span = F.array(F.struct(first.alias("start"), (first + x["hit"]).alias("end")))
            out = F.when(x["counted"] >= rule.least, F.concat(acc["out"], span)).otherwise(acc["out"])
            return F.struct((acc["at"] + size(x)).alias("at"), out.alias("out"))

        return F.aggregate(block, start, step)

    def behind(acc: Column, block: Column) -> Column:
        moved = F.transform(
            block["out"],
            lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end")),
        )
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    start = F.struct(zero.alias("at"), F.array().cast(f"array<{SPANS}>").alias("out"))
    found = F.flatten(F.aggregate(F.transform(blocks, inside), start, behind, lambda acc: acc["out"]))
    return F.when(F.rlike(text, pattern), found).otherwise(nothing)


# Addresses that a task may hold to pick texts by, some 30 MB of them; with more all texts are moved, each once a task.
BROADCAST_BLOBS = 200_000


class BlobLedger:
    """The ledger table at ``path``.

    ``record`` can be repeated after a failure: what was written is not scanned again. Null texts count as empty,
    which have no findings; repeated rows share one blob; columns other than the text are never read here.
    """

    def __init__(self, spark: SparkSession, path: str, rules: Sequence[Rule] = RULES):
        if len({r.key for r in rules}) < len(rules):
            raise ValueError("two rules have the same kind and version")
        self.spark, self.path, self.rules = spark, path, tuple(rules)

    def table(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER_SCHEMA)

    def unseen(self, texts: DataFrame, text: str = "text") -> DataFrame:
        """One row per blob that lacks some rule version: ``blob, text, todo``.

        With a ledger to ask, the addresses alone, combined in front of the shuffle, are matched with it first. Texts are
        moved for blobs that lack something, and none if no blob does.
        """
        addressed = texts.select(address(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        wanted = F.array(*[F.lit(r.key) for r in self.rules])
        ledger = self.table()
        if ledger.isEmpty():
            return keep_first(addressed, ["blob"], ["blob"]).withColumn("todo", wanted)
        done = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("results.rule"))).alias("done"))
        blobs = addressed.select("blob").distinct().join(done, "blob", "left")
        todo = F.array_except(wanted, F.coalesce(F.col("done"), F.array().cast("array<string>")))
        lacking = stage(blobs.select("blob", todo.alias("todo")).filter("size(todo) > 0"), "secret-lacking")
        n = lacking.count()
        if n == 0:
            return texts.sparkSession.createDataFrame([], "blob string, text string, todo array<string>")
        if n <= BROADCAST_BLOBS:
            return keep_first(addressed.join(F.broadcast(lacking), "blob"), ["blob"], ["blob"])
        return keep_first(addressed, ["blob"], ["blob"]).join(lacking, "blob")

    def record(self, texts: DataFrame, text: str = "text") -> None:
        """Scan what is unseen in ``texts`` and append it to the ledger."""
        results = F.filter(
            F.array(
                *[
                    F.when(
                        F.array_contains("todo", r.key),
                        F.struct(F.lit(r.key).alias("rule"), _spans(F.col("text"), r).alias("spans")),
                    )
                    for r in self.rules
                ]
            ),
            lambda x: x.isNotNull(),
        )
        rows = self.unseen(texts, text).select("blob", results.cast(RESULTS).alias("results"))
        rows.write.mode("append").parquet(self.path)

    def findings(self) -> DataFrame:
        """``blob, spans`` of blobs with a finding of a present rule version, in order of start and rule."""
        present = {r.key: i for i, r in enumerate(self.rules)}
        order = F.create_map(*[F.lit(x) for pair in present.items() for x in pair])
        kept = F.filter("results", lambda x: F.element_at(order, x["rule"]).isNotNull())
        spans = F.flatten(
            F.transform(
                kept,
                lambda x: F.transform(
                    x["spans"],
                    lambda s: F.struct(
                        s["start"].alias("start"),
                        F.element_at(order, x["rule"]).alias("rank"),
                        s["end"].alias("end"),
                        F.substring_index(x["rule"], "@", 1).alias("kind"),
                    ),
                ),
            )
        )
        found = self.table().select("blob", spans.alias("spans")).filter("size(spans) > 0")
        # a blob has a ledger row for every load that met a new rule version: a handful
        return found.groupBy("blob").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")
        )

    def attach(self, paths: DataFrame, text: str = "text") -> DataFrame:
        """Every row of ``paths`` with ``blob`` and ``spans`` (empty where nothing was found) in place of the text.

        Columns of these names are replaced.
        """
        kept = [c for c in paths.columns if c not in (text, "blob", "spans")]
        addressed = paths.select(*kept, address(F.col(text)).alias("blob"))
        empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
        found = stage(self.findings(), "secret-findings")  # a shuffle of its own, so that a blob of many paths can be split
        return addressed.join(found, "blob", "left").withColumn("spans", F.coalesce("spans", empty))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def secret_digest(documents: DataFrame, ledger: BlobLedger) -> DataFrame:
    """Scan ``documents`` (``doc_id, text``) and return counts and spans per row.

    Null and empty texts have no spans; repeated rows and repeated ids each give their row; an empty table gives none.
    """
    ledger.record(documents.select("text"))
    rows = ledger.attach(documents.select("doc_id", "text"))
    base = [r.kind for r in BASE_RULES]
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in base]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(listed(own).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
