"""Slowly changing dimensions (type 2) from daily snapshots, and facts that point into them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from advertlake.operators.interval import with_versions
from advertlake.session import stage

VALIDITY = ("valid_from", "valid_to", "is_current")


@dataclass(frozen=True)
class Dimension:
    """Business key and tracked attributes of one dimension of the snapshot table."""

    name: str
    key: tuple[str, ...]
    tracked: tuple[str, ...]


DIMENSIONS = (
    Dimension("company", ("company_name",), ()),
    Dimension(
        "location",
        ("country", "location_display_name"),
        ("location_area_0", "location_area_1", "location_area_2", "latitude", "longitude"),
    ),
    Dimension("category", ("category_tag",), ("category_label",)),
    Dimension(
        "job",
        ("job_id", "country"),
        ("title", "salary_min", "salary_max", "contract_type", "contract_time"),
    ),
)


def surrogate_key(key: Sequence[str], valid_from: str = "valid_from") -> Column:
    """A version's id, the same on every run: a digest of business key and start."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in (*key, valid_from)]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def daily_states(
    snapshots: DataFrame,
    *,
    key: Sequence[str],
    tracked: Sequence[str],
    at: str = "ingest_date",
    last_by: Sequence[str] = ("job_id",),
) -> DataFrame:
    """One state of every key per snapshot date: the row that is last in ``last_by`` order.

    Many adverts share a company or a place, so this runs first and combines before the shuffle.
    What follows sees one row per key and date: a key never outgrows the calendar.
    """
    dated = snapshots.dropna(subset=[*key, at])
    if not tracked:
        return dated.select(*key, at).distinct()
    order = [c for c in last_by if c in snapshots.columns]
    pick = F.max(F.struct(*order, *[F.col(c).alias(f"_{c}") for c in tracked])).alias("_last")
    states = dated.groupBy(*key, at).agg(pick)
    return states.select(*key, at, *[F.col(f"_last._{c}").alias(c) for c in tracked])


def versions(
    states: DataFrame, *, key: Sequence[str], tracked: Sequence[str], at: str = "ingest_date"
) -> DataFrame:
    """Runs of equal states to versions ``[valid_from, valid_to)``; the open one ends in null."""
    timeline = Window.partitionBy(*key).orderBy(at)
    state = F.struct(*tracked) if tracked else F.struct(F.lit(0).alias("none"))
    previous = F.lag(state).over(timeline)
    first = F.row_number().over(timeline) == 1
    changed = (
        states.withColumn("_state", state)
        .withColumn("_changed", first | ~previous.eqNullSafe(state))
        .filter("_changed")
    )
    out = changed.withColumn("valid_from", F.col(at)).withColumn("valid_to", F.lead(at).over(timeline))
    return out.select(
        surrogate_key(key).alias("version_id"),
        *key,
        *tracked,
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def build_dimension(
    snapshots: DataFrame, dimension: Dimension, *, at: str = "ingest_date", last_by: Sequence[str] = ("job_id",)
) -> DataFrame:
    spec = {"key": dimension.key, "tracked": dimension.tracked, "at": at}
    return versions(daily_states(snapshots, last_by=last_by, **spec), **spec)


def extend_dimension(
    current: DataFrame,
    delta: DataFrame,
    dimension: Dimension,
    *,
    loaded_until: str | None = None,
    snapshots: DataFrame | None = None,
    at: str = "ingest_date",
    last_by: Sequence[str] = ("job_id",),
) -> DataFrame:
    """The dimension after a batch of snapshots; equal to building it from all of them.

    ``loaded_until`` is the last day that ``current`` was built from. A delta of that day or later
    needs the dimension alone: of each touched key the open version, and the one before it if the
    open one began on a day that is sent again, meet the new states. All other versions pass through
    unread. Versions do not tell on which days a state was seen again, so a delta with an earlier day
    needs ``snapshots``, all rows stored so far: the touched keys are then built from these and the
    delta, whose states replace those of the same day. Without them an earlier day is refused.
    """
    spec = {"key": dimension.key, "tracked": dimension.tracked, "at": at}
    fresh = daily_states(delta, last_by=last_by, **spec)
    if snapshots is None:
        if loaded_until is None:
            raise ValueError("loaded_until or snapshots is needed")
        late = fresh.filter(F.col(at) < loaded_until)
        if not late.isEmpty():
            raise ValueError(f"a snapshot lies before {loaded_until}: pass the stored snapshots")
    fresh = stage(fresh, f"{dimension.name}-states")
    keys = list(dimension.key)
    touched = fresh.groupBy(*keys).agg(F.min(at).alias("_from"))
    if snapshots is not None:
        known = daily_states(snapshots.join(touched.select(*keys), keys, "left_semi"), last_by=last_by, **spec)
        past = known.join(fresh.select(*keys, at), [*keys, at], "left_anti")
        untouched = current.join(touched.select(*keys), keys, "left_anti")
        return untouched.select(*current.columns).unionByName(versions(past.unionByName(fresh), **spec))
    # Of a touched key what ends on the delta's first day or later, or is open, is built again.
    met = current.join(touched, keys, "left")
    again = F.col("_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("_from")))
    passed = met.filter(~again).select(*current.columns)
    opened = met.filter(again).select(*keys, F.col("valid_from").alias(at), *dimension.tracked)
    kept = opened.join(fresh.select(*keys, at), [*keys, at], "left_anti")
    return passed.unionByName(versions(kept.unionByName(fresh), **spec))


def date_dimension(snapshots: DataFrame, at: str = "ingest_date") -> DataFrame:
    """One row per calendar day between the first and the last snapshot date."""
    span = snapshots.agg(F.min(F.to_date(at)).alias("lo"), F.max(F.to_date(at)).alias("hi"))
    days = span.filter("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return days.select(
        F.date_format("day", "yyyyMMdd").cast("int").alias("date_id"),
        "day",
        F.year("day").alias("year"),
        F.quarter("day").alias("quarter"),
        F.month("day").alias("month"),
        F.dayofmonth("day").alias("day_of_month"),
        (F.weekday("day") + 1).alias("iso_weekday"),
        F.date_trunc("week", "day").cast("date").alias("week"),
    )


def with_version(
    fact: DataFrame, dimension_table: DataFrame, dimension: Dimension, *, at: str = "ingest_date"
) -> DataFrame:
    """Add ``<name>_version`` of the version valid at the fact's date; no version, or a null in the key, gives null."""
    return with_versions(fact, {dimension.name: dimension_table}, {dimension.name: dimension.key}, at=at)


def snapshot_fact(
    snapshots: DataFrame,
    dimension_tables: dict[str, DataFrame],
    *,
    measures: Sequence[str] = ("salary_min", "salary_max"),
    at: str = "ingest_date",
) -> DataFrame:
    """Facts under the snapshot key with one version id per dimension, a date id and the measures.

    Facts with a null in a key have no version of that dimension. The snapshots are read once for all dimensions.
    """
    used = [d for d in DIMENSIONS if d.name in dimension_tables]
    needed = dict.fromkeys(["job_id", "country", at, *measures, *[c for d in used for c in d.key]])
    tables = {d.name: dimension_tables[d.name] for d in used}
    fact = with_versions(snapshots.select(*needed), tables, {d.name: d.key for d in used}, at=at)
    return fact.select(
        "job_id",
        "country",
        at,
        F.date_format(F.to_date(at), "yyyyMMdd").cast("int").alias("date_id"),
        *[f"{d.name}_version" for d in used],
        *measures,
    )
