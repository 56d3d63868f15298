"""Slowly changing dimensions, type 2, with half-open day intervals ``[effective_from, effective_to)``."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.checks import all_of

ACTION = "_action"
NEW, CHANGED, SAME, ABSENT = "NEW", "CHANGED", "SAME", "ABSENT"
VERSION_COLUMNS = ["effective_from", "effective_to", "is_active"]


def _compare(active: DataFrame, incoming: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """Full outer join on the key: columns ``cur`` and ``inc`` (structs) and the action."""
    cur = active.select(*keys, F.struct(*active.columns).alias("cur"))
    inc = incoming.select(*keys, F.struct(*incoming.columns).alias("inc"))
    same = all_of(F.col(f"cur.{c}").eqNullSafe(F.col(f"inc.{c}")) for c in tracked)
    action = (
        F.when(F.col("cur").isNull(), NEW).when(F.col("inc").isNull(), ABSENT).when(same, SAME).otherwise(CHANGED)
    )
    return cur.join(inc, keys, "full_outer").withColumn(ACTION, action)


def scd2_merge(current: DataFrame, incoming: DataFrame, keys: Iterable[str], tracked: Iterable[str],
               as_of: date, on_close: dict[str, Column] | None = None, with_action: bool = False) -> DataFrame:
    """The state after merging ``incoming`` (one row per key, no NULL keys) at ``as_of``.

    New key: open a version. Changed: end the version that is valid on that day and begin one, which lasts as
    long as the ended one did. Unchanged or absent: keep. A change on the day a version began replaces that
    version. Days may come in any order: a change before a key's first version lasts until that begins, and
    later versions stay. ``on_close`` sets further columns of ended versions. Both sides of the join hold a
    key once, so no key is hot. Versions that begin after the day, usually none, are only asked for their first day.
    """
    keys, tracked = list(keys), list(tracked)
    names = current.columns
    day = F.lit(as_of).cast("date")
    lasts = F.col("is_active") | F.coalesce(F.col("effective_to") > day, F.lit(False))
    begun = F.col("effective_from") <= day
    following = current.filter(~begun).groupBy(*keys).agg(F.min("effective_from").alias("_next"))
    arriving = set(incoming.columns)
    joined = _compare(current.filter(lasts & begun), incoming.join(following, keys, "left"), keys, tracked)
    on_close = on_close or {}

    until = F.when(F.col("cur").isNull(), F.col("inc._next")).otherwise(F.col("cur.effective_to"))
    opening = {"effective_from": day, "effective_to": until, "is_active": until.isNull()}
    closing = {"effective_to": day, "is_active": F.lit(False), **on_close}
    types = {f.name: f.dataType for f in current.schema.fields}

    def version(build) -> Column:
        return F.struct(*[build(c).cast(types[c]).alias(c) for c in names])

    kept = version(lambda c: F.col(f"cur.{c}"))
    closed = version(lambda c: closing.get(c, F.col(f"cur.{c}")))
    opened = version(lambda c: opening[c] if c in opening else F.col(f"inc.{c}") if c in arriving else F.lit(None))

    action = F.col(ACTION)
    rows = F.array_compact(F.array(
        F.when(action.isin(SAME, ABSENT), kept)
        .when((action == CHANGED) & (F.col("cur.effective_from") < day), closed),
        F.when(action.isin(NEW, CHANGED), opened),
    ))
    merged = joined.select(action, F.inline(rows))
    no_action = F.lit(None).cast("string")
    others = current.filter(~(lasts & begun)).withColumn(ACTION, no_action)
    result = merged.unionByName(others)
    return result if with_action else result.drop(ACTION)


def scd2_actions(current: DataFrame, incoming: DataFrame, keys: Iterable[str], tracked: Iterable[str]) -> DataFrame:
    """How many keys a merge would insert, update, keep or leave alone."""
    joined = _compare(current.filter("is_active"), incoming, list(keys), list(tracked))
    return joined.groupBy(F.col(ACTION).alias("action")).agg(F.count(F.lit(1)).alias("n"))


def open_all(incoming: DataFrame, as_of: date) -> DataFrame:
    """First load: every row becomes an open version."""
    return incoming.withColumns({
        "effective_from": F.lit(as_of).cast("date"),
        "effective_to": F.lit(None).cast("date"),
        "is_active": F.lit(True),
    })


def scd2_key_report(history: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Per key: the number of versions and the list of broken invariants.

    Versions are first counted per key and start day, so the ordered comparison sees a key at most
    once per day, however many rows the key has.
    """
    keys = list(keys)
    per_start = history.groupBy(*keys, "effective_from").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_active").alias("active"),
        F.max("effective_to").alias("last_end"),
        F.count_if(F.col("effective_to").isNull() != F.col("is_active")).alias("mislabelled"),
        F.count_if(F.col("effective_to") <= F.col("effective_from")).alias("empty_span"),
        F.count_if(F.col("effective_to").isNull()).alias("open_ended"),
    )
    following = Window.partitionBy(*keys).orderBy("effective_from")
    next_start = F.lead("effective_from").over(following)
    overlap = next_start.isNotNull() & ((F.col("open_ended") > 0) | (F.col("last_end") > next_start))
    per_key = per_start.withColumn("overlap", overlap).groupBy(*keys).agg(
        F.sum("active").alias("active"),
        F.max("n").alias("n"),
        F.sum("n").alias("versions"),
        F.sum("mislabelled").alias("mislabelled"),
        F.sum("empty_span").alias("empty_span"),
        F.bool_or("overlap").alias("overlap"),
    )
    problems = F.array_compact(F.array(
        F.when(F.col("active") != 1, "NOT_ONE_ACTIVE"),
        F.when(F.col("n") > 1, "SAME_START"),
        F.when(F.col("mislabelled") > 0, "FLAG_MISMATCH"),
        F.when(F.col("empty_span") > 0, "EMPTY_SPAN"),
        F.when(F.col("overlap"), "OVERLAP"),
    ))
    return per_key.select(*keys, "versions", problems.alias("problems"))


def scd2_violations(history: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Broken invariants, one row per (key, problem)."""
    keys = list(keys)
    return scd2_key_report(history, keys).select(*keys, F.explode("problems").alias("problem"))


def lookup_as_of(facts: DataFrame, versions: DataFrame, key: str, at: str, columns: Iterable[str],
                 how: str = "left") -> DataFrame:
    """Each fact with ``columns`` of the version valid on its day: a sorted sweep in one shuffle. The facts' first and
    last day are asked for at once; store facts that are costly to compute.

    Facts and versions go through one sort per key and month, where each fact takes the last version that began before
    it, if that has not ended. So work does not grow with facts times versions of a key, and a key with most of the
    facts is spread over its months. A version is entered in every month it is valid in, between the first and last
    day of the facts; as versions of a key do not overlap, that is at most one row per version and one per month. Facts
    without key or day are spread by their hash and find nothing. ``how`` is ``left`` or ``inner``.
    """
    columns = list(columns)
    first, last = facts.agg(F.min(F.col(at).cast("date")), F.max(F.col(at).cast("date"))).first()
    place, day = F.col(key), F.col(at).cast("date")
    lost = place.isNull() | day.isNull()
    fact_rows = facts.select(
        place.alias("_key"), F.when(lost, F.xxhash64(*facts.columns)).otherwise(_month(day)).alias("_month"), day.alias("_day"),
        F.lit(1).alias("_kind"), F.struct(*facts.columns).alias("_fact"))
    low, high = (F.lit(d).cast("date") for d in (first, last))
    began = F.col("effective_from")
    enters = F.greatest(began, low)
    leaves = F.least(F.coalesce(F.date_sub("effective_to", 1), high), high)
    found = F.struct(F.col("effective_to").alias("_to"), *columns)
    version_rows = versions.filter(F.col(key).isNotNull() & (enters <= leaves)).select(
        F.col(key).alias("_key"), F.explode(F.sequence(_month(enters), _month(leaves))).alias("_month"), began.alias("_day"),
        F.lit(0).alias("_kind"), found.alias("_version"))
    sweep = Window.partitionBy("_key", "_month").orderBy("_day", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = fact_rows.unionByName(version_rows, allowMissingColumns=True).withColumn("_version", F.last("_version", True).over(sweep))
    valid = F.col("_version._to").isNull() | (F.col("_day") < F.col("_version._to"))
    rows = swept.filter("_kind = 1").withColumn("_version", F.when(valid, F.col("_version")))
    if how == "inner":
        rows = rows.filter("_version IS NOT NULL")
    return rows.select("_fact.*", *[F.col(f"_version.`{c}`") for c in columns])


def _month(day: Column) -> Column:
    return (F.year(day) * 12 + F.month(day)).cast("bigint")
