"""Keeping dimensions up to date, and comparing snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import content_hash, version_key
from ..functions.guards import insist, unique_rows

LOW_DATE = "1900-01-01"
HIGH_DATE = "9999-12-31"


def scd1_merge(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows replace their namesakes; target rows nobody mentions stay.

    A column that only ``incoming`` has is added, NULL in the rows that stay; one that only
    ``target`` has raises.
    """
    target = _widened(target, incoming, "upsert")
    fresh = unique_rows(incoming.select(*target.columns), keys, "upsert")
    return target.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh)


def _widened(target: DataFrame, incoming: DataFrame, what: str, own: Sequence[str] = ()) -> DataFrame:
    """``target`` with the columns it lacks; ``own`` are those that ``incoming`` need not have."""
    missing = [name for name in target.columns if name not in incoming.columns and name not in own]
    if missing:
        raise ValueError(f"{what} lacks {', '.join(missing)}")
    added = {f.name: F.lit(None).cast(f.dataType) for f in incoming.schema.fields if f.name not in target.columns}
    return target.withColumns(added) if added else target


def _first_versions(
    incoming: DataFrame, keys: Sequence[str], tracked: Sequence[str], rest: Sequence[str], start: Column, surrogate: str
) -> DataFrame:
    return incoming.select(
        *keys,
        *tracked,
        *rest,
        start.alias("effective_from"),
        F.lit(HIGH_DATE).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
        row_hash(tracked).alias("row_hash"),
        version_key([F.col(k) for k in keys], start).alias(surrogate),
    )


def row_hash(tracked: Sequence[str]) -> Column:
    """Text hash of the tracked attributes; NULL and '' differ, and no separator can collide."""
    kept = F.to_json(F.struct(*tracked), {"ignoreNullFields": "false"})
    return F.sha2(kept, 256)


def scd2_merge(
    target: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective_date: str,
    surrogate: str = "location_key",
    open_from: str | None = LOW_DATE,
) -> DataFrame:
    """The history after one load. Applying a load twice gives the same as applying it once.

    A changed member closes its current version on the day before ``effective_date`` and opens a
    new one; a change on the very day the current version began replaces that version; a change
    dated before it fails the job. Unchanged members and members the load does not mention stay as
    they are. The first version of a member is open from ``open_from``, so facts older than the
    first load still find it (``None`` opens it on ``effective_date``). Columns that are neither keys
    nor tracked are kept with the version they came with and open no version; a new one is NULL in
    older versions, and a load that lacks one raises.
    """
    keys, tracked = list(keys), list(tracked)
    day = F.lit(effective_date).cast("date")
    begin = day if open_from is None else F.lit(open_from).cast("date")
    own = ("effective_from", "effective_to", "is_current", "row_hash", surrogate)
    rest = [name for name in incoming.columns if name not in (*keys, *tracked, *own)]
    fresh = unique_rows(incoming.select(*keys, *tracked, *rest), keys, "history load")
    if target is None:
        return _first_versions(fresh, keys, tracked, rest, begin, surrogate)

    target = _widened(target, fresh, "history load", own)
    columns = [*keys, *tracked, *rest, "effective_from", "effective_to", "is_current", "row_hash", surrogate]
    closed = target.where(~F.col("is_current")).select(*columns)
    current = unique_rows(
        target.where("is_current").select(*columns), keys, "current versions"
    ).select(*keys, F.struct(*[c for c in columns if c not in keys]).alias("now"))
    offered = fresh.select(
        *keys, F.struct(*tracked, *rest, row_hash(tracked).alias("row_hash")).alias("new")
    )
    paired = current.join(offered, keys, "full")

    same = F.lit(True)
    for name in tracked:
        same = same & F.col(f"now.{name}").eqNullSafe(F.col(f"new.{name}"))
    changed = F.col("now").isNotNull() & F.col("new").isNotNull() & ~same
    in_place = changed & (F.col("now.effective_from") == day)
    paired = insist(
        paired,
        ~changed | (F.col("now.effective_from") <= day),
        f"history load dated {effective_date} precedes the current version",
    )

    def version(source: str, start: Column, end: Column, is_current: Column) -> Column:
        return F.struct(
            *[F.col(f"{source}.{name}").alias(name) for name in [*tracked, *rest]],
            start.alias("effective_from"),
            end.alias("effective_to"),
            is_current.alias("is_current"),
            F.col(f"{source}.row_hash").alias("row_hash"),
            version_key([F.col(k) for k in keys], start).alias(surrogate),
        )

    high = F.lit(HIGH_DATE).cast("date")
    untouched = F.struct(
        *[F.col(f"now.{c}").alias(c) for c in columns if c not in keys],
    )
    ended = version("now", F.col("now.effective_from"), F.date_sub(day, 1), F.lit(False))
    opened = version("new", day, high, F.lit(True))
    first = version("new", begin, high, F.lit(True))
    versions = (
        F.when(F.col("now").isNull(), F.array(first))
        .when(in_place, F.array(opened))
        .when(changed, F.array(ended, opened))
        .otherwise(F.array(untouched))
    )
    return closed.unionByName(
        paired.select(*keys, F.explode(versions).alias("v")).select(*keys, "v.*").select(*columns)
    )


def scd2_history(
    loads: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    loaded_on: str,
    surrogate: str = "location_key",
    open_from: str | None = LOW_DATE,
) -> DataFrame:
    """The history that any number of loads make, whatever order they came in.

    ``loads`` has a row for every member a load lists, with the day of the load in ``loaded_on``. A member
    keeps the attributes of a load until the day before the next load that lists others: neighbours that
    are equal are one version. The first is open from ``open_from`` (``None``: from its load), the last has no
    end. Columns that are neither keys nor tracked come from the first load of a version. A member twice in one load fails the
    job. One exchange by key; a key has as many rows as there are loads.
    """
    keys, tracked = list(keys), list(tracked)
    rest = [name for name in loads.columns if name not in (*keys, *tracked, loaded_on)]
    day = F.col(loaded_on).cast("date")
    listed = unique_rows(loads.withColumn(loaded_on, day), [*keys, loaded_on], "history loads")
    by_day = Window.partitionBy(*keys).orderBy(loaded_on)
    hashed = listed.withColumn("row_hash", row_hash(tracked))
    before = F.lag("row_hash").over(by_day)
    versions = hashed.withColumn("_before", before).where("_before IS NULL OR _before <> row_hash")
    following = F.lead(loaded_on).over(by_day)
    begin = F.col(loaded_on) if open_from is None else F.when(F.col("_before").isNull(), F.lit(open_from).cast("date")).otherwise(F.col(loaded_on))
    dated = versions.withColumns({"_following": following, "effective_from": begin})
    return dated.select(
        *keys,
        *tracked,
        *rest,
        "effective_from",
        F.coalesce(F.date_sub("_following", 1), F.lit(HIGH_DATE).cast("date")).alias("effective_to"),
        F.col("_following").isNull().alias("is_current"),
        "row_hash",
        version_key([F.col(k) for k in keys], F.col("effective_from")).alias(surrogate),
    )


def scd2_changes(
    current: DataFrame,
    load: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    day: str,
    surrogate: str = "location_key",
    open_from: str | None = LOW_DATE,
) -> DataFrame:
    """What a load later than all others does to the open versions: rows with ``_gone``.

    ``_gone`` marks versions as they were, which no longer hold; the others are new: the same ones with
    their end, those that begin on ``day``, and first versions of members that were not known.
    """
    keys, tracked = list(keys), list(tracked)
    own = ["effective_from", "effective_to", "is_current", "row_hash", surrogate]
    rest = [name for name in load.columns if name not in (*keys, *tracked)]
    columns = [*tracked, *rest, *own]
    now = _widened(current, load, "history load", own).select(*keys, F.struct(*columns).alias("now"))
    new = load.select(*keys, F.struct(*tracked, *rest, row_hash(tracked).alias("row_hash")).alias("new"))
    paired = new.join(now, keys, "left").where("now IS NULL OR now.row_hash <> new.row_hash")
    first, high = F.lit(day).cast("date"), F.lit(HIGH_DATE).cast("date")

    def version(source: str, start: Column, end: Column, open_: bool) -> list[Column]:
        kept = [F.col(f"{source}.{name}").alias(name) for name in (*tracked, *rest)]
        key = version_key([F.col(k) for k in keys], start)
        return [*kept, start.alias("effective_from"), end.alias("effective_to"), F.lit(open_).alias("is_current"), F.col(f"{source}.row_hash").alias("row_hash"), key.alias(surrogate)]

    was = F.struct(*[F.col(f"now.{name}").alias(name) for name in columns], F.lit(True).alias("_gone"))
    ended = F.struct(*version("now", F.col("now.effective_from"), F.date_sub(first, 1), False), F.lit(False).alias("_gone"))
    opened = F.struct(*version("new", first, high, True), F.lit(False).alias("_gone"))
    begun = F.struct(*version("new", first if open_from is None else F.lit(open_from).cast("date"), high, True), F.lit(False).alias("_gone"))
    rows = F.when(F.col("now").isNull(), F.array(begun)).otherwise(F.array(was, ended, opened))
    return paired.select(*keys, F.explode(rows).alias("v")).select(*keys, "v.*")


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that were ``added``, ``removed`` or ``changed`` between two snapshots.

    Only keys and a content hash travel: both snapshots are grouped together once, with partial
    aggregation, instead of being sorted and joined. Repeated keys are compared as a bag. The two
    halves of the hash are summed apart, which cannot overflow below two billion copies of a key.
    Snapshots with different columns raise.
    """
    if set(old.columns) != set(new.columns):
        raise ValueError(f"snapshots differ in {', '.join(sorted(set(old.columns) ^ set(new.columns)))}")
    compared = [name for name in new.columns if name not in keys]

    def side(df: DataFrame, mark: int) -> DataFrame:
        return df.select(*keys, content_hash(compared).alias("_hash"), F.lit(mark).alias("_new"))

    low = F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("_hash", 32)

    def balance(column: Column) -> Column:
        return F.sum(F.when(F.col("_new") == 1, column).otherwise(-column))

    merged = (
        side(old, 0)
        .unionByName(side(new, 1))
        .groupBy(*keys)
        .agg(
            F.count_if(F.col("_new") == 0).alias("_before"),
            F.count_if(F.col("_new") == 1).alias("_after"),
            balance(low).alias("_low"),
            balance(high).alias("_high"),
        )
    )
    change = (
        F.when(F.col("_before") == 0, F.lit("added"))
        .when(F.col("_after") == 0, F.lit("removed"))
        .when(
            (F.col("_before") != F.col("_after")) | (F.col("_low") != 0) | (F.col("_high") != 0),
            F.lit("changed"),
        )
    )
    return merged.select(*keys, change.alias("change")).where(F.col("change").isNotNull())
