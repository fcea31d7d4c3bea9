"""History of a source that is overwritten in place: every change of a row closes its version and opens a new one."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks import fixed_values as fixed
from martworks.functions.dates import moment
from martworks.operators.columns import quoted
from martworks.sources.tables import new_version, partition_values, version_of

BOOKKEEPING = (fixed.VERSION_ID, fixed.UPDATED_AT, fixed.VALID_FROM, fixed.VALID_TO)


def _versions(source: DataFrame, key: Sequence[str], start: Column) -> DataFrame:
    """Source rows as versions that begin at `start` and are open."""
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in (*(quoted(k) for k in key), start)]
    return source.withColumns({
        fixed.VERSION_ID: F.md5(F.concat_ws("|", *texts)),
        fixed.UPDATED_AT: start,
        fixed.VALID_FROM: start,
        fixed.VALID_TO: F.lit(None).cast(source.select(start.alias("s")).schema["s"].dataType),
    })


def snapshot(
    history: DataFrame | None,
    source: DataFrame,
    key: Sequence[str],
    updated_at: str | None = None,
    check_cols: Sequence[str] | str | None = None,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """The next state of the history. Pass `history=None` on the first run.

    A row counts as changed when its `updated_at` is later than the stored one, or, with `check_cols` (a list, or
    `"all"`), when one of those columns differs; then `as_of` (now unless given) is the moment of change. Rows missing
    from the source keep their open version. `key` must be unique in the source; nulls in it are equal. A column that the
    source gained is null in the versions before; a lost one is refused.

    Closed versions take no part in the join; only open versions and source rows are shuffled. `snapshot_table` keeps a history that
    is written by changes only."""
    start = _start(updated_at, check_cols, as_of)
    fresh = _versions(source, key, start)
    if history is None:
        return fresh
    history = _widened(history, source, fresh)
    is_open = quoted(fixed.VALID_TO).isNull()
    return history.filter(~is_open).unionByName(_following(history.filter(is_open), source, fresh, key, updated_at, check_cols))


def _start(updated_at: str | None, check_cols, as_of) -> Column:
    if (updated_at is None) == (check_cols is None):
        raise ValueError("snapshot: pass updated_at or check_cols")
    return quoted(updated_at) if updated_at else F.current_timestamp() if as_of is None else moment(as_of)


def _widened(history: DataFrame, source: DataFrame, fresh: DataFrame) -> DataFrame:
    """The history with the columns that the source gained."""
    gained, lost = set(fresh.columns) - set(history.columns), set(history.columns) - set(fresh.columns)
    if lost:
        raise ValueError(f"snapshot: the source has lost columns {sorted(lost)}")
    for name in source.columns:
        if name in gained:
            history = history.withColumn(name, F.lit(None).cast(source.schema[name].dataType))
    return history


def _following(open_versions: DataFrame, source: DataFrame, fresh: DataFrame, key, updated_at, check_cols) -> DataFrame:
    """What becomes of the open versions: kept, or closed and followed by a new one; and versions of new rows."""
    columns = open_versions.columns
    types = {f.name: f.dataType for f in open_versions.schema.fields}
    fresh = fresh.select(*(quoted(c).cast(types[c]).alias(c) for c in columns))
    old = open_versions.select(F.struct(*(quoted(c) for c in columns)).alias("old"))
    new = fresh.select(F.struct(*(quoted(c) for c in columns)).alias("new"))
    same_key = reduce(Column.__and__, (F.col("old").getField(k).eqNullSafe(F.col("new").getField(k)) for k in key))

    def pair(name: str) -> tuple[Column, Column]:
        return F.col("old").getField(name), F.col("new").getField(name)

    if updated_at:
        before, after = pair(fixed.UPDATED_AT)
        differs = F.coalesce(after > before, F.lit(False))
    else:
        names = [c for c in source.columns if c not in key] if check_cols == "all" else list(check_cols)
        differs = reduce(Column.__or__, (~a.eqNullSafe(b) for a, b in map(pair, names)), F.lit(False))
    changed = F.col("old").isNotNull() & F.col("new").isNotNull() & differs

    closed = F.col("old").withField(fixed.VALID_TO, F.col("new").getField(fixed.VALID_FROM))
    kept = F.when(changed, closed).otherwise(F.col("old"))
    opened = F.when(F.col("old").isNull() | changed, F.col("new"))
    return old.join(new, same_key, "full").select(F.inline(F.array_compact(F.array(kept, opened))))


# The hidden column of a history table: the run that closed a version, or `open`.
CLOSED_BY, OPEN = "_martworks_closed_by", "open"


def snapshot_table(
    source: DataFrame, name: str, folder: str, key: Sequence[str], updated_at: str | None = None,
    check_cols: Sequence[str] | str | None = None, as_of: datetime | Column | None = None,
) -> DataFrame:
    """`snapshot`, kept as catalog table `name` under `folder`: created by the first run, brought up to date by later ones.

    The table is partitioned by the run that closed a version. A run reads and writes the open versions, adds those that it closes as a
    partition of their own, and takes all that were closed before over where they are. Readers see the table before or after a run."""
    spark = source.sparkSession
    fresh = _versions(source, key, _start(updated_at, check_cols, as_of))
    closed_by = lambda run: F.when(quoted(fixed.VALID_TO).isNull(), OPEN).otherwise(run)
    if not spark.catalog.tableExists(name):
        return new_version(fresh.withColumn(CLOSED_BY, closed_by("first")), name, folder, [CLOSED_BY], hidden=CLOSED_BY)
    version = version_of(spark, name)
    before = spark.table(version)
    open_versions = before.filter(quoted(CLOSED_BY) == OPEN).drop(CLOSED_BY)
    following = _following(_widened(open_versions, source, fresh), source, fresh, key, updated_at, check_cols)
    closed = [value for value in partition_values(spark, version) if value != OPEN]
    run = f"run{len(closed)}-{uuid.uuid4().hex[:8]}"
    return new_version(following.withColumn(CLOSED_BY, closed_by(run)), name, folder, [CLOSED_BY], hidden=CLOSED_BY, kept=closed)


def current(history: DataFrame) -> DataFrame:
    """Open versions: today's picture."""
    return history.filter(quoted(fixed.VALID_TO).isNull())


def as_of(history: DataFrame, when: datetime | Column) -> DataFrame:
    """Versions valid at a moment, both ends of a validity range included: at the very moment of a change the closed
    and the new version both show."""
    at = moment(when)
    end = F.coalesce(quoted(fixed.VALID_TO), F.lit(fixed.OPEN_END).cast(history.schema[fixed.VALID_TO].dataType))
    return history.filter((quoted(fixed.VALID_FROM) <= at) & (end >= at))
