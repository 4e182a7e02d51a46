"""Versioned tables: deltas by hash, expiry, full-scope merge, history reads.

A versioned table carries ``_keyhash _rowhash _valid_from _valid_until _valid_flag``. All
functions are pure: they return the complete new table (or a part of it) and leave writing
to :mod:`tidemark.sources.tables`. Rows that are already closed pass through without a
shuffle, so with the ``_valid_flag`` layout the cost follows the active part.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import clean_string_nulls
from tidemark.functions.clock import (
    FAR_FUTURE_MIDNIGHT,
    VALID_FLAG,
    VALID_FROM,
    VALID_UNTIL,
    close_at,
    hour_floor,
    stamp_scd,
    ts,
)
from tidemark.functions.hashing import KEYHASH, ROWHASH
from tidemark.operators.joins import join_unique, versions_not_in
from tidemark.operators.ordering import lag_in_key
from tidemark.session import checkpointed

VERSION = (KEYHASH, ROWHASH)


def _marked(df: DataFrame, cols: Sequence[str], mark: str) -> DataFrame:
    """Distinct values of ``cols`` with a marker column, for a left join."""
    return df.select(*cols).distinct().withColumn(mark, F.lit(True))


def _split_active(hist: DataFrame, source_col: str | None = None, source: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(active rows of the source, all other rows).

    Both predicates are plain comparisons that Parquet can use to skip row groups; a null
    flag or source counts as "other".
    """
    flag = F.col(VALID_FLAG)
    mine, others = flag, flag.isNull() | ~flag
    if source is not None:
        owner = F.col(source_col)
        mine = mine & (owner == source)
        others = others | owner.isNull() | (owner != source)
    return hist.where(mine), hist.where(others)


def _close(df: DataFrame, ended: Column, until: datetime, as_of: date | datetime) -> DataFrame:
    """End the versions for which ``ended`` holds."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = {
        VALID_UNTIL: F.when(ended, ts(until).cast(kinds[VALID_UNTIL])).otherwise(F.col(VALID_UNTIL)),
        VALID_FLAG: F.when(ended, F.lit(False)).otherwise(F.col(VALID_FLAG)),
    }
    if "_update_ts" in kinds:
        out["_update_ts"] = F.when(ended, ts(as_of).cast(kinds["_update_ts"])).otherwise(F.col("_update_ts"))
    return df.withColumns(out)


def hash_delta(today: DataFrame, hist: DataFrame, revert_aware: bool = False) -> DataFrame:
    """Rows of ``today`` that are new or changed against ``hist``.

    By default a row is sent when its key is unknown, or its row hash is unknown anywhere in
    the history; that equals "not (key known and row known)", so two joins with distinct
    hash sets replace the disjunction of NOT IN and IN. A value that goes A -> B -> A
    therefore sends nothing the third time; ``revert_aware=True`` compares with the active
    (key, row) pairs instead.
    """
    if revert_aware:
        return versions_not_in(today, current(hist))
    keys = _marked(hist, [KEYHASH], "_known_key")
    rows = _marked(hist, [ROWHASH], "_known_row")
    joined = join_unique(join_unique(today, keys, [KEYHASH]), rows, [ROWHASH])
    return joined.where(F.col("_known_key").isNull() | F.col("_known_row").isNull()).select(*today.columns)


def expire_superseded(
    hist: DataFrame, today: DataFrame, as_of: date | datetime, close: str = "day"
) -> DataFrame:
    """``hist`` with active versions closed whose key is in ``today`` with other content.

    Keys that vanished from ``today`` stay active; :func:`scd2_merge` closes those.
    """
    opened, others = _split_active(hist)
    keys = _marked(today, [KEYHASH], "_key_seen")
    rows = _marked(today, VERSION, "_row_seen")
    active = join_unique(join_unique(opened, keys, [KEYHASH]), rows, VERSION)
    ended = F.col("_key_seen").isNotNull() & F.col("_row_seen").isNull()
    closed = _close(active, ended, close_at(as_of, close), as_of).select(*hist.columns)
    return others.unionByName(closed)


def delta_cycle(
    today: DataFrame, hist: DataFrame, as_of: date | datetime, revert_aware: bool = False, close: str = "day"
) -> tuple[DataFrame, DataFrame]:
    """(delta, new history): delta against the previous history, append, then expire.

    Both results are planned from the same immutable inputs, so the history cannot move
    between sending and appending. Rows of the delta are today's own and never end here, so
    only the old history is searched for ended versions.
    """
    delta = hash_delta(today, hist, revert_aware)
    return delta, expire_superseded(hist, today, as_of, close).unionByName(delta.select(*hist.columns))


def delta_changes(
    today: DataFrame, hist: DataFrame, as_of: date | datetime, revert_aware: bool = False, close: str = "day"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(delta, newly closed, active afterwards): a delta cycle for :func:`tables.update_scd`.

    Of the closed part of ``hist`` only the hashes are read.
    """
    delta = hash_delta(today, hist, revert_aware)
    judged = expire_superseded(current(hist), today, as_of, close)
    ended = ~F.col(VALID_FLAG)
    return delta, judged.where(ended), judged.where(~ended).unionByName(delta.select(*hist.columns))


def in_scope(hist: DataFrame, staging: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Rows of ``hist`` whose scope values occur in ``staging``."""
    return join_unique(hist, staging.select(*scope).distinct(), scope, "left_semi").select(*hist.columns)


def scd2_merge(
    hist: DataFrame,
    staging: DataFrame,
    as_of: date | datetime,
    scope: Sequence[str] = ("original_request", "iso_code"),
    source: str | None = None,
    source_col: str = "_sourcesystem",
    close: str = "hour",
    far_future: datetime = FAR_FUTURE_MIDNIGHT,
    clean: Sequence[str] = (),
) -> DataFrame:
    """The complete table after a full-scope merge.

    Active rows of ``source`` are closed when their scope occurs in ``staging`` and their
    (key, row) pair does not: they changed or vanished. Staging rows whose pair is not
    active open as new versions. Rows out of scope, of other sources (manual overrides) and
    closed ones stay as they are. ``clean`` names columns in which null texts become nulls
    on insert.
    """
    active, others = _split_active(hist, source_col, source)
    untouched, updated, opened = _merged(active, staging, as_of, scope, close, far_future, clean)
    return others.unionByName(untouched).unionByName(updated).unionByName(opened)


def scd2_changes(
    active: DataFrame,
    staging: DataFrame,
    as_of: date | datetime,
    scope: Sequence[str] = ("original_request", "iso_code"),
    source: str | None = None,
    source_col: str = "_sourcesystem",
    close: str = "hour",
    far_future: datetime = FAR_FUTURE_MIDNIGHT,
    clean: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(newly closed, active afterwards): :func:`scd2_merge` for :func:`tables.update_scd`.

    ``active`` holds the active rows only; closed ones are neither read nor written again.
    Both results need the rows in scope after judging; these are computed once.
    """
    mine, others = _split_active(active, source_col, source)
    untouched, updated, opened = _merged(mine, staging, as_of, scope, close, far_future, clean)
    updated, ended = checkpointed(updated), ~F.col(VALID_FLAG)
    kept = others.unionByName(untouched).unionByName(updated.where(~ended))
    return updated.where(ended), kept.unionByName(opened)


def _merged(
    active: DataFrame,
    staging: DataFrame,
    as_of: date | datetime,
    scope: Sequence[str],
    close: str,
    far_future: datetime,
    clean: Sequence[str],
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(active rows out of scope; those in scope, closed where they ended; rows that open).

    The scopes are few and written first, so their size is known when the join is planned and
    only rows in scope are shuffled to meet their pair in ``staging``.
    """
    scopes = checkpointed(_marked(staging, scope, "_in_scope"))
    placed = join_unique(active, scopes, scope)
    untouched = placed.where(F.col("_in_scope").isNull()).select(*active.columns)
    judged = placed.where(F.col("_in_scope").isNotNull()).select(*active.columns)
    judged = join_unique(judged, _marked(staging, VERSION, "_still_there"), VERSION)
    updated = _close(judged, F.col("_still_there").isNull(), close_at(as_of, close), as_of).select(*active.columns)

    # Not reduced to distinct pairs first: a pair is active once, and that would shuffle them twice.
    fresh = join_unique(staging, active.select(*VERSION), VERSION, "left_anti").select(*staging.columns)
    if clean:
        fresh = clean_string_nulls(fresh, clean)
    opened = stamp_scd(fresh, hour_floor(as_of), far_future)
    kinds = {f.name: f.dataType for f in active.schema.fields}
    return untouched, updated, opened.select(*[F.col(c).cast(kinds[c]).alias(c) for c in active.columns])


def current(hist: DataFrame) -> DataFrame:
    """Active versions."""
    return hist.where(F.col(VALID_FLAG))


def as_of_view(hist: DataFrame, at: date | datetime) -> DataFrame:
    """Versions valid at a moment: from <= moment < until."""
    return hist.where((F.col(VALID_FROM) <= ts(at)) & (F.col(VALID_UNTIL) > ts(at)))


def history(hist: DataFrame, key: str) -> DataFrame:
    """All versions of one key, oldest first."""
    return hist.where(F.col(KEYHASH) == key).orderBy(VALID_FROM)


def recently_closed(hist: DataFrame, as_of: date | datetime, days: int = 7) -> DataFrame:
    """Versions closed in the last ``days``, newest first."""
    since = ts(as_of) - F.make_dt_interval(days=F.lit(days))
    return hist.where(~F.col(VALID_FLAG) & (F.col(VALID_UNTIL) >= since)).orderBy(F.col(VALID_UNTIL).desc())


def closed_count(hist: DataFrame, as_of: date | datetime, days: int = 1) -> DataFrame:
    """How many versions were closed in the last ``days``."""
    since = ts(as_of) - F.make_dt_interval(days=F.lit(days))
    closed = hist.where(~F.col(VALID_FLAG) & (F.col(VALID_UNTIL) >= since))
    return closed.agg(F.count(F.lit(1)).alias("deleted_count"))


def quality_deltas(hist: DataFrame, column: str = "match_quality", order: Sequence[str] = (VALID_FROM,), unique: bool = False) -> DataFrame:
    """Each version with the previous version's value and the difference to it."""
    stepped = lag_in_key(hist, [KEYHASH], list(order), column, "prev_quality", unique)
    return stepped.withColumn("quality_delta", F.col(column) - F.col("prev_quality"))


def repair_duplicates(hist: DataFrame) -> DataFrame:
    """Close all but the newest active version per key, at their own start.

    Active versions that share the newest start stay, since neither is older.
    """
    opened, others = _split_active(hist)
    newest = opened.groupBy(KEYHASH).agg(F.max(VALID_FROM).alias("_newest"))
    active = join_unique(opened, newest, [KEYHASH])
    older = F.col(VALID_FROM) < F.col("_newest")
    demoted = active.withColumns(
        {
            VALID_UNTIL: F.when(older, F.col(VALID_FROM)).otherwise(F.col(VALID_UNTIL)),
            VALID_FLAG: F.when(older, F.lit(False)).otherwise(F.col(VALID_FLAG)),
        }
    )
    return others.unionByName(demoted.select(*hist.columns))


demote_older = repair_duplicates
