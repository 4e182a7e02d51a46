"""Checks over a versioned table and its staging, each as one row of one report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import VALID_UNTIL, ts
from tidemark.functions.hashing import KEYHASH, ROWHASH
from tidemark.operators.joins import join_unique
from tidemark.operators.scd import current

# Thresholds of the quality alert.
LOW_QUALITY = 0.70
MIN_AVERAGE = 0.75
MAX_LOW_SHARE = 0.05


def duplicate_keys(hist: DataFrame) -> DataFrame:
    """Keys with more than one active version."""
    counted = current(hist).groupBy(KEYHASH).agg(F.count(F.lit(1)).alias("duplicate_count"))
    return counted.where(F.col("duplicate_count") > 1)


def quality_profile(
    hist: DataFrame,
    column: str = "match_quality",
    low: float = LOW_QUALITY,
    min_average: float = MIN_AVERAGE,
    max_low_share: float = MAX_LOW_SHARE,
    higher_is_better: bool = True,
) -> DataFrame:
    """Average, worst value, number and share of weak rows among active versions, alert.

    Some engines score 0..1 (higher is better), others by distance (lower is better);
    ``higher_is_better`` gives the direction of all three thresholds.
    """
    value = F.col(column)
    weak = value < F.lit(low) if higher_is_better else value > F.lit(low)
    worst = F.min(value) if higher_is_better else F.max(value)
    out = current(hist).agg(
        F.avg(value).alias("avg_quality"),
        worst.alias("min_quality" if higher_is_better else "max_quality"),
        F.count(F.when(weak, 1)).alias("low_quality_count"),
        F.try_divide(F.count(F.when(weak, 1)), F.count(F.lit(1))).alias("low_quality_share"),
    )
    avg = F.col("avg_quality")
    poor = avg < F.lit(min_average) if higher_is_better else avg > F.lit(min_average)
    return out.withColumn("alert", poor | (F.col("low_quality_share") > F.lit(max_low_share)))


def history_gaps(hist: DataFrame, as_of: date | datetime) -> DataFrame:
    """Keys whose last version ended before ``as_of``: no current version."""
    spans = hist.groupBy(KEYHASH).agg(
        F.count(F.lit(1)).alias("version_count"), F.max(VALID_UNTIL).alias("latest_valid_until")
    )
    return spans.where(F.col("latest_valid_until") < ts(as_of))


def orphans(hist: DataFrame, id_col: str, source: DataFrame, source_key: str) -> DataFrame:
    """Active versions that point to an id the source does not hold."""
    known = source.select(F.col(source_key).alias(id_col)).where(F.col(id_col).isNotNull()).distinct()
    return join_unique(current(hist).where(F.col(id_col).isNotNull()), known, [id_col], "left_anti")


def dq_report(
    hist: DataFrame,
    staging: DataFrame,
    as_of: date | datetime,
    sources: Sequence[tuple[str, DataFrame, str]] = (),
    quality: str = "match_quality",
) -> DataFrame:
    """One row per check: ``check_name, value, threshold, passed``.

    ``sources`` lists (id column of the history, source table, its key).
    """
    def row(name: str, df: DataFrame, value, threshold, passed) -> DataFrame:
        return df.select(
            F.lit(name).alias("check_name"),
            value.cast("double").alias("value"),
            threshold.cast("double").alias("threshold"),
            passed.alias("passed"),
        )

    def none_of(name: str, df: DataFrame) -> DataFrame:
        n = df.agg(F.count(F.lit(1)).alias("n"))
        return row(name, n, F.col("n"), F.lit(0), F.col("n") == 0)

    profile = quality_profile(hist, quality)
    staged = staging.select(F.lit(1).alias("s"), F.lit(0).alias("a"))
    active = current(hist).select(F.lit(0).alias("s"), F.lit(1).alias("a"))
    counts = staged.unionAll(active).agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("s"), F.coalesce(F.sum("a"), F.lit(0)).alias("a")
    )
    checks = [
        row("row_count", counts, F.col("a"), F.col("s"), F.col("a") == F.col("s")),
        row("average_quality", profile, F.col("avg_quality"), F.lit(MIN_AVERAGE), F.col("avg_quality") >= MIN_AVERAGE),
        row("low_quality_share", profile, F.col("low_quality_share"), F.lit(MAX_LOW_SHARE), F.col("low_quality_share") <= MAX_LOW_SHARE),
        none_of("duplicate_active_keys", duplicate_keys(hist)),
        none_of("history_gaps", history_gaps(hist, as_of)),
    ]
    for id_col, source, key in sources:
        checks.append(none_of(f"orphans_{id_col}", orphans(hist, id_col, source, key)))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def change_summary(staging: DataFrame, hist: DataFrame, quality: str | None = None) -> DataFrame:
    """Rows per change class against the active versions: new, changed, unchanged, deleted."""
    active = current(hist)
    keys = active.select(KEYHASH).distinct().withColumn("_k", F.lit(True))
    pairs = active.select(KEYHASH, ROWHASH).distinct().withColumn("_p", F.lit(True))
    value = F.lit(None).cast("double") if quality is None else F.col(quality).cast("double")
    staged = (
        join_unique(join_unique(staging, pairs, [KEYHASH, ROWHASH]), keys, [KEYHASH])
        .select(
            F.when(F.col("_p"), "unchanged").when(F.col("_k"), "changed").otherwise("new").alias("change"),
            value.alias("q"),
        )
    )
    gone = join_unique(active, staging.select(KEYHASH).distinct(), [KEYHASH], "left_anti").select(
        F.lit("deleted").alias("change"), value.alias("q")
    )
    return staged.unionByName(gone).groupBy("change").agg(
        F.count(F.lit(1)).alias("n"), F.avg("q").alias("avg_quality")
    )
