"""Join shapes the jobs share.

No join here carries a broadcast hint for caller data: the optimizer broadcasts a side
only where its size is known to be small, and otherwise shuffles. The looked-up side is
reduced to one row per key first, so a hot key meets one partner row.

Hot keys of the other side are split at run time (adaptive skew join). Spark can do that
only where both sides of a join are fresh shuffles; a side that was grouped by the join key
would be joined in place, and the hot partition would stay one task. :func:`join_unique`
therefore joins on a hash of the keys as well: one more shuffle of the reduced side buys
the split of the large one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def trimmed(col: str) -> Column:
    return F.trim(F.col(col))


def unique_lookup(dim: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """One row per key: the smallest value. Null keys can match nothing and are left out."""
    known = dim
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    return known.groupBy(*keys).agg(F.min(value).alias(out))


def route(*keys: Column | str) -> Column:
    return F.xxhash64(*keys)


def join_unique(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join with a side that was grouped by ``keys``, leaving hot keys of ``df`` splittable."""
    return (
        df.withColumn("_route", route(*keys))
        .join(side.withColumn("_route", route(*keys)), ["_route", *keys], how)
        .drop("_route")
    )


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    value: str,
    out: str,
    default=None,
) -> DataFrame:
    """Left lookup of one value by one or more key pairs ``(df column, dim column)``."""
    found = unique_lookup(dim, [d for _, d in on], value, "_found")
    side = found.select(
        *[F.col(d).alias(f"_dim_{i}") for i, (_, d) in enumerate(on)],
        "_found",
        route(*[d for _, d in on]).alias("_dim_route"),
    )
    cond = route(*[k for k, _ in on]) == F.col("_dim_route")
    for i, (left, _) in enumerate(on):
        cond = cond & (F.col(left) == F.col(f"_dim_{i}"))
    joined = df.join(side, cond, "left")
    value_or = F.col("_found") if default is None else F.coalesce(F.col("_found"), F.lit(default))
    return joined.withColumn(out, value_or).drop("_found", "_dim_route", *[f"_dim_{i}" for i in range(len(on))])


def fallback_lookup(
    df: DataFrame, key: str, lookups: Sequence[tuple[DataFrame, str, str]], out: str
) -> tuple[DataFrame, DataFrame]:
    """(resolved, rejected): the first of ``lookups`` (dim, key column, value column) that
    knows the key gives the value; rows none of them knows carry a reason."""
    tried = []
    for i, (dim, dim_key, value) in enumerate(lookups):
        df = lookup(df, dim, [(key, dim_key)], value, f"_try_{i}")
        tried.append(f"_try_{i}")
    found = df.withColumn(out, F.coalesce(*[F.col(t) for t in tried])).drop(*tried)
    rejected = found.where(F.col(out).isNull()).withColumn(
        REASON, F.concat(F.lit(f"could not resolve {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    )
    return found.where(F.col(out).isNotNull()), rejected.drop(out)


def array_lookup(
    df: DataFrame,
    row_key: Sequence[str],
    array_col: str,
    dim: DataFrame,
    on: str,
    value: str,
    out: str,
    unresolved: str | None = None,
) -> DataFrame:
    """Look up every element of an array column, keeping the array's order.

    Unknown elements vanish from ``out``; ``unresolved`` counts them. ``row_key`` must tell
    the rows apart. An array is put together again per row, so no group outgrows the row it
    came from.
    """
    side = unique_lookup(dim, [on], value, "_value").select(F.col(on).alias("_element"), "_value")
    elements = df.select(*row_key, F.posexplode(array_col).alias("_element_no", "_element"))
    found = join_unique(elements, side, ["_element"])
    rebuilt = found.groupBy(*row_key).agg(
        F.sort_array(
            F.collect_list(F.when(F.col("_value").isNotNull(), F.struct("_element_no", "_value")))
        ).alias("_values"),
        F.count(F.when(F.col("_value").isNull(), 1)).alias("_unknown"),
    )
    joined = null_safe_join(df, rebuilt, row_key, "left")
    kind = dim.schema[value].dataType.simpleString()
    values = F.transform(F.col("_values"), lambda s: s["_value"])
    result = joined.withColumn(out, F.coalesce(values, F.array().cast(f"array<{kind}>")))
    if unresolved is not None:
        result = result.withColumn(unresolved, F.coalesce(F.col("_unknown"), F.lit(0)))
    return result.drop("_values", "_unknown")


def null_safe_join(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; still a hash or sort-merge join.

    ``how`` is inner, left, left_semi or left_anti. Keys come from ``a``.
    """
    renamed = b.withColumnsRenamed({k: f"_rhs_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_rhs_{k}"))
    return a.join(renamed, cond, how).drop(*[f"_rhs_{k}" for k in keys])


def full_outer_coalesce(a: DataFrame, b: DataFrame, key: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """Full outer join on ``key``; ``attrs`` exist on both sides and ``a`` wins.

    Written as left join plus anti join: a hot key of a full outer join cannot be split at
    run time, one of a left or anti join can.
    """
    only_a = [c for c in a.columns if c not in key and c not in attrs]
    only_b = [c for c in b.columns if c not in key and c not in attrs]
    rhs = b.withColumnsRenamed({c: f"_rhs_{c}" for c in attrs})
    left = a.join(rhs, list(key), "left").select(
        *key, *[F.coalesce(F.col(c), F.col(f"_rhs_{c}")).alias(c) for c in attrs], *only_a, *only_b
    )
    types = {f.name: f.dataType for f in a.schema.fields}
    rest = join_unique(b, a.select(*key).distinct(), list(key), "left_anti").select(
        *key, *attrs, *[F.lit(None).cast(types[c]).alias(c) for c in only_a], *only_b
    )
    return left.unionByName(rest)


def price_lookup(
    lines: DataFrame,
    prices: DataFrame,
    on: Sequence[tuple[str, str]],
    at: str,
    start: str,
    end: str,
    values: dict[str, str],
    pick: str | None = None,
    line_id: Sequence[str] = (),
) -> DataFrame:
    """Left lookup of the price valid on a line's date (both ends included).

    ``on`` pairs line columns with price columns (product, fee type, ...); ``values`` maps
    price columns to new names. The equality keys make it a hash or sort-merge join with
    the period as a residual condition. Lines without a price keep nulls. Overlapping
    periods give several rows, unless ``pick="latest_start"`` keeps the price that started
    last (``line_id`` must then tell the lines apart).
    """
    side = prices.select(
        *[F.col(p).alias(f"_price_{i}") for i, (_, p) in enumerate(on)],
        F.col(start).alias("_start"),
        F.col(end).alias("_end"),
        *[F.col(v).alias(n) for v, n in values.items()],
    )
    cond = F.col(at).between(F.col("_start"), F.col("_end"))
    for i, (line, _) in enumerate(on):
        cond = (F.col(line) == F.col(f"_price_{i}")) & cond
    helpers = [f"_price_{i}" for i in range(len(on))] + ["_start", "_end"]
    if pick is None:
        return lines.join(side, cond, "left").drop(*helpers)
    if pick != "latest_start":
        raise ValueError(f"unknown pick {pick!r}")
    # A price's periods become one array per key, so a line meets one row and is neither grouped nor joined back.
    keys = [f"_price_{i}" for i in range(len(on))]
    known = side.where(F.col("_start") <= F.col("_end"))
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    periods = known.groupBy(*keys).agg(F.collect_set(F.struct("_start", "_end", *values.values())).alias("_periods"))
    periods = periods.withColumn("_price_route", route(*keys))
    here = route(*[line for line, _ in on]) == F.col("_price_route")
    for k, (line, _) in zip(keys, on):
        here = here & (F.col(line) == F.col(k))
    joined = lines.join(periods, here, "left")
    valid = F.filter("_periods", lambda p: F.col(at).between(p["_start"], p["_end"]))
    hit = F.array_max(valid)
    return joined.withColumns({n: hit[n] for n in values.values()}).drop("_periods", "_price_route", *keys)


def unseen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``seen``. Null keys are dropped on both sides, always."""
    known = seen.where(F.col(key).isNotNull()).select(key).distinct()
    return join_unique(df.where(F.col(key).isNotNull()), known, [key], "left_anti").select(*df.columns)


def skip_loaded(df: DataFrame, loaded: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows whose natural key is not loaded yet; of copies inside ``df`` the first wins."""
    from tidemark.operators.select import first_by

    return first_by(unseen(df, loaded, key), [key], order)


def restrict_dim(
    dim: DataFrame, dim_key: str, batch: DataFrame, id_cols: Sequence[str], suffixes: Sequence[str] = ()
) -> DataFrame:
    """Dimension rows whose key is one of the ids in a batch (or id + suffix)."""
    ids = F.array(*[F.col(c).cast("string") for c in id_cols])
    endings = F.array(*[F.lit(s) for s in ("", *suffixes)])
    ids = F.flatten(F.transform(endings, lambda end: F.transform(ids, lambda i: F.concat(i, end))))
    wanted = batch.select(F.explode(ids).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    keyed = dim.withColumn("_id", F.col(dim_key).cast("string"))
    return join_unique(keyed, wanted, ["_id"], "left_semi").select(*dim.columns)


def propagate_active(
    df: DataFrame, group: Sequence[str], member: Sequence[str], flag: Column, out: str
) -> DataFrame:
    """True where any member of the row's group is active anywhere in ``df``.

    A member is active when one of its rows satisfies ``flag``; null members and groups
    count as values of their own.
    """
    active = df.where(flag).select(*member).distinct()
    members = df.select(*dict.fromkeys([*group, *member])).distinct()
    groups = null_safe_join(members, active, member, "left_semi").select(*group).distinct()
    marked = null_safe_join(df, groups.withColumn("_hit", F.lit(True)), group, "left")
    return marked.withColumn(out, F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")


def versions_not_in(a: DataFrame, b: DataFrame, cols: Sequence[str] = ("_keyhash", "_rowhash")) -> DataFrame:
    """Rows of ``a`` whose (key, row) pair ``b`` does not hold."""
    return join_unique(a, b.select(*cols).distinct(), list(cols), "left_anti").select(*a.columns)


def keys_in(a: DataFrame, b: DataFrame, col: str = "_keyhash") -> DataFrame:
    """Rows of ``a`` whose key ``b`` holds."""
    return join_unique(a, b.select(col).distinct(), [col], "left_semi").select(*a.columns)
