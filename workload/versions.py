"""Version tables derived from customer and orders.

Which rows are new, changed or gone follows from their own attributes:

* customer snapshot: customers in debt are gone, BUILDING ones have 100 more;
* customer history: rich FURNITURE customers are not known yet, MACHINERY ones also have
  an older, closed version;
* order history and staging: see the functions.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import VALID_FLAG, VALID_FROM, VALID_UNTIL, ts
from tidemark.functions.hashing import with_hashes
from tidemark.operators import quality, scd
from tidemark.sources import tables
from workload.base import ORACLES, Tables, fresh_folder, query

AS_OF = datetime(2001, 8, 1, 10, 30)

CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def hashed_customers(df: DataFrame) -> DataFrame:
    return with_hashes(df, ["c_custkey"], CUSTOMER)


def versioned(df: DataFrame, start: datetime, end: datetime, flag: bool) -> DataFrame:
    return df.withColumns({VALID_FROM: ts(start), VALID_UNTIL: ts(end), VALID_FLAG: F.lit(flag)})


def customer_today(t: Tables) -> DataFrame:
    raised = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal"))
    today = hashed_customers(t.customer.where(F.col("c_acctbal") >= 0).withColumn("c_acctbal", raised))
    return versioned(today, AS_OF, datetime(2099, 12, 31, 23, 59, 59), True)


def customer_hist(t: Tables) -> DataFrame:
    known = t.customer.where((F.col("c_mktsegment") != "FURNITURE") | (F.col("c_acctbal") <= 5000))
    active = versioned(hashed_customers(known), datetime(2000, 1, 1), datetime(2099, 12, 31, 23, 59, 59), True)
    before = t.customer.where(F.col("c_mktsegment") == "MACHINERY").withColumn("c_acctbal", F.col("c_acctbal") - 1)
    closed = versioned(hashed_customers(before), datetime(1999, 1, 1), datetime(1999, 12, 31, 23, 59, 59), False)
    return active.unionByName(closed)


CUSTOMER_HASHES = """
md5(cast(c_custkey as varchar)) as _keyhash,
md5(c_custkey || '|' || c_name || '|' || c_nationkey || '|' || cast(cast(c_acctbal as decimal(38,4)) as varchar) || '|' || c_mktsegment) as _rowhash
"""

CUSTOMER_CTES = f"""
today_rows as (
  select c_custkey, c_name, c_nationkey,
         case when c_mktsegment = 'BUILDING' then c_acctbal + 100 else c_acctbal end as c_acctbal, c_mktsegment
  from customer where c_acctbal >= 0),
today as (select *, {CUSTOMER_HASHES}, timestamp '2001-08-01 10:30:00' as _valid_from,
         timestamp '2099-12-31 23:59:59' as _valid_until, true as _valid_flag from today_rows),
older_rows as (select c_custkey, c_name, c_nationkey, c_acctbal - 1 as c_acctbal, c_mktsegment
  from customer where c_mktsegment = 'MACHINERY'),
hist as (
  select *, {CUSTOMER_HASHES}, timestamp '2000-01-01' as _valid_from, timestamp '2099-12-31 23:59:59' as _valid_until, true as _valid_flag
  from customer where c_mktsegment <> 'FURNITURE' or c_acctbal <= 5000
  union all
  select *, {CUSTOMER_HASHES}, timestamp '1999-01-01', timestamp '1999-12-31 23:59:59', false from older_rows)
"""

LITERAL_DELTA = """
select * from today
where _keyhash not in (select _keyhash from hist)
   or (_keyhash in (select _keyhash from hist) and _rowhash not in (select _rowhash from hist))
"""

EXPIRED = """
select * exclude (_valid_until, _valid_flag),
  case when gone then timestamp '2001-07-31 23:59:59' else _valid_until end as _valid_until,
  case when gone then false else _valid_flag end as _valid_flag
from (select h.*, _valid_flag and _keyhash in (select _keyhash from today)
        and (_keyhash || _rowhash) not in (select _keyhash || _rowhash from today) as gone
      from {source} h)
"""


@query("keyhash_rowhash", f"select c_custkey, {CUSTOMER_HASHES} from customer")
def keyhash_rowhash(t: Tables) -> DataFrame:
    return hashed_customers(t.customer).select("c_custkey", "_keyhash", "_rowhash")


@query("hash_delta_customers", f"with {CUSTOMER_CTES} {LITERAL_DELTA}")
def hash_delta_customers(t: Tables) -> DataFrame:
    return scd.hash_delta(customer_today(t), customer_hist(t))


@query(
    "hash_delta_revert_aware",
    f"with {CUSTOMER_CTES} select * from today where not exists (select 1 from hist h"
    " where h._valid_flag and h._keyhash = today._keyhash and h._rowhash = today._rowhash)",
)
def hash_delta_revert_aware(t: Tables) -> DataFrame:
    return scd.hash_delta(customer_today(t), customer_hist(t), revert_aware=True)


@query(
    "expire_superseded_customers",
    f"with {CUSTOMER_CTES} select * exclude (gone) from ({EXPIRED.format(source='hist')})",
)
def expire_superseded_customers(t: Tables) -> DataFrame:
    return scd.expire_superseded(customer_hist(t), customer_today(t), AS_OF)


@query(
    "delta_cycle_hist",
    f"with {CUSTOMER_CTES}, delta as ({LITERAL_DELTA}), appended as (select * from hist union all by name select * from delta)"
    f" select * exclude (gone) from ({EXPIRED.format(source='appended')})",
)
def delta_cycle_hist(t: Tables) -> DataFrame:
    _, hist = scd.delta_cycle(customer_today(t), customer_hist(t), AS_OF)
    return hist


@query(
    "small_change_sent",
    "select o_orderkey from orders where o_orderpriority = '1-URGENT'",
)
def small_change_sent(t: Tables) -> DataFrame:
    """Scores that moved by three hundred-thousandths are new versions, all others are known."""
    scored = t.orders.select("o_orderkey", "o_orderpriority", (F.col("o_totalprice") / 500000).alias("q"))
    moved = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("q") + 0.00003).otherwise(F.col("q"))
    today = with_hashes(scored.withColumn("q", moved), ["o_orderkey"], ["o_orderkey", "q"])
    return scd.hash_delta(today, with_hashes(scored, ["o_orderkey"], ["o_orderkey", "q"])).select("o_orderkey")


@query(
    "stored_delta_cycles",
    f"with {CUSTOMER_CTES}, delta as ({LITERAL_DELTA}), appended as (select * from hist union all by name select * from delta)"
    f" select * exclude (gone) from ({EXPIRED.format(source='appended')})",
)
def stored_delta_cycles(t: Tables) -> DataFrame:
    """Two delta cycles through a stored table; the second finds nothing to do."""
    path = fresh_folder(t.spark)
    tables.write_scd(customer_hist(t), path)
    for run in ("first", "again"):
        _, closed, active = scd.delta_changes(customer_today(t), tables.read_scd(t.spark, path), AS_OF)
        tables.update_scd(closed, active, path, run)
    return tables.read_scd(t.spark, path)


# Orders as matches: the priority plays the market, the status the request, and dear orders
# are manual entries that a run must not touch.


def order_rows(df: DataFrame) -> DataFrame:
    hashed = with_hashes(df, ["o_orderkey"], ORDER)
    return hashed.select(
        *ORDER,
        F.col("o_orderpriority").alias("iso_code"),
        F.col("o_orderstatus").alias("original_request"),
        F.when(F.col("o_custkey") < 100, "manual").otherwise("engine").alias("_sourcesystem"),
        "_keyhash",
        "_rowhash",
    )


def order_hist(t: Tables) -> DataFrame:
    known = t.orders.where(F.col("o_orderdate") < ts(date(2001, 6, 1)))
    return versioned(order_rows(known), datetime(2001, 6, 1), datetime(2099, 12, 31), True)


def order_staging(t: Tables) -> DataFrame:
    run = t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_totalprice") >= 20000))
    dearer = F.when(F.col("o_orderdate") >= ts(date(2000, 1, 1)), F.col("o_totalprice") + 10).otherwise(F.col("o_totalprice"))
    return order_rows(run.withColumn("o_totalprice", dearer))


ORDER_ROW = """
o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderpriority as iso_code,
o_orderstatus as original_request, case when o_custkey < 100 then 'manual' else 'engine' end as _sourcesystem,
md5(cast(o_orderkey as varchar)) as _keyhash,
md5(o_orderkey || '|' || o_custkey || '|' || o_orderstatus || '|' || cast(cast(o_totalprice as decimal(38,4)) as varchar) || '|' || o_orderpriority) as _rowhash
"""
ORDER_CTES = f"""
hist as (select {ORDER_ROW}, timestamp '2001-06-01' as _valid_from, timestamp '2099-12-31' as _valid_until, true as _valid_flag
  from orders where o_orderdate < timestamp '2001-06-01'),
run_rows as (select * replace (case when o_orderdate >= timestamp '2000-01-01' then o_totalprice + 10 else o_totalprice end as o_totalprice)
  from orders where o_orderpriority in ('1-URGENT', '2-HIGH') and o_totalprice >= 20000),
staging as (select {ORDER_ROW} from run_rows),
owned as (select _keyhash || _rowhash as v from hist where _valid_flag and _sourcesystem = 'engine'),
judged as (select h.*, _valid_flag and _sourcesystem = 'engine'
    and (_keyhash || _rowhash) not in (select _keyhash || _rowhash from staging)
    and (original_request || iso_code) in (select original_request || iso_code from staging) as gone from hist h)
"""


@query(
    "scd2_merge_orders",
    f"""with {ORDER_CTES}
    select * exclude (gone, _valid_until, _valid_flag),
      case when gone then timestamp '2001-08-01 09:59:59' else _valid_until end as _valid_until,
      case when gone then false else _valid_flag end as _valid_flag from judged
    union all by name
    select *, timestamp '2001-08-01 10:00:00' as _valid_from, timestamp '2099-12-31' as _valid_until, true as _valid_flag
    from staging where (_keyhash || _rowhash) not in (select v from owned)""",
)
def scd2_merge_orders(t: Tables) -> DataFrame:
    return scd.scd2_merge(order_hist(t), order_staging(t), AS_OF, source="engine")


@query("stored_merge_cycles", ORACLES["scd2_merge_orders"])
def stored_merge_cycles(t: Tables) -> DataFrame:
    """Two merges through a stored table, which read and write active rows only.

    The second brings the engine's own rows once more and changes nothing.
    """
    path = fresh_folder(t.spark)
    tables.write_scd(order_hist(t), path)
    staging = order_staging(t)
    for run, staged in (("first", staging), ("again", staging.where("_sourcesystem = 'engine'"))):
        active = tables.read_scd(t.spark, path, "active")
        tables.update_scd(*scd.scd2_changes(active, staged, AS_OF, source="engine"), path, run)
    return tables.read_scd(t.spark, path)


# Orders per customer as versions: closed ones ran for 90 days, open ones are active.


def order_versions(t: Tables) -> DataFrame:
    is_open = F.col("o_orderstatus") == "O"
    until = F.when(is_open, ts(date(2099, 12, 31))).otherwise(F.col("o_orderdate") + F.expr("interval 90 days"))
    hashed = with_hashes(t.orders, ["o_custkey"], ORDER)
    return hashed.select(
        "o_orderkey", "o_custkey",
        (F.col("o_totalprice") / 500000).alias("match_quality"),
        "_keyhash", "_rowhash",
        F.col("o_orderdate").alias(VALID_FROM),
        until.alias(VALID_UNTIL),
        is_open.alias(VALID_FLAG),
    )


VERSION_CTES = """
versions as (select o_orderkey, o_custkey, o_totalprice / 500000 as match_quality,
  md5(cast(o_custkey as varchar)) as _keyhash,
  md5(o_orderkey || '|' || o_custkey || '|' || o_orderstatus || '|' || cast(cast(o_totalprice as decimal(38,4)) as varchar) || '|' || o_orderpriority) as _rowhash,
  o_orderdate as _valid_from,
  case when o_orderstatus = 'O' then timestamp '2099-12-31' else o_orderdate + interval 90 day end as _valid_until,
  o_orderstatus = 'O' as _valid_flag from orders)
"""
SEEN_ON = datetime(1998, 6, 15, 12)


@query("scd_current", f"with {VERSION_CTES} select * from versions where _valid_flag")
def scd_current(t: Tables) -> DataFrame:
    return scd.current(order_versions(t))


@query(
    "scd_as_of",
    f"with {VERSION_CTES} select * from versions where _valid_from <= timestamp '1998-06-15 12:00:00' and _valid_until > timestamp '1998-06-15 12:00:00'",
)
def scd_as_of(t: Tables) -> DataFrame:
    return scd.as_of_view(order_versions(t), SEEN_ON)


@query("scd_key_history", f"with {VERSION_CTES} select * from versions where _keyhash = md5('7') order by _valid_from")
def scd_key_history(t: Tables) -> DataFrame:
    # One key's history is the feature: md5 of customer 7.
    return scd.history(order_versions(t), "8f14e45fceea167a5a36dedd4bea2543")


@query(
    "scd_recently_closed",
    f"with {VERSION_CTES} select * from versions where not _valid_flag and _valid_until >= timestamp '2001-08-01 10:30:00' - interval 7 day",
)
def scd_recently_closed(t: Tables) -> DataFrame:
    return scd.recently_closed(order_versions(t), AS_OF, days=7)


@query(
    "scd_closed_count",
    f"with {VERSION_CTES} select count(*) as deleted_count from versions where not _valid_flag and _valid_until >= timestamp '2001-08-01 10:30:00' - interval 30 day",
)
def scd_closed_count(t: Tables) -> DataFrame:
    return scd.closed_count(order_versions(t), AS_OF, days=30)


@query(
    "scd_lag_delta",
    f"""with {VERSION_CTES} select *, match_quality - prev_quality as quality_delta from (
    select *, lag(match_quality) over (partition by _keyhash order by _valid_from, o_orderkey) as prev_quality from versions)""",
)
def scd_lag_delta(t: Tables) -> DataFrame:
    return scd.quality_deltas(order_versions(t), "match_quality", [VALID_FROM, "o_orderkey"], unique=True)


@query(
    "scd_duplicate_keys",
    f"with {VERSION_CTES} select _keyhash, count(*) as duplicate_count from versions where _valid_flag group by 1 having count(*) > 1",
)
def scd_duplicate_keys(t: Tables) -> DataFrame:
    return quality.duplicate_keys(order_versions(t))


@query(
    "scd_duplicate_repair",
    f"""with {VERSION_CTES}, newest as (select _keyhash as k, max(_valid_from) as newest from versions where _valid_flag group by 1)
    select v.* exclude (_valid_until, _valid_flag),
      case when _valid_flag and _valid_from < newest then _valid_from else _valid_until end as _valid_until,
      case when _valid_flag and _valid_from < newest then false else _valid_flag end as _valid_flag
    from versions v left join newest on k = _keyhash""",
)
def scd_duplicate_repair(t: Tables) -> DataFrame:
    return scd.repair_duplicates(order_versions(t))


@query(
    "quality_profile",
    f"""with {VERSION_CTES}, a as (select avg(match_quality) as avg_quality, min(match_quality) as min_quality,
      count(*) filter (where match_quality < 0.70) as low_quality_count,
      count(*) filter (where match_quality < 0.70) / count(*) as low_quality_share from versions where _valid_flag)
    select round(avg_quality, 6) as avg_quality, min_quality, low_quality_count, low_quality_share,
      avg_quality < 0.75 or low_quality_share > 0.05 as alert from a""",
)
def quality_profile(t: Tables) -> DataFrame:
    return quality.quality_profile(order_versions(t)).withColumn("avg_quality", F.round("avg_quality", 6))


@query(
    "dq_report",
    f"""with {VERSION_CTES}, staging as (select * from orders where o_orderstatus <> 'F'),
    act as (select * from versions where _valid_flag),
    q as (select avg(match_quality) as a, count(*) filter (where match_quality < 0.70) / count(*) as s from act),
    dup as (select count(*) as n from (select _keyhash from act group by 1 having count(*) > 1)),
    gap as (select count(*) as n from (select _keyhash from versions group by 1 having max(_valid_until) < timestamp '2001-08-01 10:30:00')),
    orph as (select count(*) as n from act where o_custkey not in (select c_custkey from customer where c_acctbal >= 0))
    select 'row_count' as check_name, cast((select count(*) from act) as double) as value,
      cast((select count(*) from staging) as double) as threshold, (select count(*) from act) = (select count(*) from staging) as passed
    union all select 'average_quality', round(a, 6), 0.75, a >= 0.75 from q
    union all select 'low_quality_share', round(s, 6), 0.05, s <= 0.05 from q
    union all select 'duplicate_active_keys', n, 0, n = 0 from dup
    union all select 'history_gaps', n, 0, n = 0 from gap
    union all select 'orphans_o_custkey', n, 0, n = 0 from orph""",
)
def dq_report(t: Tables) -> DataFrame:
    staging = t.orders.where(F.col("o_orderstatus") != "F")
    solvent = t.customer.where(F.col("c_acctbal") >= 0)
    out = quality.dq_report(order_versions(t), staging, AS_OF, [("o_custkey", solvent, "c_custkey")])
    return out.withColumn("value", F.round("value", 6))


@query(
    "monitor_changes",
    f"""with {CUSTOMER_CTES}, act as (select * from hist where _valid_flag),
    c as (select case when (_keyhash || _rowhash) in (select _keyhash || _rowhash from act) then 'unchanged'
       when _keyhash in (select _keyhash from act) then 'changed' else 'new' end as change, c_acctbal as q from today
      union all select 'deleted', c_acctbal from act where _keyhash not in (select _keyhash from today))
    select change, count(*) as n, round(avg(q), 4) as avg_quality from c group by 1""",
)
def monitor_changes(t: Tables) -> DataFrame:
    out = quality.change_summary(customer_today(t), customer_hist(t), "c_acctbal")
    return out.withColumn("avg_quality", F.round("avg_quality", 4))
