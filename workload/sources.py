"""Sources and sinks: tables written to a fresh folder, read back, and compared with SQL."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.contracts import conform
from tidemark.plans.lifecycle import dual_export
from tidemark.sources import tables
from workload.base import Tables, fresh_folder, query

DAY, NEXT = date(2024, 1, 30), date(2024, 1, 31)
PARTS = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_size", T.LongType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]
)
_PARTS_SQL = "select p_partkey, p_name, cast(p_size as bigint) as p_size, p_retailprice from part"


def parts(t: Tables) -> DataFrame:
    return conform(t.part, PARTS)


@query("ndjson_round_trip", "select event_id, event_type, props, value from events")
def ndjson_round_trip(t: Tables) -> DataFrame:
    path = fresh_folder(t.spark)
    rows = t.events.select("event_id", "event_type", "props", "value")
    tables.write_ndjson(rows, path)
    return tables.read_ndjson(t.spark, path, rows.schema)


@query("csv_into_staging", _PARTS_SQL)
def csv_into_staging(t: Tables) -> DataFrame:
    """A CSV load replaces what an earlier load left."""
    csv, staging = fresh_folder(t.spark), fresh_folder(t.spark)
    parts(t).write.option("header", True).csv(csv)
    tables.write_replace(parts(t).limit(3), staging)
    tables.load_csv_overwrite(t.spark, csv, PARTS, staging)
    return tables.read_table(t.spark, staging)


@query("lookup_table_read", "select n_nationkey, n_name from nation")
def lookup_table_read(t: Tables) -> DataFrame:
    path = fresh_folder(t.spark)
    tables.write_replace(t.nation, path)
    return tables.read_lookup(t.spark, path).select("n_nationkey", "n_name")


@query(
    "country_family_read",
    """select c_custkey, c_name, case c_nationkey % 3 when 0 then 'DE' else 'FR' end as country from customer
    where c_nationkey % 3 < 2""",
)
def country_family_read(t: Tables) -> DataFrame:
    """Two of three market tables exist; the third is passed over."""
    root = fresh_folder(t.spark)
    for k, suffix in enumerate(("de", "fr")):
        tables.write_replace(t.customer.where(F.col("c_nationkey") % 3 == k).select("c_custkey", "c_name"), f"{root}/c_{suffix}")
    return tables.read_country_family(t.spark, {"de": "de", "fr": "fr", "it": "it"}, root + "/c_{}")


@query("replace_with_schema", "select s_suppkey, cast(s_acctbal as varchar) as s_acctbal, s_name from supplier where s_acctbal > 0")
def replace_with_schema(t: Tables) -> DataFrame:
    """Replaced twice; columns take the schema's order and types."""
    path = fresh_folder(t.spark)
    wanted = T.StructType(
        [T.StructField("s_suppkey", T.LongType()), T.StructField("s_acctbal", T.StringType()), T.StructField("s_name", T.StringType())]
    )
    tables.write_replace(t.supplier, path, wanted)
    tables.write_replace(t.supplier.where(F.col("s_acctbal") > 0), path, wanted)
    return tables.read_table(t.spark, path)


@query("append_twice", "select o_orderkey, o_custkey from orders union all select o_orderkey, o_custkey from orders where o_orderstatus = 'F'")
def append_twice(t: Tables) -> DataFrame:
    path = fresh_folder(t.spark)
    orders = t.orders.select("o_orderkey", "o_custkey")
    tables.write_append(orders, path)
    tables.write_append(t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey"), path)
    return tables.read_table(t.spark, path)


@query(
    "append_day_again",
    """select o_orderkey, date '2024-01-30' as batch_date from orders where o_orderstatus = 'O'
    union all select o_orderkey, date '2024-01-31' from orders where o_orderstatus = 'F'""",
)
def append_day_again(t: Tables) -> DataFrame:
    """The first day runs twice with other rows, and its second run counts."""
    path = fresh_folder(t.spark)
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    for status, day in (("P", DAY), ("F", NEXT), ("O", DAY)):
        tables.append_batch(orders.where(F.col("o_orderstatus") == status).drop("o_orderstatus"), path, day)
    return tables.read_table(t.spark, path)


@query(
    "dated_landing",
    """select cast(event_id as bigint) as event_id, 'clicks' as entity, date '2024-01-30' as load_date from events where event_type = 'click'
    union all select event_id, 'errors', date '2024-01-31' from events where event_type = 'error'""",
)
def dated_landing(t: Tables) -> DataFrame:
    """Two entities; the first lands twice on its day."""
    path = fresh_folder(t.spark)
    ids = t.events.select("event_id", "event_type")
    for entity, kind, day in (("clicks", "signup", DAY), ("errors", "error", NEXT), ("clicks", "click", DAY)):
        tables.land_raw(ids.where(F.col("event_type") == kind).drop("event_type"), path, entity, day)
    stored = t.spark.read.schema("event_id bigint, entity string, load_date date").json(path)
    return stored.select("event_id", "entity", "load_date")


@query(
    "rejects_csv",
    """select cast(c_custkey as varchar) as c_custkey, '["c_acctbal: ' || c_mktsegment || '"]' as reject_reasons
    from customer where c_acctbal < 0""",
)
def rejects_csv(t: Tables) -> DataFrame:
    path = fresh_folder(t.spark)
    reasons = F.array(F.concat(F.lit("c_acctbal: "), F.col("c_mktsegment")))
    bad = t.customer.where(F.col("c_acctbal") < 0).select("c_custkey", reasons.alias("reject_reasons"))
    tables.write_rejects(bad, path)
    return t.spark.read.options(header=True, escape="\\").csv(path)


@query(
    "dual_export_sinks",
    """select sink, event_id, event_type, batch_date from (values ('file', null::date), ('history', date '2024-01-30')) s(sink, batch_date),
    events where event_id is not null and event_type <> 'error'""",
)
def dual_export_sinks(t: Tables) -> DataFrame:
    """What both sinks hold after the day has run twice, the first time with all events."""
    sent, history = fresh_folder(t.spark), fresh_folder(t.spark)
    rows = t.events.select("event_id", "event_type")
    for run in (rows, rows.where(F.col("event_type") != "error")):
        dual_export(run, datetime(2024, 1, 30, 5), history, [lambda kept: tables.write_ndjson(kept, sent)], "event_id")
    files = tables.read_ndjson(t.spark, sent, rows.schema).select(
        F.lit("file").alias("sink"), "*", F.lit(None).cast("date").alias("batch_date")
    )
    return files.unionByName(tables.read_table(t.spark, history).withColumn("sink", F.lit("history")))
