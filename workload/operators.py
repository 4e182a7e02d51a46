"""Table-level operators and cleaning functions on their own."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clean
from tidemark.functions.clock import iso_week_start
from tidemark.functions.contracts import REASONS, conform, record, validate
from tidemark.operators import aggregates, joins, ordering, reshape, select
from workload.base import Tables, query


def dirty_segment() -> Column:
    """Segments with three of them written as null texts."""
    seg = F.col("c_mktsegment")
    texts = F.when(seg == "BUILDING", "nan").when(seg == "MACHINERY", "None").when(seg == "FURNITURE", "<NA>")
    return texts.otherwise(seg)


@query(
    "string_null_clean",
    """select c_custkey, case when c_mktsegment in ('BUILDING', 'MACHINERY', 'FURNITURE') then null else c_mktsegment end as segment,
    cast(c_nationkey as varchar) as c_nationkey from customer""",
)
def string_null_clean(t: Tables) -> DataFrame:
    dirty = t.customer.select("c_custkey", dirty_segment().alias("segment"), "c_nationkey")
    return clean.clean_string_nulls(dirty, ["segment", "c_nationkey"])


@query(
    "required_strings",
    """select cast(c_custkey as varchar) as c_custkey, case when c_mktsegment = 'BUILDING' then '' else c_mktsegment end as segment,
    case when c_acctbal < 0 then 99 else c_nationkey end as level from customer""",
)
def required_strings(t: Tables) -> DataFrame:
    holes = t.customer.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("level"),
    )
    return clean.required_strings(holes, ["c_custkey", "segment"], {"level": 99})


LINE_CONTRACT = record(
    "l_orderkey BIGINT NOT NULL, l_partkey INT NOT NULL, quantity INT, price DECIMAL(5,2) NOT NULL, shipped DATE NOT NULL, flag STRING"
)


def contract_lines(t: Tables) -> DataFrame:
    """Dear lines do not fit the price; returned ones have no quantity and lack a date."""
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity") + 0.5).alias("quantity"),
        (F.col("l_extendedprice") / 50).cast("decimal(18,4)").alias("price"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("shipped"),
        F.col("l_returnflag").alias("flag"),
    )


CONTRACT_SQL = """src as (select l_orderkey, l_partkey, case when l_returnflag <> 'R' then l_quantity + 0.5 end as quantity,
  cast(l_extendedprice / 50 as decimal(18,4)) as price, case when l_linestatus = 'F' then l_shipdate end as shipped, l_returnflag as flag from lineitem)"""


@query(
    "contract_conform",
    """select l_orderkey, cast(l_partkey as integer) as l_partkey, cast(l_quantity as integer) as quantity,
    cast(l_shipdate as date) as shipped, l_returnflag as flag from lineitem""",
)
def contract_conform(t: Tables) -> DataFrame:
    contract = record("l_orderkey BIGINT NOT NULL, l_partkey INT NOT NULL, quantity INT, shipped DATE NOT NULL, flag STRING")
    lines = t.lineitem.withColumnsRenamed({"l_quantity": "quantity", "l_shipdate": "shipped", "l_returnflag": "flag"})
    return conform(lines, contract)


@query(
    "contract_valid",
    f"""with {CONTRACT_SQL} select l_orderkey, cast(l_partkey as integer) as l_partkey, cast(round(cast(quantity as decimal(18,4)), 0) as integer) as quantity,
    cast(round(price, 2) as decimal(5,2)) as price, cast(shipped as date) as shipped, flag from src where round(price, 2) < 1000 and shipped is not null""",
)
def contract_valid(t: Tables) -> DataFrame:
    return validate(contract_lines(t), LINE_CONTRACT)[0]


@query(
    "contract_rejects",
    f"""with {CONTRACT_SQL} select l_orderkey, price, array_to_string(list_filter([
      case when round(price, 2) >= 1000 then 'price: not a decimal(5,2)' end,
      case when shipped is null then 'shipped: missing' end], lambda x: x is not null), '; ') as reasons
    from src where round(price, 2) >= 1000 or shipped is null""",
)
def contract_rejects(t: Tables) -> DataFrame:
    rejected = validate(contract_lines(t), LINE_CONTRACT)[1]
    return rejected.select("l_orderkey", "price", F.concat_ws("; ", REASONS).alias("reasons"))


@query(
    "epoch_and_unscaled",
    """select o_orderkey, cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as integer) as day,
    cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as integer) as text_day,
    cast(round_even(cast(o_totalprice as decimal(18,4)), 2) * 100 as bigint) as cents from orders""",
)
def epoch_and_unscaled(t: Tables) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")
    return t.orders.select(
        "o_orderkey",
        clean.epoch_day("o_orderdate").alias("day"),
        clean.epoch_day(text).alias("text_day"),
        clean.unscaled("o_totalprice", 18, 2).alias("cents"),
    )


@query(
    "code_list_parse",
    """select p_partkey, case when p_size > 40 then '' else p_brand || ',' || p_type || ',' || p_brand end as codes,
    case when p_size > 40 then 0 else 3 end as n from part""",
)
def code_list_parse(t: Tables) -> DataFrame:
    raw = F.concat("p_brand", F.lit(";None; "), "p_type", F.lit(" ;; none ;None"), "p_brand")
    codes = clean.parse_codes(F.when(F.col("p_size") <= 40, raw))
    return t.part.select("p_partkey", F.concat_ws(",", codes).alias("codes"), F.size(codes).alias("n"))


@query(
    "code_variant",
    """select p_partkey, case when p_brand in ('Brand#1', 'Brand#2') and p_type in ('PROMO', 'LARGE')
      then case when p_type = 'PROMO' then 'POS_L_Package' else 'POS_L_PackageS' end || ':1:12'
      else case when p_type = 'PROMO' then 'POS_L_Package' when p_type = 'LARGE' then 'POS_L_PackageS' else p_type end || ':1:1' end as code from part""",
)
def code_variant(t: Tables) -> DataFrame:
    code = F.when(F.col("p_type") == "PROMO", "POS_L_Package").when(F.col("p_type") == "LARGE", "POS_L_PackageS").otherwise(F.col("p_type"))
    country = F.when(F.col("p_brand") == "Brand#1", "de").when(F.col("p_brand") == "Brand#2", "IT").otherwise("FR")
    return t.part.select("p_partkey", clean.code_variant(code, country).alias("code"))


@query(
    "int_list_parse",
    """select event_id, case when event_type <> 'error' then user_id + cast(json_extract_string(props, '$.k') as bigint) end as total,
    case when event_type <> 'error' then 2 end as n from events""",
)
def int_list_parse(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    text = F.when(F.col("event_type") != "error", F.concat(F.col("user_id").cast("string"), F.lit(", "), k)).otherwise("")
    ids = clean.parse_int_list(text)
    return t.events.select(
        "event_id",
        F.aggregate(ids, F.lit(0).cast("bigint"), lambda a, i: a + i).alias("total"),
        F.when(ids.isNotNull(), F.size(ids)).alias("n"),
    )


@query(
    "json_by_language",
    "select n_nationkey, n_name as en, cast(null as varchar) as fr, case when n_regionkey < 2 then lower(n_name) end as de from nation",
)
def json_by_language(t: Tables) -> DataFrame:
    german = F.when(F.col("n_regionkey") < 2, F.lower("n_name"))
    names = F.to_json(F.struct(F.col("n_name").alias("en_US"), german.alias("de_DE")))
    n = t.nation.select("n_nationkey", names.alias("name"))
    return n.select(
        "n_nationkey", clean.json_text("name").alias("en"), clean.json_text("name", "fr_FR").alias("fr"), clean.json_text("name", "de_DE").alias("de")
    )


@query(
    "safe_ratios",
    """select l_orderkey, l_partkey, l_linenumber, l_extendedprice / nullif(l_tax, 0) as per_tax, case when l_discount = 0 then null else l_quantity / l_discount end as per_discount from lineitem""",
)
def safe_ratios(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        clean.safe_ratio(F.col("l_extendedprice"), F.col("l_tax")).alias("per_tax"),
        clean.safe_ratio(F.col("l_quantity"), F.col("l_discount")).alias("per_discount"),
    )


@query(
    "type_names",
    """select distinct p_type, case p_type when 'PROMO' then 'cafe' when 'LARGE' then 'nightclub' else lower(p_type) end as kind from part""",
)
def type_names(t: Tables) -> DataFrame:
    label = F.when(F.col("p_type") == "PROMO", "Café").when(F.col("p_type") == "LARGE", "Night Club").otherwise(F.col("p_type"))
    return t.part.select("p_type", clean.normalise_type(label).alias("kind")).distinct()


@query(
    "partner_keys",
    """select c_custkey, replace(lower(c_name), ' ', '') || c_nationkey || case when c_acctbal < 0 then '/' else c_mktsegment end
      || 'contact' || case when c_acctbal > 5000 then 'true' else 'false' end as key from customer""",
)
def partner_keys(t: Tables) -> DataFrame:
    c = t.customer.select(
        "c_custkey",
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("name"),
        F.col("c_nationkey").cast("string").alias("zip"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("vat"),
        F.lit("contact").alias("type"),
        (F.col("c_acctbal") > 5000).alias("is_company"),
    )
    return c.select("c_custkey", clean.partner_key("name", "zip", "vat", "type", "is_company").alias("key"))


# --- joins ------------------------------------------------------------------------------------


@query(
    "full_outer_coalesce",
    """with a as (select c_nationkey as nation, c_mktsegment as segment, max(c_acctbal) as best, count(*) as customers from customer group by 1, 2),
    b as (select s_nationkey as nation, case when s_acctbal > 0 then 'BUILDING' else 'DEBT' end as segment, max(s_acctbal) as best, count(*) as suppliers from supplier group by 1, 2)
    select coalesce(a.nation, b.nation) as nation, coalesce(a.segment, b.segment) as segment, coalesce(a.best, b.best) as best, customers, suppliers
    from a full join b on a.nation = b.nation and a.segment = b.segment""",
)
def full_outer_coalesce(t: Tables) -> DataFrame:
    a = t.customer.groupBy(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).agg(
        F.max("c_acctbal").alias("best"), F.count(F.lit(1)).alias("customers")
    )
    kind = F.when(F.col("s_acctbal") > 0, "BUILDING").otherwise("DEBT")
    b = t.supplier.groupBy(F.col("s_nationkey").alias("nation"), kind.alias("segment")).agg(
        F.max("s_acctbal").alias("best"), F.count(F.lit(1)).alias("suppliers")
    )
    return joins.full_outer_coalesce(a, b, ["nation", "segment"], ["best"])


@query(
    "null_safe_join",
    """with a as (select c_custkey, nullif(c_nationkey, 3) as nation, nullif(c_mktsegment, 'BUILDING') as segment from customer),
    b as (select nullif(s_nationkey, 3) as nation, case when s_acctbal > 5000 then 'MACHINERY' end as segment, count(*) as n from supplier group by 1, 2)
    select c_custkey, a.nation, a.segment, n from a join b on a.nation is not distinct from b.nation and a.segment is not distinct from b.segment""",
)
def null_safe_join(t: Tables) -> DataFrame:
    a = t.customer.select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nation"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    b = t.supplier.groupBy(
        F.nullif("s_nationkey", F.lit(3)).alias("nation"), F.when(F.col("s_acctbal") > 5000, "MACHINERY").alias("segment")
    ).agg(F.count(F.lit(1)).alias("n"))
    return joins.null_safe_join(a, b, ["nation", "segment"])


@query(
    "propagate_active",
    """with r as (select o_orderkey, o_custkey, o_orderpriority as grp, nullif(o_orderstatus, 'P') as member, o_totalprice > 499500 as act from orders),
    m as (select distinct o_custkey, member from r where act),
    g as (select distinct r.grp, r.member from r join m on m.o_custkey = r.o_custkey and m.member is not distinct from r.member)
    select o_orderkey, exists (select 1 from g where g.grp = r.grp) as active from r""",
)
def propagate_active(t: Tables) -> DataFrame:
    r = t.orders.select(
        "o_orderkey", "o_custkey", F.col("o_orderpriority").alias("grp"),
        F.nullif("o_orderstatus", F.lit("P")).alias("member"), (F.col("o_totalprice") > 499500).alias("act"),
    )
    return joins.propagate_active(r, ["grp"], ["o_custkey", "member"], F.col("act"), "active").select("o_orderkey", "active")


_MAPS = """direct as (select c_custkey as k, min(c_custkey + 1000000) as v from customer where c_mktsegment = 'BUILDING' group by 1),
  ext as (select c_custkey as k, c_custkey + 2000000 as v from customer where c_mktsegment in ('BUILDING', 'MACHINERY'))"""


def _fallback(t: Tables):
    direct = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", (F.col("c_custkey") + 1000000).alias("id"))
    doubled = direct.unionAll(direct.withColumn("id", F.col("id") + 5))
    external = t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(
        F.col("c_custkey").alias("name"), (F.col("c_custkey") + 2000000).alias("res_id")
    )
    orders = t.orders.select("o_orderkey", "o_custkey")
    return joins.fallback_lookup(orders, "o_custkey", [(doubled, "c_custkey", "id"), (external, "name", "res_id")], "partner_id")


@query(
    "fallback_lookup",
    f"""with {_MAPS} select o_orderkey, o_custkey, coalesce(direct.v, ext.v) as partner_id from orders
    left join direct on direct.k = o_custkey left join ext on ext.k = o_custkey where coalesce(direct.v, ext.v) is not null""",
)
def fallback_lookup(t: Tables) -> DataFrame:
    return _fallback(t)[0]


@query(
    "fallback_rejects",
    f"""with {_MAPS} select o_orderkey, o_custkey, 'could not resolve o_custkey ' || o_custkey as reject_reason from orders
    left join direct on direct.k = o_custkey left join ext on ext.k = o_custkey where coalesce(direct.v, ext.v) is null""",
)
def fallback_rejects(t: Tables) -> DataFrame:
    return _fallback(t)[1]


@query(
    "array_lookup",
    """with dim as (select split_part(p_name, ' ', 2) as w, min(p_partkey) as id from part group by 1 having split_part(p_name, ' ', 2) not in ('bolt', 'gear'))
    select p_partkey, coalesce(cast(id as varchar), '') as ids, case when id is null then 2 else 1 end as unknown
    from part left join dim on w = split_part(p_name, ' ', 2)""",
)
def array_lookup(t: Tables) -> DataFrame:
    words = t.part.select("p_partkey", F.split("p_name", " ").alias("words"))
    dim = t.part.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("w"), F.col("p_partkey").alias("id"))
    dim = dim.where(~F.col("w").isin("bolt", "gear"))
    out = joins.array_lookup(words, ["p_partkey"], "words", dim, "w", "id", "ids", "unknown")
    return out.select("p_partkey", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"), F.col("unknown").cast("int").alias("unknown"))


@query(
    "skip_loaded",
    """select o_custkey, o_orderkey, o_orderdate, o_totalprice from orders where o_custkey not in (select c_custkey from customer where c_acctbal < 5000)
    qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1""",
)
def skip_loaded(t: Tables) -> DataFrame:
    loaded = t.customer.where(F.col("c_acctbal") < 5000).select(F.col("c_custkey").alias("o_custkey"))
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return joins.skip_loaded(orders, loaded, "o_custkey", ["o_orderdate", "o_orderkey"])


@query(
    "restrict_lookup",
    """with ids as (select cast(l_partkey as varchar) as i from lineitem union select cast(l_suppkey as varchar) from lineitem)
    select p_partkey, p_name from part where cast(p_partkey as varchar) in (select i from ids)""",
)
def restrict_lookup(t: Tables) -> DataFrame:
    return joins.restrict_dim(t.part.select("p_partkey", "p_name"), "p_partkey", t.lineitem, ["l_partkey", "l_suppkey"])


# --- one row per key, ranks, chunks --------------------------------------------------------------


@query(
    "best_per_key",
    """select o_custkey, o_orderkey, o_totalprice, o_orderdate from orders
    qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderdate, o_orderkey) = 1""",
)
def best_per_key(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return select.best_per_key(orders, ["o_custkey"], ["-o_totalprice", "o_orderdate", "o_orderkey"])


@query("failure_preview", "select event_id, event_type, value from events where event_type = 'error' order by value desc, event_id limit 5")
def failure_preview(t: Tables) -> DataFrame:
    failed = t.events.where(F.col("event_type") == "error").select("event_id", "event_type", "value")
    return select.preview(failed, [F.col("value").desc(), "event_id"], 5)


@query("rank_chunks", "select *, (row_number() over (order by o_custkey, o_orderkey) - 1) // 500 as chunk from orders")
def rank_chunks(t: Tables) -> DataFrame:
    return ordering.chunk_by_rank(t.orders, ["o_custkey", "o_orderkey"], 500, unique=True)


@query(
    "rank_chunks_with_copies",
    """select l_returnflag, l_linestatus, (row_number() over (order by l_returnflag, l_linestatus) - 1) // 500 as chunk from lineitem""",
)
def rank_chunks_with_copies(t: Tables) -> DataFrame:
    # Six distinct rows only: every chunk but a few is made of copies of one row.
    return ordering.chunk_by_rank(t.lineitem.select("l_returnflag", "l_linestatus"), ["l_returnflag", "l_linestatus"], 500)


@query(
    "rank_chunk_slice",
    """select *, row_number() over (order by o_totalprice desc, o_orderkey) as rnk from orders qualify rnk between 501 and 1000""",
)
def rank_chunk_slice(t: Tables) -> DataFrame:
    return ordering.rank_slice(t.orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 501, 1000, unique=True)


@query("ntile_batches", "select o_orderkey, cast(ntile(7) over (order by o_orderdate, o_orderkey) as integer) as tile from orders")
def ntile_batches(t: Tables) -> DataFrame:
    return ordering.ntile_batch(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 7, unique=True).drop("o_orderdate")


# --- reshape and measures --------------------------------------------------------------------------


@query(
    "unpivot_flags",
    """select o_orderkey, case when o_orderstatus = 'F' then o_orderdate end as date_from, cast(null as timestamp) as date_to,
      'finished' as service_desc, 100 as service_cd from orders where o_orderstatus = 'F'
    union all select o_orderkey, o_orderdate, null, 'open', 101 from orders where o_orderstatus = 'O'
    union all select o_orderkey, null, o_orderdate, 'dear', 201 from orders where o_totalprice > 400000""",
)
def unpivot_flags(t: Tables) -> DataFrame:
    flagged = t.orders.select(
        "o_orderkey", "o_orderdate",
        (F.col("o_orderstatus") == "F").cast("int").alias("is_f"),
        (F.col("o_orderstatus") == "O").cast("int").alias("is_o"),
        (F.col("o_totalprice") > 400000).cast("int").alias("is_dear"),
    )
    flags = [
        reshape.Flag("is_f", "finished", 100, "o_orderdate"),
        reshape.Flag("is_o", "open", 101, "o_orderdate", "no_such_column"),
        reshape.Flag("is_dear", "dear", 201, None, "o_orderdate"),
    ]
    return reshape.unpivot_flags(flagged, flags, ["o_orderkey"])


@query(
    "nest_line_pages",
    """with r as (select l_orderkey, l_partkey, l_quantity, (row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1) // 3 as page_no from lineitem)
    select l_orderkey, cast(page_no as integer) as page_no, cast(count(*) as integer) as n, sum(l_partkey)::bigint as parts, round(sum(l_quantity), 4) as quantity from r group by 1, 2""",
)
def nest_line_pages(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    nested = reshape.nest_lines(
        lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"], ["l_partkey", "l_quantity"], page_size=3
    )
    return nested.select(
        "l_orderkey", "page_no", F.size("lines").alias("n"),
        F.aggregate("lines", F.lit(0).cast("bigint"), lambda a, x: a + x["l_partkey"]).alias("parts"),
        F.round(F.aggregate("lines", F.lit(0.0), lambda a, x: a + x["l_quantity"]), 4).alias("quantity"),
    )


@query(
    "min_max_by_key",
    """select l_suppkey, l_returnflag, min(l_shipdate) as first_ship, min(l_quantity) as least, max(l_shipdate) as last_ship from lineitem group by 1, 2""",
)
def min_max_by_key(t: Tables) -> DataFrame:
    return aggregates.min_max_by(
        t.lineitem, ["l_suppkey", "l_returnflag"], {"l_shipdate": "first_ship", "l_quantity": "least"}, {"l_shipdate": "last_ship"}
    )


@query(
    "week_lags",
    """with w as (select l_partkey, date_trunc('week', l_shipdate) as w, sum(cast(l_quantity as bigint)) as n from lineitem
      where l_shipdate >= timestamp '2000-11-03' group by 1, 2)
    select l_partkey, cast(max(n) filter (where w = date '2000-12-25') as bigint) as one_ago, cast(max(n) filter (where w = date '2000-12-18') as bigint) as two_ago from w group by 1""",
)
def week_lags(t: Tables) -> DataFrame:
    # 2001-01-03 lies in ISO week 1, whose predecessor is week 52 of the year before.
    sales = t.lineitem.select("l_partkey", "l_shipdate", F.col("l_quantity").cast("bigint").alias("n"))
    lags = {1: "one_ago", 2: "two_ago"}
    return aggregates.week_lags(sales, ["l_partkey"], "l_shipdate", "n", date(2001, 1, 3), lags, window_days=61)


@query(
    "week_of_order",
    "select o_orderkey, cast(weekofyear(o_orderdate) as integer) as week, cast(date_trunc('week', o_orderdate) as date) as monday from orders",
)
def week_of_order(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.weekofyear("o_orderdate").alias("week"), iso_week_start("o_orderdate").alias("monday"))


@query("service_counts", "select o_orderpriority, o_orderstatus, count(*) as n from orders group by 1, 2")
def service_counts(t: Tables) -> DataFrame:
    return aggregates.count_by(t.orders, ["o_orderpriority", "o_orderstatus"])


@query(
    "count_window",
    "select count(*) as total from events where ts >= timestamp '2024-01-29' and ts < timestamp '2024-01-31'",
)
def count_window(t: Tables) -> DataFrame:
    return aggregates.count_window(t.events, "ts", date(2024, 1, 30))


_PROGRESS = """p as (select (row_number() over (order by event_id) - 1) // 500 as chunk, event_type from events),
  c as (select chunk, count(*) filter (where event_type <> 'error') as processed, count(*) filter (where event_type = 'error') as errors from p group by 1)"""


def _progress(t: Tables) -> DataFrame:
    chunked = ordering.chunk_by_rank(t.events, ["event_id"], 500, unique=True)
    return aggregates.chunk_progress(chunked, "chunk", F.col("event_type") == "error")


@query("chunk_progress", f"with {_PROGRESS} select * from c")
def chunk_progress(t: Tables) -> DataFrame:
    return _progress(t)


@query(
    "error_rate",
    f"""with {_PROGRESS}, s as (select cast(sum(processed) as bigint) as total_processed, cast(sum(errors) as bigint) as total_errors from c)
    select *, total_errors / total_processed as error_rate, total_errors / total_processed > 0.05 as alert from s""",
)
def error_rate(t: Tables) -> DataFrame:
    return aggregates.error_rate(_progress(t))
