"""Load preparation and the terminal inventory."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import drop_blank, exclude_status
from tidemark.operators.aggregates import outcome_summary
from tidemark.operators.reshape import nest_lines, union_all
from tidemark.plans import loads, terminals
from workload.base import Tables, query

# --- invoices: orders with their line items -----------------------------------------------------


def invoice_inputs(t: Tables) -> dict[str, DataFrame]:
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_code"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("description"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.lit(7).cast("bigint").alias("account_id"),
        F.array(F.col("l_returnflag"), F.lit("unknown tax"), F.col("l_linestatus")).alias("tax_names"),
    )
    fields = ["product_code", "description", "quantity", "unit_price", "account_id", "tax_names"]
    nested = nest_lines(lines, ["l_orderkey"], ["l_linenumber"], fields, "line_items")
    billed = nested.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    invoices = billed.select(
        F.concat(F.lit("INV"), F.col("o_orderkey").cast("string")).alias("move_name"),
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("partner_uuid"),
        F.col("o_orderdate").cast("date").alias("invoice_date"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).alias("invoice_date_due"),
        F.lit("out_invoice").alias("move_type"),
        F.lit(1).alias("currency_id"),
        F.lit(2).alias("journal_id"),
        F.col("o_orderpriority").alias("reference"),
        F.col("o_orderdate").alias("write_date"),
        "line_items",
    )
    loaded = t.orders.where(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit("INV"), F.col("o_orderkey").cast("string")).alias("move_name")
    )
    uuid = F.concat(F.lit("U"), F.col("c_custkey").cast("string"))
    partners = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(uuid.alias("partner_uuid"), F.col("c_custkey").alias("id"))
    external = t.customer.where(F.col("c_mktsegment") == "MACHINERY").select(
        F.lit("salesforce").alias("module"), F.lit("res.partner").alias("model"), uuid.alias("name"), (F.col("c_custkey") + 1000000).alias("res_id")
    )
    catalogue = t.part.where(F.col("p_type") != "PROMO").select(
        F.lit("dish_product_catalog").alias("module"), F.lit("product.product").alias("model"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("name"), (F.col("p_partkey") + 500).alias("res_id"),
    )
    taxes = t.lineitem.select(F.col("l_returnflag").alias("name")).distinct().select("name", F.ascii("name").cast("bigint").alias("id"))
    return dict(invoices=invoices, loaded=loaded, partners=partners, external_ids=external.unionByName(catalogue), taxes=taxes)


INVOICE_SQL = """inv as (select o.*, case when c_mktsegment = 'BUILDING' then c_custkey when c_mktsegment = 'MACHINERY' then c_custkey + 1000000 end as partner_id
  from orders o join customer on c_custkey = o_custkey where o_orderstatus <> 'F' and o_orderkey in (select l_orderkey from lineitem))"""


@query(
    "invoice_nesting",
    f"""with {INVOICE_SQL}, l as (select l_orderkey, count(*) as n, count(case when p_type <> 'PROMO' then 1 end) as known,
      sum(case when p_type <> 'PROMO' then p_partkey + 500 else 0 end) as id_sum, round(sum(l_quantity), 4) as quantity, sum(ascii(l_returnflag)) as tax_sum,
      string_agg(case when p_type <> 'PROMO' then p_partkey + 500 end, ',' order by l_linenumber, 'P' || l_partkey, l_quantity, l_extendedprice) as line_order from lineitem join part on p_partkey = l_partkey group by 1)
    select 'INV' || o_orderkey as name, partner_id, cast(o_orderdate as date) as invoice_date, cast(o_orderdate as date) + 30 as invoice_date_due,
      o_orderpriority as ref, cast(n as integer) as n_lines, cast(id_sum as bigint) as id_sum, quantity, cast(tax_sum as bigint) as tax_sum, cast(2 * n as bigint) as unresolved_taxes, coalesce(line_order, '') as line_order
    from inv join l on l_orderkey = o_orderkey where partner_id is not null""",
)
def invoice_nesting(t: Tables) -> DataFrame:
    ok, _ = loads.prepare_invoices(**invoice_inputs(t))
    zero = F.lit(0).cast("bigint")
    lines = F.col("invoice_line_ids")
    return ok.select(
        "name", "partner_id", "invoice_date", "invoice_date_due", "ref",
        F.size(lines).alias("n_lines"),
        F.aggregate(lines, zero, lambda a, x: a + F.coalesce(x["product_id"], zero)).alias("id_sum"),
        F.round(F.aggregate(lines, F.lit(0.0), lambda a, x: a + x["quantity"]), 4).alias("quantity"),
        F.aggregate(F.flatten(F.transform(lines, lambda x: x["tax_ids"])), zero, lambda a, x: a + x).alias("tax_sum"),
        "unresolved_taxes",
        F.array_join(F.transform(lines, lambda x: x["product_id"].cast("string")), ",").alias("line_order"),
    )


@query(
    "invoice_rejects",
    f"""with {INVOICE_SQL} select 'INV' || o_orderkey as move_name, 'could not resolve partner_uuid U' || o_custkey as error, 'U' || o_custkey as partner_uuid
    from inv where partner_id is null""",
)
def invoice_rejects(t: Tables) -> DataFrame:
    return loads.prepare_invoices(**invoice_inputs(t))[1]


# --- leads and opportunities -----------------------------------------------------------------------


def named(t: Tables, pairs) -> DataFrame:
    """A lookup table made from nation rows: (name, id)."""
    return t.nation.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(i).cast("bigint").alias("id")) for n, i in pairs]))).distinct()


def lead_inputs(t: Tables) -> dict[str, DataFrame]:
    seg = F.col("c_mktsegment")
    country = F.when(seg == "BUILDING", "de").when(seg == "MACHINERY", "fr").when(seg == "FURNITURE", "IT").when(seg == "HOUSEHOLD", "xx")
    none = F.lit(None).cast("string")
    leads = t.customer.select(
        F.when(F.col("c_acctbal") > 0, "Ann").alias("first_name"), F.col("c_name").alias("last_name"),
        F.lit("a@b.c").alias("email"), none.alias("phone"), none.alias("mobile_phone"), country.alias("metro_id_country"),
        F.lit("1").alias("company_postal_code"), F.lit("city").alias("company_city"), none.alias("company_street"),
        none.alias("establishment_postal_code"), none.alias("establishment_city"), none.alias("establishment_street"),
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("store"), F.col("c_name").alias("establishment"),
        F.when(seg == "BUILDING", "xx").otherwise("DE").alias("primary_language"), F.when(seg == "MACHINERY", "HD").otherwise("none").alias("lead_source"), F.when(seg == "FURNITURE", "DISH").otherwise("HD").alias("channel_v2"),
        F.lit("owner").alias("role"), F.when(seg != "BUILDING", "mccde").otherwise("x").alias("merchant"), F.lower(seg).alias("reseller"),
        F.when(F.col("c_acctbal") > 0, seg).alias("vat_id"), F.col("c_custkey").alias("metro_id"),
        F.when(F.col("c_acctbal") < 5000, F.lit("POS_L_Package; None;NoneWEB;unknown")).otherwise("none").alias("product_codes"),
        F.lit(1).alias("last_modified"), F.lit(date(2024, 1, 30)).alias("load_date"),
    )
    stores = t.nation.where(F.col("n_regionkey") < 3).select(
        F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("code"), (F.col("n_nationkey") + 10).cast("bigint").alias("id")
    )
    catalogue = named(t, [("POS_L_Package:1:12", 12), ("POS_L_Package:1:1", 11), ("WEB:1:1", 13)]).withColumnRenamed("id", "res_id")
    return dict(
        leads=leads, countries=named(t, [("DE", 1), ("FR", 2), ("IT", 3)]), languages=named(t, [("de", 4)]),
        channels=named(t, [("HD", 5), ("DISH", 6), ("MCCDE", 7)]), stores=stores, catalogue=catalogue,
        establishment_type=9, load_date=date(2024, 1, 30),
    )


@query(
    "lead_payload",
    """select c_custkey as metro_id, case when c_acctbal > 0 then 'Ann ' else '' end || c_name as contact_name,
    case c_mktsegment when 'BUILDING' then '1' when 'MACHINERY' then '2' when 'FURNITURE' then '3' end as country_id,
    cast(case when n_regionkey < 3 then n_nationkey + 10 else 0 end as varchar) as store_id,
    case when c_mktsegment <> 'BUILDING' then '4' end as lang_id, case when c_mktsegment = 'MACHINERY' then '5' end as source_id,
    case when c_mktsegment = 'FURNITURE' then '6' else '5' end as medium_id, case when c_mktsegment <> 'BUILDING' then '7' end as reseller_id,
    cast(null as varchar) as partner_assigned_id, 'Company VAT ID: ' || case when c_acctbal > 0 then c_mktsegment else '' end || ', Product codes: '
      || case when c_acctbal < 5000 then 'POS_L_Package; None;NoneWEB;unknown' else 'none' end as description,
    case when c_acctbal < 5000 then case when c_mktsegment in ('BUILDING', 'FURNITURE') then '[12,13]' else '[11,13]' end end as product_ids,
    cast(case when c_acctbal < 5000 then 1 else 0 end as bigint) as unresolved_products
    from customer join nation on c_nationkey = n_nationkey where c_mktsegment <> 'AUTOMOBILE'""",
)
def lead_payload(t: Tables) -> DataFrame:
    payloads, _ = loads.prepare_leads(**lead_inputs(t))
    fields = ("contact_name", "country_id", "store_id", "lang_id", "source_id", "medium_id", "reseller_id", "partner_assigned_id", "description", "product_ids")
    return payloads.select("metro_id", *[F.get_json_object("payload", f"$.{f}").alias(f) for f in fields], "unresolved_products")


@query(
    "lead_rejects",
    "select c_custkey as metro_id, 'metro_id_country is missing' as reject_reason from customer where c_mktsegment = 'AUTOMOBILE'",
)
def lead_rejects(t: Tables) -> DataFrame:
    return loads.prepare_leads(**lead_inputs(t))[1].select("metro_id", "reject_reason")


def opportunity_inputs(t: Tables) -> dict:
    text = lambda c: F.col(c).cast("string")
    opportunities = t.orders.select(
        F.col("o_orderkey").alias("id"), text("o_orderkey").alias("opportunity_id"),
        F.concat(F.lit("Deal "), text("o_orderkey")).alias("opportunity_name"),
        F.lit("none").alias("account_id"), text("o_custkey").alias("company_id"), F.lit("none").alias("establishment_id"),
        F.when(F.col("o_orderstatus") != "F", 3).alias("stage_id"), F.lit(4).alias("user_id"),
        F.col("o_totalprice").alias("expected_revenue"), F.lit(10.0).alias("probability"),
        F.col("o_orderdate").cast("date").alias("close_date"), F.when(F.col("o_orderstatus") == "P", "Mr.").otherwise("Ms.").alias("salutation"),
        F.when(F.col("o_orderstatus") == "P", "Email").alias("utm_medium"), F.lower("o_orderpriority").alias("utm_source"),
        F.when(F.col("o_orderstatus") == "O", "DE").otherwise("YY").alias("country_code"),
        F.when(F.col("o_orderstatus") == "F", "cafe").otherwise("nightclub").alias("est_type"), F.col("o_orderdate").alias("last_modified"),
    )
    contact = t.customer.select(
        F.col("c_custkey").alias("id"), text("c_custkey").alias("partner_uuid"), (F.col("c_acctbal") > 0).alias("is_company"),
        F.lit("contact").alias("type"), F.col("c_name").alias("name"), text("c_nationkey").alias("zip"), F.lit(None).cast("string").alias("vat"),
    )
    lookups = {
        "salutation": named(t, [("Mr.", 1)]), "utm_medium": named(t, [("Email", 2)]), "utm_source": named(t, [("Phone", 3)]),
        "country_code": named(t, [("DE", 5)]), "est_type": named(t, [("cafe", 6), ("nightclub", 7)]),
    }
    return dict(opportunities=opportunities, partners=contact, lookups=lookups)


_OPPORTUNITY = """select cast(o_orderkey as varchar) as opportunity_id, 'Deal ' || o_orderkey as name, case when c_acctbal > 0 then cast(c_custkey as varchar) end as partner_id,
  case when o_orderstatus <> 'F' then '3' end as stage_id, cast(cast(o_orderdate as date) as varchar) as date_deadline, case when o_orderstatus = 'P' then '1' end as title_id, case when o_orderstatus = 'P' then '2' end as medium_id,
  cast(null as varchar) as source_id, case when o_orderstatus = 'O' then '5' end as country_id, case when o_orderstatus = 'F' then '6' else '7' end as establishment_type
  from {} join customer on c_custkey = o_custkey"""


def _opportunity_fields(df: DataFrame) -> DataFrame:
    fields = ("name", "partner_id", "stage_id", "date_deadline", "title_id", "medium_id", "source_id", "country_id", "establishment_type")
    return df.select("opportunity_id", *[F.get_json_object("payload", f"$.{f}").alias(f) for f in fields])


@query("opportunity_payload", _OPPORTUNITY.format("orders") + " where o_orderdate >= timestamp '2001-07-02'")
def opportunity_payload(t: Tables) -> DataFrame:
    return _opportunity_fields(loads.prepare_opportunities(**opportunity_inputs(t), as_of=date(2001, 8, 1), days=30))


@query(
    "opportunity_tile",
    _OPPORTUNITY.format("(select *, ntile(10) over (order by o_orderkey) as tile from orders)") + " where tile = 4",
)
def opportunity_tile(t: Tables) -> DataFrame:
    # One of ten batches of a full load is the feature; all rows are ranked for it.
    return _opportunity_fields(loads.prepare_opportunities(**opportunity_inputs(t), as_of=date(2001, 8, 1), tile=4))


# --- terminals ------------------------------------------------------------------------------------------


def terminal_json(t: Tables) -> DataFrame:
    """Customers as terminals: a JSON text per row, parsed with the record schema."""
    text = F.to_json(
        F.struct(
            F.col("c_custkey").cast("string").alias("id"), F.lit("V400").alias("model"), F.col("c_name").alias("serialNumber"),
            F.struct(
                F.col("c_nationkey").cast("string").alias("storeId"),
                F.when(F.col("c_mktsegment") == "BUILDING", "Inventory").when(F.col("c_mktsegment") != "MACHINERY", "boarded").alias("status"),
            ).alias("assignment"),
            F.struct(
                F.struct(F.col("c_mktsegment").alias("ssid")).alias("wifi"), F.struct(F.lit("on").alias("status")).alias("cellular")
            ).alias("connectivity"),
        )
    )
    return t.customer.select(F.from_json(text, terminals.TERMINAL).alias("r")).select("r.*")


@query(
    "json_flatten_terminals",
    "select "
    + ", ".join(
        {
            "terminal_id": "cast(c_custkey as varchar) as terminal_id", "model": "'V400' as model", "serial_number": "c_name as serial_number",
            "store_id": "cast(c_nationkey as varchar) as store_id", "wifi_ssid": "c_mktsegment as wifi_ssid", "cellular_status": "'on' as cellular_status",
            "assignment_status": "case when c_mktsegment = 'BUILDING' then 'Inventory' when c_mktsegment <> 'MACHINERY' then 'boarded' end as assignment_status",
        }.get(c, f"cast(null as varchar) as {c}")
        for c in terminals.TERMINAL_FIELDS
    )
    + " from customer",
)
def json_flatten_terminals(t: Tables) -> DataFrame:
    return terminals.flatten_terminals(terminal_json(t))


@query(
    "json_flatten_merchants",
    """select cast(s_suppkey as varchar) as merchant_id, s_name as merchant_name, 'https://x/' || s_suppkey as self_url, cast(null as varchar) as users_url,
    case when s_acctbal > 0 then 'eu:' || s_nationkey else '' end as centres from supplier""",
)
def json_flatten_merchants(t: Tables) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    centre = F.struct(F.lit("eu").alias("name"), F.col("s_nationkey").cast("string").alias("livePrefix"))
    text = F.to_json(
        F.struct(
            key.alias("id"), F.col("s_name").alias("name"), F.when(F.col("s_acctbal") > 0, F.array(centre)).alias("dataCenters"),
            F.struct(F.struct(F.concat(F.lit("https://x/"), key).alias("href")).alias("self")).alias("_links"),
        )
    )
    flat = terminals.flatten_merchants(t.supplier.select(F.from_json(text, terminals.MERCHANT).alias("r")).select("r.*"))
    centres = F.transform("data_centers", lambda c: F.concat_ws(":", c["name"], c["live_prefix"]))
    return flat.select("merchant_id", "merchant_name", "self_url", "users_url", F.concat_ws(",", centres).alias("centres"))


@query(
    "json_flatten_stores",
    """select cast(s_suppkey as varchar) as store_id, s_name as store_reference, 'city ' || s_nationkey as store_city, cast(null as varchar) as store_postal_code from supplier""",
)
def json_flatten_stores(t: Tables) -> DataFrame:
    text = F.to_json(
        F.struct(
            F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("reference"),
            F.struct(F.concat(F.lit("city "), F.col("s_nationkey").cast("string")).alias("city")).alias("address"),
        )
    )
    flat = terminals.flatten_stores(t.supplier.select(F.from_json(text, terminals.STORE).alias("r")).select("r.*"))
    return flat.select("store_id", "store_reference", "store_city", "store_postal_code")


def settings_rows(t: Tables) -> DataFrame:
    """Purchases carry two allowed groups, clicks none, errors no settings at all."""
    e = F.col("event_type")
    text = F.when(
        e == "purchase", F.concat(F.lit('{"gratuities":'), F.col("props"), F.lit(',"secret":1,"opi":{"on":true}}'))
    ).when(e == "click", '{"secret":1}').when(e != "error", F.concat(F.lit('{"payment":'), F.col("props"), F.lit("}")))
    return t.events.select(F.col("event_id").cast("string").alias("terminal_id"), text.alias("settings"))


@query(
    "settings_whitelist",
    """select cast(event_id as varchar) as terminal_id, case when event_type = 'purchase' then 'gratuities,opi' else 'payment' end as groups,
    cast(json_extract_string(props, '$.k') as varchar) as k from events where event_type not in ('click', 'error')""",
)
def settings_whitelist(t: Tables) -> DataFrame:
    kept, _ = terminals.filter_settings(settings_rows(t))
    value = F.coalesce(F.try_element_at("settings", F.lit("gratuities")), F.try_element_at("settings", F.lit("payment")))
    return kept.select(
        "terminal_id", F.concat_ws(",", F.array_sort(F.map_keys("settings"))).alias("groups"), F.get_json_object(value, "$.k").alias("k")
    )


@query(
    "settings_counts",
    """select count(*) as total, count(*) filter (where event_type not in ('click', 'error')) as success, count(*) filter (where event_type = 'error') as failed,
    count(*) filter (where event_type = 'click') as skipped_empty, false as nothing_left from events""",
)
def settings_counts(t: Tables) -> DataFrame:
    return terminals.filter_settings(settings_rows(t))[1]


@query(
    "terminal_inventory",
    """with allowed as (select cast(event_id as varchar) as id, event_type as e from events),
    wanted as (select cast(c_custkey as varchar) as id from customer where c_mktsegment <> 'BUILDING'),
    mine as (select id, e from allowed where id in (select id from wanted))
    select 'merchants' as part, count(*) as n, cast(sum(s_suppkey) as bigint) as ids from supplier
    union all select 'stores', count(*), cast(sum(s_suppkey) as bigint) from supplier
    union all select 'terminals', count(*), cast(sum(c_custkey) as bigint) from customer
    union all select 'terminal_settings', count(*), cast(sum(cast(id as bigint)) as bigint) from mine where e not in ('click', 'error')
    union all select 'settings_counts', (select count(*) from mine where e not in ('click', 'error')), count(*) from mine""",
)
def terminal_inventory(t: Tables) -> DataFrame:
    """The whole run: its five tables, each by its rows and the sum of its ids.

    Settings are those of the terminals that are in use; their counts give successes and total.
    """
    merchant = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))
    read = lambda df, kind: df.select(F.from_json(F.to_json(F.struct("*")), kind).alias("r")).select("r.*")
    run = terminals.terminal_inventory(
        read(merchant, terminals.MERCHANT), read(merchant.select("id"), terminals.STORE), terminal_json(t), settings_rows(t)
    )
    keys = {"merchants": "merchant_id", "stores": "store_id", "terminals": "terminal_id", "terminal_settings": "terminal_id"}
    sums = [
        run[name].agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"), F.sum(F.col(key).cast("bigint")).alias("ids"))
        for name, key in keys.items()
    ]
    counts = run["settings_counts"].select(F.lit("settings_counts").alias("part"), F.col("success").alias("n"), F.col("total").alias("ids"))
    return union_all([*sums, counts])


def action_rows(t: Tables) -> DataFrame:
    e = F.col("event_type")
    return t.events.select(
        F.when(e != "error", F.concat(F.lit(" "), F.col("event_id").cast("string"), F.lit(" "))).alias("terminal_id"),
        F.when(e == "signup", "  ").when(e != "click", F.col("user_id").cast("string")).alias("store_id"),
        (F.col("value") > 20).alias("to_disable_standalone_tip"),
        e.alias("event_type"),
    )


@query(
    "action_worklists",
    """select 'reassign' as action, cast(event_id as varchar) as terminal_id, cast(user_id as varchar) as store_id from events where event_type in ('view', 'purchase')
    union all select 'patch', cast(event_id as varchar), null from events where event_type <> 'error' and value > 20""",
)
def action_worklists(t: Tables) -> DataFrame:
    pairs, _ = terminals.reassign_worklist(action_rows(t))
    patches, _ = terminals.patch_worklist(action_rows(t))
    return pairs.select(F.lit("reassign").alias("action"), "terminal_id", "store_id").unionByName(
        patches.select(F.lit("patch").alias("action"), "terminal_id", F.lit(None).cast("string").alias("store_id"))
    )


@query(
    "outcome_summary",
    """select count(*) filter (where event_type in ('view', 'purchase')) as processed, count(*) filter (where event_type = 'view') as success,
    count(*) filter (where event_type = 'purchase') as failed, count(*) filter (where event_type = 'signup') as skipped from events""",
)
def outcome_summary_rows(t: Tables) -> DataFrame:
    ok, skipped = drop_blank(action_rows(t), ["terminal_id", "store_id"])
    done = ok.withColumn("outcome", F.when(F.col("event_type") == "view", "success").otherwise("failed"))
    return outcome_summary(done, "outcome", skipped)


@query("inventory_skipped", "select count(*) as n from customer where c_mktsegment <> 'BUILDING'")
def inventory_skipped(t: Tables) -> DataFrame:
    flat = terminals.flatten_terminals(terminal_json(t))
    return exclude_status(flat, "assignment_status", "inventory").agg(F.count(F.lit(1)).alias("n"))
