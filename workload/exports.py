"""The export jobs on inputs that are derived column by column from the test tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import rename
from tidemark.functions.clock import VALID_FLAG, VALID_FROM, in_window, since
from tidemark.functions.contracts import ASSET, ASSET_NAMES, LEAD, PARTNER_MATCHING, VOUCHER, wire_form
from tidemark.operators.joins import price_lookup
from tidemark.plans import assets, commission, lifecycle, matching_export, products, scoring
from tidemark.sources.tables import event_batches
from workload.base import Tables, query

AS_OF = date(2024, 1, 30)


# --- scoring: customers are establishments; rich ones are linked in the CRM ---------------


def scoring_inputs(t: Tables) -> dict[str, DataFrame]:
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    country = F.col("n_name")
    linked = F.col("c_acctbal") >= 4000
    crm_id = F.when(linked, F.concat(F.lit("E"), F.col("c_custkey").cast("string")))
    establishments = c.select(
        country.alias("country"),
        F.col("c_custkey").alias("metro_id"),
        F.col("c_name").alias("establishment_name"),
        crm_id.alias("sfdc_establishment_id"),
        F.when(linked, F.lit("A")).alias("sfdc_account_id"),
        F.concat(F.lit("Street "), F.col("c_nationkey").cast("string")).alias("street_name"),
        F.col("c_nationkey").cast("string").alias("street_number"),
        F.lit("10115").alias("postal_code"),
        F.col("c_mktsegment").alias("city"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("phone"),
        F.lit("mail").alias("email"),
        F.col("c_mktsegment").alias("establishment_type"),
        country.alias("iso_code"),
    )
    prob = F.col("c_acctbal") / 10000
    in_segment = lambda *s: F.col("c_mktsegment").isin(*s).cast("int")
    prospects = t.customer.select(
        F.col("c_custkey").alias("metro_id"),
        F.lit("XX").alias("country_code"),
        prob.alias("FBO_dish_prob"),
        in_segment("BUILDING").alias("FBO_dish_recommendation"),
        F.when(F.col("c_mktsegment") == "BUILDING", "very_high_potential")
        .when(F.col("c_mktsegment") == "FURNITURE", "high_potential")
        .otherwise("low")
        .alias("FBO_dish_bundle_cat"),
        prob.alias("FBO_dish_bundle_prob"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("FBO_dish_bundle_recommendation"),
        in_segment("BUILDING", "MACHINERY").alias("FBO_dish_pos_recommendation"),
        prob.alias("FBO_dish_pos_prob"),
        in_segment("FURNITURE").alias("FBO_dish_pay_recommendation"),
        prob.alias("FBO_dish_pay_prob"),
    )
    customers = t.customer.select(
        F.concat(F.lit("E"), F.col("c_custkey").cast("string")).alias("establishment_sfid"),
        F.lit("XX").alias("country_code"),
        in_segment("BUILDING", "MACHINERY").alias("NBO_dish_reservation_recommendation"),
        prob.alias("NBO_dish_reservation_prob"),
        in_segment("BUILDING", "FURNITURE").alias("NBO_dish_order_recommendation"),
        (prob / 2).alias("NBO_dish_order_prob"),
        F.when(F.col("c_mktsegment") == "BUILDING", "High Potential")
        .when(F.col("c_mktsegment") == "MACHINERY", "Potential")
        .alias("NBO_dish_bundle_cat"),
        prob.alias("NBO_dish_bundle_prob"),
        F.col("c_mktsegment").alias("NBO_dish_bundle_recommendation"),
        in_segment("MACHINERY").alias("NBO_dish_pos_recommendation"),
        prob.alias("NBO_dish_pos_prob"),
        in_segment("AUTOMOBILE").alias("NBO_dish_pay_recommendation"),
        prob.alias("NBO_dish_pay_prob"),
    )
    allowed = c.select(
        country.alias("country"),
        F.col("c_custkey").alias("metro_id"),
        F.when(F.col("c_acctbal") < 0, 2).otherwise(1).alias("status_cd"),
        F.when(F.col("c_nationkey") == 9, F.lit(None)).otherwise(F.col("c_nationkey").cast("string")).alias("blocking_reason_cd"),
        F.when(F.col("c_nationkey") == 11, 65).otherwise(1).alias("entry_check_cd"),
        F.when(F.col("c_nationkey") == 12, 31).otherwise(1).alias("checkout_check_cd"),
    )
    persons = c.select(
        country.alias("country"),
        F.col("c_custkey").alias("unique_metro_id"),
        F.lit("First").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(F.col("c_nationkey") == 13, 2).otherwise(1).alias("auth_person_id"),
    )
    return dict(establishments=establishments, prospects=prospects, customers=customers, allowed=allowed, persons=persons)


SCORING_SQL = """
rows as (
  select c_custkey as metro_id,
    case when c_acctbal >= 4000 then 'E' || c_custkey end as establishment_id,
    c_name as establishment_name, 'Street ' || c_nationkey as street_name, cast(c_nationkey as varchar) as street_number,
    '10115' as postal_code, c_mktsegment as city, n_name as iso_code,
    'First, ' || c_name || ', ' || case when c_acctbal > 0 then c_name end || ', mail' as manager_information,
    'First' as first_name, case when c_acctbal > 0 then c_name end as mobilephone, c_mktsegment as establishment_type,
    case when c_acctbal >= 4000
      then case c_mktsegment when 'BUILDING' then 1 when 'MACHINERY' then 2 else 3 end
      else case c_mktsegment when 'BUILDING' then 1 when 'FURNITURE' then 2 else 3 end end as potential_level,
    case when c_acctbal >= 4000 or c_mktsegment <> 'HOUSEHOLD' then c_mktsegment end as bundle_recommendation,
    round(c_acctbal / 10000, 4) as bundle_potential_score,
    cast(case when c_acctbal >= 4000 then c_mktsegment = 'MACHINERY' else c_mktsegment in ('BUILDING', 'MACHINERY') end as bigint) as pos_recommendation,
    round(c_acctbal / 10000, 4) as pos_potential_score,
    cast(case when c_acctbal >= 4000 then c_mktsegment = 'AUTOMOBILE' else c_mktsegment = 'FURNITURE' end as bigint) as pay_recommendation,
    round(c_acctbal / 10000, 4) as pay_potential_score,
    '2024-01-30' as _ldts
  from customer join nation on c_nationkey = n_nationkey
  where c_acctbal >= 0 and c_nationkey not in (2, 3, 4, 6, 7, 8, 9, 11, 12, 13)),
snapshot as (select *,
  md5(iso_code || '|' || metro_id) as _keyhash,
  md5(metro_id || '|' || coalesce(establishment_id, '') || '|' || street_name || '|' || street_number || '|' || postal_code
    || '|' || city || '|' || iso_code || '|' || coalesce(manager_information, '') || '|' || first_name || '|' || coalesce(mobilephone, '')
    || '|' || establishment_type || '|' || potential_level || '|' || bundle_recommendation
    || '|' || cast(cast(bundle_potential_score as decimal(38,4)) as varchar) || '|' || pos_recommendation
    || '|' || cast(cast(pos_potential_score as decimal(38,4)) as varchar) || '|' || pay_recommendation
    || '|' || cast(cast(pay_potential_score as decimal(38,4)) as varchar)) as _rowhash,
  timestamp '2024-01-30' as _valid_from, timestamp '2099-12-31 23:59:59' as _valid_until, true as _valid_flag
  from rows where bundle_recommendation is not null)
"""


@query("scoring_snapshot", f"with {SCORING_SQL} select * from snapshot")
def scoring_snapshot(t: Tables) -> DataFrame:
    return scoring.scoring_snapshot(**scoring_inputs(t), as_of=AS_OF)


@query(
    "country_payload",
    f"""with {SCORING_SQL} select metro_id, coalesce(establishment_id, '') as establishment_id, establishment_name, street_name,
    street_number, postal_code, city, iso_code, coalesce(manager_information, '') as manager_information, first_name,
    coalesce(mobilephone, '') as mobilephone, establishment_type, coalesce(potential_level, 99) as potential_level,
    bundle_recommendation, bundle_potential_score, pos_recommendation, pos_potential_score, pay_recommendation, pay_potential_score, _ldts
    from snapshot where upper(iso_code) = 'NATION_14'""",
)
def country_payload(t: Tables) -> DataFrame:
    snapshot = scoring.scoring_snapshot(**scoring_inputs(t), as_of=AS_OF)
    return scoring.scoring_payload(snapshot, "nation_14")


@query(
    "upsell_scores",
    """select distinct 'E' || c_custkey as crm_id, 'XX' as country_code,
    case when c_mktsegment = 'BUILDING' then (c_acctbal / 10000 + c_acctbal / 10000 / 2) / 2
      when c_mktsegment = 'FURNITURE' then c_acctbal / 10000 / 2 when c_mktsegment = 'MACHINERY' then c_acctbal / 10000
      else (c_acctbal / 10000 + c_acctbal / 10000 / 2) / 2 end as upsell_proba,
    case when c_mktsegment in ('BUILDING', 'FURNITURE', 'MACHINERY') then 1 else 0 end as sf_cust_pre from customer""",
)
def upsell_scores(t: Tables) -> DataFrame:
    scored = scoring.customer_scores(scoring_inputs(t)["customers"])
    return scored.select("crm_id", "country_code", "upsell_proba", "sf_cust_pre").distinct()


# --- commission: line items as invoice lines, brands as priced products -------------------


def commission_inputs(t: Tables) -> dict[str, DataFrame]:
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.when(F.col("l_linenumber") == 7, "R").otherwise("B"), F.col("l_orderkey").cast("string")).alias("ParentBill"),
        F.col("l_shipdate").alias("BookingDate"),
        F.col("l_shipdate").alias("ActualDeliveryStart"),
        F.when(F.col("l_tax") >= 0.02, "France").otherwise("Germany").alias("SalesRegion"),
        F.concat(F.lit(" Company "), F.col("l_suppkey").cast("string")).alias("Company"),
        F.when(F.col("l_returnflag") == "A", " PARTNER-A ").when(F.col("l_quantity") > 45, "DIRECT").alias("SalesAgencyID"),
        F.lit("shop ").alias("Merchant"),
        F.col("l_orderkey").cast("string").alias("SalesforceOrderID"),
        F.concat(F.lit(" E"), F.col("l_suppkey").cast("string"), F.lit(" ")).alias("SalesforceEstablishmentID"),
        F.col("l_suppkey").cast("string").alias("SalesforceAccountID"),
        F.when(F.col("p_size") == 50, "ContractPenalty").otherwise(F.col("p_brand")).alias("ProductCode"),
        F.when(F.col("p_size") != 49, F.col("p_brand")).alias("ProductBaseCode"),
        F.concat("p_name", F.when(F.col("p_type") == "PROMO", " Fees").otherwise("")).alias("ProductName"),
        F.col("p_type").alias("Label"),
        F.when(F.col("l_returnflag") == "A", True).when(F.col("l_returnflag") == "R", False).alias("ProductIsSetup"),
        F.when(F.col("l_linestatus") == "O", "discount").alias("PriceAdjustment"),
        F.col("l_quantity").alias("Quantity"),
        F.col("p_retailprice").alias("UnitPrice"),
        F.col("l_extendedprice").alias("NetPriceEUR"),
        F.when(F.col("l_tax") == 0.08, "out_refund").otherwise("out_invoice").alias("EntryType"),
    )
    book = t.part.groupBy("p_brand").agg(F.min("p_retailprice").alias("low"), F.max("p_retailprice").alias("high"))
    periods = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(f).alias("fee"), F.lit(k).alias("k"))
            for a, b, k in (
                (date(1990, 1, 1), date(1996, 12, 31), 1),
                (date(1997, 1, 1), date(1998, 12, 31), 2),
                (date(1999, 1, 1), date(2099, 12, 31), 3),
            )
            for f in ("Activation", "Recurring")
        ]
    )
    prices = book.select("*", F.inline(periods)).select(
        F.lit("FR").alias("country"),
        F.col("p_brand").alias("product_code"),
        F.col("fee").alias("fee_type"),
        F.col("a").alias("price_start_date"),
        F.col("b").alias("price_end_date"),
        (F.col("low") * F.col("k")).alias("platform_cost_eur"),
        F.col("high").alias("partner_commission_eur"),
        F.when(F.col("p_brand") == "Brand#7", 0.0).otherwise(F.col("low") * 4).alias("customer_cost_local"),
    )
    customers = t.supplier.select(
        F.concat(F.lit("E"), F.col("s_suppkey").cast("string")).alias("establishment_uid"),
        F.col("s_suppkey").alias("clean_customer_id"),
        F.col("s_name").alias("business_registry_no"),
    )
    return dict(lines=lines, prices=prices, customers=customers)


_D = "cast({} as decimal(18,4))"
_MEASURES = {
    "theoretica_oneshot_amount": "sum(net) filter (where not promo)",
    "actual_oneshot_amount": "sum(net)",
    "theoretical_MFR_commission_oneshot": "sum(cast(partner_list / nullif(customer_list, 0) * cast(net as double) as decimal(28,10))) filter (where not promo)",
    "promotions_amount_oneshot": "sum(case when promo then net else 0 end)",
    "net_group_oneshot": "sum(net) filter (where not promo)",
    "net_MFR_oneshot": "sum(net)",
    "monthly_invoiced_subscription": "sum(case when not setup then net else 0 end)",
    "theoretical_MFR_commission_monthly": "sum(cast(partner_list as decimal(28,10))) filter (where not promo)",
    "amount_promotions_recurring": "sum(case when not setup and promo then net else 0 end)",
    "net_group_monthly": "sum(case when not setup and not promo then net else 0 end)",
    "net_MFR_monthly": "sum(cast(partner_list as decimal(28,10))) filter (where not promo) + sum(case when not setup and promo then net else 0 end)",
    "total_theoretical_reccuring_monthly_MFR": "sum(case when not setup and not promo then net else 0 end)",
    "total_theoretical_one_shot_monthly_MFR": "sum(case when setup and not promo then net else 0 end)",
    "total_promotion_one_shot": "sum(case when setup and promo then net else 0 end)",
    "total_promotion_reccuring": "sum(case when not setup and promo then net else 0 end)",
    "total_commission_reccuring_MFR": "sum(case when not setup then net else 0 end)",
    "total_commission_one_shot_MFR": "sum(case when setup then net else 0 end)",
    "total_monthly_promo": "sum(case when promo then net else 0 end)",
    "total_monthly_DISH": "sum(cast(platform_list / nullif(customer_list, 0) * cast(net as double) as decimal(28,10))) filter (where not promo)",
    "total_invoiced": "sum(net)",
}
_KEYS = ", ".join(commission.KEYS)
_TEXT = [f"coalesce(cast({k} as varchar), '')" for k in commission.KEYS] + ["coalesce(cast(quantity as varchar), '')"]
_TEXT += [f"coalesce(cast(cast({m} as decimal(38,4)) as varchar), '')" for m in commission.MEASURES if m != "quantity"]
COMMISSION_SQL = f"""
book as (select p_brand, min(p_retailprice) as low, max(p_retailprice) as high from part group by 1),
periods as (select * from (values (date '1990-01-01', date '1996-12-31', 1), (date '1997-01-01', date '1998-12-31', 2),
  (date '1999-01-01', date '2099-12-31', 3)) p(a, b, k)),
prices as (select p_brand, fee, a, b, low * k as platform, high as partner, case when p_brand = 'Brand#7' then 0 else low * 4 end as cust
  from book, periods, (values ('A'), ('R')) f(fee)),
src as (select *, l_linestatus = 'O' as promo, case l_returnflag when 'A' then true when 'R' then false end as setup
  from lineitem join part on l_partkey = p_partkey
  where l_linenumber <> 7 and l_tax >= 0.02 and l_tax <> 0.08 and (l_returnflag = 'A' or l_quantity <= 45)
    and p_size not in (49, 50) and p_type <> 'PROMO' and l_shipdate >= timestamp '1996-01-01'),
lines as (select 'B' || l_orderkey as parent_bill, cast(l_shipdate as date) as booking_date, cast(l_shipdate as date) as actual_delivery_start,
  'France' as billing_country, 'FR' as billing_country_code, 'Company ' || l_suppkey as company,
  case when l_returnflag = 'A' then 'PARTNER-A' end as sales_agency_id, 'shop' as merchant,
  cast(l_orderkey as varchar) as salesforce_order_id, 'E' || l_suppkey as salesforce_establishment_id,
  cast(l_suppkey as varchar) as salesforce_account_id, s_suppkey as metro_id, s_name as siren_no, src.p_brand as product_code,
  src.p_brand as product_base_code, p_type as label, setup, promo, cast(l_quantity as decimal(18,4)) as qty,
  cast(p_retailprice as decimal(18,4)) as unit_price, cast(l_extendedprice as decimal(18,4)) as net,
  coalesce(platform, 0) * l_quantity as platform_list, coalesce(partner, 0) * l_quantity as partner_list,
  coalesce(cust, 0) * l_quantity as customer_list
  from src left join prices p on p.p_brand = src.p_brand and p.fee = l_returnflag and l_shipdate between a and b
  left join supplier on s_suppkey = l_suppkey),
measured as (select {_KEYS}, cast(round(sum(qty) filter (where not promo), 0) as bigint) as quantity,
  cast(round(max(unit_price) filter (where not promo), 2) as double) as price_per_unit,
  {", ".join(f"cast(round({sql}, 2) as double) as {name}" for name, sql in _MEASURES.items())}
  from lines group by {_KEYS})
"""


@query(
    "commission_snapshot",
    f"""with {COMMISSION_SQL} select *, date '2024-01-30' as _ldts,
    md5(parent_bill || '|' || salesforce_establishment_id) as _keyhash,
    md5({" || '|' || ".join(_TEXT)}) as _rowhash,
    timestamp '2024-01-30' as _valid_from, timestamp '2099-12-31 23:59:59' as _valid_until, true as _valid_flag from measured""",
)
def commission_snapshot(t: Tables) -> DataFrame:
    return commission.commission_snapshot(**commission_inputs(t), as_of=AS_OF, first_booking=date(1996, 1, 1))


def _periods(t: Tables, overlap: bool) -> DataFrame:
    first_end = date(1997, 6, 30) if overlap else date(1996, 12, 31)
    spans = F.array(
        *[
            F.struct(F.lit(a).alias("start_date"), F.lit(b).alias("end_date"), F.lit(k).alias("k"))
            for a, b, k in (
                (date(1995, 6, 1), first_end, 1.0),
                (date(1997, 1, 1), date(1998, 12, 31), 1.1),
                (date(1999, 1, 1), date(2000, 12, 31), 1.2),
            )
        ]
    )
    fee = F.when(F.col("p_size") > 25, "activation").otherwise("recurring")
    return t.part.select("p_partkey", fee.alias("fee_type"), "p_retailprice", F.inline(spans)).select(
        "p_partkey", "fee_type", "start_date", "end_date", F.round(F.col("p_retailprice") * F.col("k"), 2).alias("price")
    )


def _periods_sql(first_end: str) -> str:
    return f"""prices as (select p_partkey, case when p_size > 25 then 'activation' else 'recurring' end as fee_type,
    start_date, end_date, round(p_retailprice * k, 2) as price from part, (values (date '1995-06-01', date '{first_end}', 1.0::double),
    (date '1997-01-01', date '1998-12-31', 1.1::double), (date '1999-01-01', date '2000-12-31', 1.2::double)) s(start_date, end_date, k))"""


def _fee_lines(t: Tables) -> DataFrame:
    fee = F.when(F.col("l_returnflag") == "A", "activation").when(F.col("l_returnflag") == "R", "recurring")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", fee.alias("fee")
    )


_FEE_SQL = """lines as (select l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate,
  case l_returnflag when 'A' then 'activation' when 'R' then 'recurring' end as fee from lineitem)"""
_PRICE_ON = [("l_partkey", "p_partkey"), ("fee", "fee_type")]


@query(
    "price_lookup_range",
    f"""with {_periods_sql('1997-06-30')}, {_FEE_SQL} select lines.*, price from lines left join prices
    on l_partkey = p_partkey and fee = fee_type and l_shipdate between start_date and end_date""",
)
def price_lookup_range(t: Tables) -> DataFrame:
    return price_lookup(
        _fee_lines(t), _periods(t, True), _PRICE_ON, "l_shipdate", "start_date", "end_date", {"price": "price"}
    )


@query(
    "price_lookup_latest",
    f"""with {_periods_sql('1997-06-30')}, {_FEE_SQL} select distinct lines.*, (select max_by(price, start_date) from prices
    where l_partkey = p_partkey and fee = fee_type and l_shipdate between start_date and end_date) as price from lines""",
)
def price_lookup_latest(t: Tables) -> DataFrame:
    lines = _fee_lines(t).distinct()
    return price_lookup(
        lines, _periods(t, True), _PRICE_ON, "l_shipdate", "start_date", "end_date", {"price": "price"},
        pick="latest_start", line_id=lines.columns,
    )


# --- CRM assets ----------------------------------------------------------------------------


def asset_input(t: Tables) -> DataFrame:
    text = {c: F.lit(None).cast("string") for c in ("ChannelV2", "Referrer", "ActivatedBy", "ShippingPostalCode", "PersonEmail", "Crm_Metro_Id", "VAT_id", "_create_ts", "_update_ts")}
    return t.supplier.select(
        F.concat(F.lit("U"), F.col("s_nationkey").cast("string")).alias("establishment_UID"),
        F.col("s_name").alias("Product"),
        F.lit("2024-01-05").alias("InstallDate"),
        F.when(F.col("s_acctbal") < 0, "2024-01-20").alias("DisabledDate"),
        F.when(F.col("s_acctbal") < 0, "Disabled").otherwise("Active").alias("Status"),
        F.col("s_name").alias("Establishment_name"),
        F.lit("city").alias("ShippingCity"),
        F.lit("street").alias("ShippingStreet"),
        F.when(F.col("s_acctbal") < 0, "false").otherwise("true").alias("email_permission"),
        F.col("s_suppkey").alias("AccountId_Long"),
        F.col("s_acctbal").alias("Store_Id"),
        F.col("s_nationkey").cast("string").alias("Crm_Account_Identifier"),
        F.col("s_suppkey").alias("metro_id"),
        F.col("s_suppkey").alias("cust_no"),
        F.lit(None).cast("bigint").alias("home_store_id"),
        *[c.alias(n) for n, c in text.items()],
    )


@query(
    "asset_snapshot",
    """with a as (select 'U' || s_nationkey as establishment_UID, s_name as Product, cast(null as varchar) as ChannelV2,
    cast(null as varchar) as Referrer, cast(null as varchar) as ActivatedBy, date '2024-01-05' as InstallDate,
    case when s_acctbal < 0 then date '2024-01-20' end as DisabledDate, case when s_acctbal < 0 then 'Disabled' else 'Active' end as Status,
    s_name as Establishment_name, cast(null as varchar) as ShippingPostalCode, 'city' as ShippingCity, 'street' as ShippingStreet,
    cast(null as varchar) as PersonEmail, s_acctbal >= 0 as email_permission, cast(s_suppkey as varchar) as AccountId_Long,
    cast(null as varchar) as Crm_Metro_Id, cast(round(cast(s_acctbal as decimal(18,4)), 0) as bigint) as Store_Id, cast(s_nationkey as bigint) as Crm_Account_Identifier,
    cast(null as varchar) as VAT_id, s_suppkey as metro_id, s_suppkey as cust_no, cast(null as bigint) as home_store_id,
    cast(null as varchar) as _create_ts, cast(null as varchar) as _update_ts from supplier)
    select *, date '2024-01-30' as _ldts, md5(establishment_UID || '|' || Crm_Account_Identifier) as _keyhash,
    md5(establishment_UID || '|' || Product || '||||' || InstallDate || '|' || coalesce(cast(DisabledDate as varchar), '') || '|' || Status || '|'
      || Establishment_name || '||' || ShippingCity || '|' || ShippingStreet || '||' || email_permission || '|' || AccountId_Long || '||'
      || Store_Id || '|' || Crm_Account_Identifier || '||' || metro_id || '|' || cust_no || '|||') as _rowhash,
    timestamp '2024-01-30' as _valid_from, timestamp '2099-12-31 23:59:59' as _valid_until, true as _valid_flag from a""",
)
def asset_snapshot(t: Tables) -> DataFrame:
    return assets.asset_snapshot(asset_input(t), AS_OF)


# --- events as leads, assets, vouchers, tickets and invoices ---------------------------------


def lead_input(t: Tables) -> DataFrame:
    given = {
        "lead_id": F.col("event_id"),
        "metro_id": F.col("user_id"),
        "lead_source": F.col("event_type"),
        "status": F.when(F.col("event_type") != "error", F.col("event_type")),
        "lead_country_code": F.when(F.col("value") < 20, "fr").otherwise("de"),
        "_ldts": F.col("ts").cast("date"),
    }
    cols = {c: given.get(c, F.lit(None).cast("string")) for c in LEAD.names}
    return t.events.select(
        *[v.alias(k) for k, v in cols.items()],
        F.col("ts").alias(VALID_FROM),
        (F.col("event_type") != "signup").alias(VALID_FLAG),
    )


@query(
    "lifecycle_leads",
    "select distinct "
    + ", ".join(
        {
            "lead_id": "cast(event_id as varchar) as lead_id",
            "metro_id": "cast(user_id as varchar) as metro_id",
            "lead_source": "event_type as lead_source",
            "status": "case when event_type <> 'error' then event_type else '' end as status",
            "lead_country_code": "'fr' as lead_country_code",
            "_ldts": "cast(ts as date) as _ldts",
        }.get(c, f"'' as {c}")
        for c in LEAD.names
    )
    + " from events where event_type <> 'signup' and value < 20 and ts >= timestamp '2024-01-30'",
)
def lifecycle_leads(t: Tables) -> DataFrame:
    return lifecycle.lead_delta(lead_input(t), AS_OF, "FR")


_KIND = {"STRING": "varchar", "BIGINT": "bigint", "INT": "integer", "FLOAT": "float", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date"}


def asset_events(t: Tables) -> DataFrame:
    given = {
        "asset_UID": F.col("event_id").cast("string"),
        "sfdc_internal_establishment_id": F.col("user_id"),
        "country_code": F.when(F.col("value") < 20, "fr").otherwise("de"),
        "asset_name": F.col("event_type"),
        "price": F.col("value").cast("float"),
        "asset_install_date": F.col("ts").cast("date"),
        "odoo_Onboarding_status": F.lit(1),
        "establishment_active": F.when(F.col("value") < 5, 1).when(F.col("value") < 10, 0),
        "_ldts": F.col("ts").cast("date"),
    }
    types = {f.name: f.dataType for f in ASSET.fields}
    cols = {
        c: given.get(c, F.lit(None).cast(types.get(c, types["quantity"]))) for c in lifecycle.ASSET_COLUMNS
    }
    return t.events.select(
        *[v.alias(k) for k, v in cols.items()],
        F.col("ts").alias(VALID_FROM),
        (F.col("event_type") != "signup").alias(VALID_FLAG),
    )


@query(
    "lifecycle_assets",
    "select distinct "
    + ", ".join(
        {
            "asset_UID": "cast(event_id as varchar) as asset_UID",
            "sfdc_internal_establishment_id": "cast(user_id as varchar) as sfdc_internal_establishment_id",
            "country_code": "'fr' as country_code",
            "asset_name": "event_type as asset_name",
            "price": "cast(value as float) as price",
            "asset_install_date": "cast(cast(ts as date) as varchar) as asset_install_date",
            "odoo_Onboarding_flag": "1 as odoo_Onboarding_flag",
            "establishment_active": "value < 5 as establishment_active",
            "_ldts": "cast(ts as date) as _ldts",
        }.get(f.name, f"cast(null as {_KIND[f.dataType.simpleString().upper()]}) as {f.name}")
        for f in ASSET.fields
    )
    + " from events where event_type <> 'signup' and value < 20 and ts >= timestamp '2024-01-30'",
)
def lifecycle_assets(t: Tables) -> DataFrame:
    return rename(lifecycle.asset_delta(asset_events(t), AS_OF, "FR"), ASSET_NAMES)


def voucher_input(t: Tables) -> DataFrame:
    given = {
        "asset_id": F.col("event_id"),
        "partner_id": F.col("user_id"),
        "discount_code": F.col("event_type"),
        "price": F.col("value"),
        "recurring_invoice": F.col("value") > 5,
        "is_subscription": F.col("event_type") == "purchase",
        "asset_created_date": F.col("ts"),
        "country_code": F.when(F.col("value") < 20, "fr").otherwise("de"),
    }
    return t.events.select(*[given.get(c, F.lit(None).cast("string")).alias(c) for c in VOUCHER.names])


@query(
    "vouchers_window",
    "select "
    + ", ".join(
        {
            "asset_id": "cast(event_id as varchar) as asset_id",
            "partner_id": "user_id as partner_id",
            "discount_code": "event_type as discount_code",
            "price": "value as price",
            "recurring_invoice": "value > 5 as recurring_invoice",
            "is_subscription": "event_type = 'purchase' as is_subscription",
            "asset_created_date": "cast(ts as varchar) as asset_created_date",
            "country_code": "'fr' as country_code",
        }.get(c, f"cast(null as varchar) as {c}")
        for c in VOUCHER.names
    )
    + " from events where value < 20 and ts >= timestamp '2024-01-29'",
)
def vouchers_window(t: Tables) -> DataFrame:
    return lifecycle.voucher_delta(voucher_input(t), AS_OF, "FR")


@query(
    "yesterday_extract",
    """select cast(event_id as varchar) as ticket_number, event_type as ticket_name, cast(ts as varchar) as create_date,
    event_type as ticket_type, cast(null as varchar) as ticket_tag, cast(ts + interval 1 day as varchar) as close_date,
    cast(null as varchar) as country, cast(null as varchar) as escalated_check, cast(null as varchar) as current_status,
    cast(null as varchar) as ticket_medium, cast(null as varchar) as account_identifier, cast(user_id as varchar) as customer_id,
    cast(user_id as integer) as store_id
    from events where event_type <> 'error' and ts >= timestamp '2024-01-29' and ts < timestamp '2024-01-30'""",
)
def yesterday_extract(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    tickets = t.events.select(
        F.when(F.col("event_type") != "error", F.col("event_id").cast("string")).alias("ticket_number"),
        F.col("event_type").alias("ticket_name"),
        F.col("ts").alias("create_date"),
        F.col("event_type").alias("ticket_type"),
        (F.col("ts") + F.expr("interval 1 day")).alias("close_date"),
        *[none.alias(c) for c in ("ticket_tag", "country", "escalated_check", "current_status", "ticket_medium", "account_identifier")],
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("user_id").cast("int").alias("store_id"),
    )
    return lifecycle.helpdesk_delta(tickets, AS_OF)


@query(
    "incremental_windows",
    """select 'today' as win, count(*) as total from events where ts >= timestamp '2024-01-30' and ts < timestamp '2024-01-31'
    union all select 'yesterday_and_today', count(*) from events where ts >= timestamp '2024-01-29' and ts < timestamp '2024-01-31'
    union all select 'since_ten_days', count(*) from events where ts >= timestamp '2024-01-20'
    union all select 'last_week_without_today', count(*) from events where ts >= timestamp '2024-01-23' and ts < timestamp '2024-01-30'
    union all select 'two_months', count(*) from events where ts >= timestamp '2023-11-30'""",
)
def incremental_windows(t: Tables) -> DataFrame:
    e = t.events
    windows = {
        "today": in_window(e, "ts", AS_OF, 0, 0),
        "yesterday_and_today": in_window(e, "ts", AS_OF, -1, 0),
        "since_ten_days": since(e, "ts", AS_OF, days=10),
        "last_week_without_today": since(e, "ts", AS_OF, days=7, include_today=False),
        "two_months": since(e, "ts", AS_OF, months=2),
    }
    out = None
    for name, df in windows.items():
        one = df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(name).alias("win"), "total")
        out = one if out is None else out.unionByName(one)
    return out


@query("dual_export_rows", "select * from events where event_id is not null")
def dual_export_rows(t: Tables) -> DataFrame:
    return lifecycle.keyed_invoices(t.events, "event_id")


@query(
    "event_batches_500",
    """with r as (select *, (row_number() over (partition by event_type order by ts, event_id) - 1) // 500 as batch_no from events)
    select event_type, batch_no, count(*) as n_records, min_by(event_id, (ts, event_id)) as first_id,
      cast(sum(event_id) as bigint) as id_sum from r group by 1, 2""",
)
def event_batches_500(t: Tables) -> DataFrame:
    batches = event_batches(t.events, ["event_type"], ["ts", "event_id"], 500, unique=True)
    ids = F.transform(
        F.from_json("body", "records array<struct<value struct<event_id bigint>>>")["records"],
        lambda r: r["value"]["event_id"],
    )
    return batches.select(
        "event_type", "batch_no", "n_records",
        F.element_at(ids, 1).alias("first_id"),
        F.aggregate(ids, F.lit(0).cast("bigint"), lambda a, i: a + i).alias("id_sum"),
    )


# --- products --------------------------------------------------------------------------------


def product_inputs(t: Tables) -> dict[str, DataFrame]:
    """Nations are outlets, brands are family groups, parts are products, lines are sales."""
    outlets = t.nation.select(
        F.col("n_nationkey").alias("branch_office_id"), F.col("n_name").alias("name"),
        (F.col("n_regionkey") == 4).cast("int").alias("is_test_office"),
    )
    sold = (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    )
    sales = sold.select(
        F.col("s_nationkey").alias("branch_office_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_brand").alias("family_group_id"),
        F.col("l_shipdate").alias("timestamp"),
        F.when(F.col("l_quantity") > 1, F.col("l_quantity").cast("bigint")).otherwise(0).alias("count"),
        F.col("l_extendedprice").alias("total_money"),
    )
    # Catalogue rows exist where something was sold, as in a till system per outlet.
    groups = sales.select(
        "branch_office_id", "family_group_id", F.concat(F.lit("G "), F.col("family_group_id")).alias("name")
    ).distinct()
    names = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"))
    catalogue = sales.select("branch_office_id", "product_id", "family_group_id").distinct().join(names, "product_id")
    predictions = t.part.where(F.col("p_type") == "PROMO").select(
        F.concat(F.lit("G "), F.col("p_brand"), F.lit(" "), F.col("p_name")).alias("product_name"),
        F.lit("promo").alias("prediction"),
    ).distinct()
    return dict(outlets=outlets, sales=sales, groups=groups, products=catalogue, predictions=predictions)


PRODUCT_SQL = """
sales as (select s_nationkey as branch_office_id, l_partkey as product_id, p_brand as family_group_id, l_shipdate as t,
  case when l_quantity > 1 then cast(l_quantity as bigint) else 0 end as n, cast(l_extendedprice as decimal(18,4)) as m, p_name
  from lineitem join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey),
preds as (select distinct 'G ' || p_brand || ' ' || p_name as product_name, 'promo' as prediction from part where p_type = 'PROMO')
"""
SALES_AS_OF = date(2001, 1, 3)


@query(
    "product_overview",
    f"""with {PRODUCT_SQL},
    wk as (select branch_office_id, product_id, family_group_id, date_trunc('week', t) as w, sum(n) as c from sales
      where t >= timestamp '2000-11-03' group by all),
    lags as (select branch_office_id, product_id, family_group_id, max(c) filter (where w = date '2000-12-25') as one_ago,
      max(c) filter (where w = date '2000-12-18') as two_ago from wk group by all),
    cur as (select branch_office_id, product_id, family_group_id, sum(n) as c from sales
      where t >= timestamp '2000-12-27' and t < timestamp '2001-01-03' group by all),
    tot as (select branch_office_id, product_id, family_group_id, p_name, cast(min(t) as date) as first_sale, cast(max(t) as date) as last_sale,
      cast(sum(n) as bigint) as total_count, cast(round(sum(m), 2) as double) as total_revenue from sales where n > 0 group by all)
    select branch_office_id, n_name as outlet_name, family_group_id, 'G ' || family_group_id as family_group, product_id, p_name as product,
      first_sale, last_sale, total_count, total_revenue, cast(cur.c as bigint) as sale_current_week, cast(one_ago as bigint) as sale_one_cw_ago,
      cast(two_ago as bigint) as sale_two_cw_ago, prediction as product_category
    from tot join nation on n_nationkey = branch_office_id and n_regionkey <> 4
    left join lags using (branch_office_id, product_id, family_group_id)
    left join cur using (branch_office_id, product_id, family_group_id)
    left join preds on product_name = 'G ' || family_group_id || ' ' || p_name""",
)
def product_overview(t: Tables) -> DataFrame:
    return products.product_overview(**product_inputs(t), as_of=SALES_AS_OF)


@query(
    "unscored_names",
    f"""with {PRODUCT_SQL} select distinct 'G ' || family_group_id || ' ' || p_name as product_name from sales
    where 'G ' || family_group_id || ' ' || p_name not in (select product_name from preds)""",
)
def unscored_names(t: Tables) -> DataFrame:
    i = product_inputs(t)
    return products.unscored_names(i["products"], i["groups"], i["predictions"])


LABELS = ["ALPHA", "BETA", "GAMMA"]


@query(
    "score_names_ml",
    f"""with {PRODUCT_SQL}, fresh as (select distinct family_group_id as brand, 'G ' || family_group_id || ' ' || p_name as product_name from sales)
    select product_name, case cast(split_part(brand, '#', 2) as integer) % 3 when 0 then 'ALPHA' when 1 then 'BETA' else 'GAMMA' end as prediction,
      timestamp '2024-01-30' as predicted_at
    from fresh where product_name not in (select product_name from preds)""",
)
def score_names_ml(t: Tables) -> DataFrame:
    """Trained on the names of all parts; the number in the brand decides, so predictions are certain."""
    named = t.part.select(
        F.concat(F.lit("G "), F.col("p_brand"), F.lit(" "), F.col("p_name")).alias("product_name"),
        (F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int") % 3).cast("double").alias("label"),
    )
    model = products.category_pipeline().fit(named)
    i = product_inputs(t)
    return products.score_new_names(
        i["products"], i["groups"], i["predictions"],
        lambda names: products.score_with_pipeline(names, model, LABELS, datetime(2024, 1, 30)),
    )


# --- matching export: customers matched to suppliers of a wholesale system --------------------


def export_inputs(t: Tables) -> dict[str, DataFrame]:
    """Events are match rows between users (establishments) and wholesale ids.

    ``k`` in an event's properties is the match quality doubled; establishments are
    customers, wholesale customers are suppliers.
    """
    k = F.get_json_object("props", "$.k")
    by_crm = F.col("event_type").isin("view", "click", "purchase")
    # Small users meet a wholesale id by both kinds of match only in the middle of the range.
    shared = F.expr("user_id div 4")
    metro = (
        F.when(by_crm & (F.col("user_id") < 40), F.col("user_id") + 300)
        .when(~by_crm & (F.col("user_id") >= 75), F.col("user_id") + 100)
        .otherwise(shared)
    )
    matches = t.events.select(
        F.when(F.col("value") < 50, "de").otherwise("FR").alias("iso_code"),
        F.when(by_crm, F.concat(F.lit("C"), F.col("user_id").cast("string"))).alias("id_source_1"),
        F.when(~by_crm, F.concat(F.lit("b"), F.col("user_id").cast("string"))).alias("id_source_2"),
        metro.cast("string").alias("unique_metro_id"),
        F.when(by_crm, matching_export.REQUEST_BY_CRM_ID)
        .when(F.col("event_type") == "error", "other_request")
        .otherwise(matching_export.REQUEST_BY_BOOKING_ID)
        .alias("original_request"),
        F.lit("list").alias("list_type"),
        (k.cast("int") * 2).cast("string").alias("match_quality"),
        (F.col("event_type") != "click").alias(VALID_FLAG),
    )
    o = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    c = t.customer.join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    flag = lambda s: (F.col("c_mktsegment") == s).cast("int")
    key = F.col("c_custkey").cast("string")
    rich = F.col("c_acctbal") > 5000
    flags = {p.flag: F.lit(0) for p in matching_export.CATALOGUE}
    flags |= {"has_dish_website": F.lit(1), "has_dish_order": flag("BUILDING"), "has_Dish_POS": flag("MACHINERY"), "has_MenuEngineering": flag("BUILDING"), "has_lynn": flag("HOUSEHOLD"), "has_mto_premium": flag("FURNITURE")}
    none = F.lit(None).cast("timestamp_ntz")
    dates = {d: none for p in matching_export.CATALOGUE for d in (p.created, p.ended) if d}
    dates |= {
        "dish_website_createddate": F.col("first"),
        "dish_order_deleteddate": F.when(rich, F.col("last")),
        "lynn_createddate": F.col("last"),
        "mto_premium_disableddate": F.col("last"),
    }
    # Rich establishments are known by CRM id, poor ones by booking id, the others by both.
    middle = F.col("c_acctbal").between(2000, 5000)
    base = c.select(
        F.concat(F.lit("H"), key).alias("id_est"),
        F.when(rich | middle, F.concat(F.lit("C"), key)).alias("establishment_sfid"),
        F.when(~rich, F.concat(F.lit("B"), key)).alias("booq_id"),
        *[v.alias(n) for n, v in flags.items()],
        F.lit(0).alias("has_dish_teamplan"),
        F.round(F.col("c_acctbal") / 1000, 0).alias("establishment_activity_score"),
        (F.col("c_mktsegment") != "AUTOMOBILE").cast("int").alias("establishment_active"),
        *[v.alias(n) for n, v in dates.items()],
        F.col("first").alias("date_acquisition"),
        F.when(F.col("c_acctbal") < 0, F.col("last")).alias("date_deletion"),
        F.col("first").alias("SFDC_createdDate"),
    )
    wholesale = t.supplier.select(
        F.when(F.col("s_nationkey") < 15, "DE").otherwise("FR").alias("country"),
        F.col("s_suppkey").alias("unique_metro_id"),
        (F.col("s_suppkey") + 1000).alias("unique_home_store_id"),
        F.when(F.col("s_acctbal") > 3000, F.col("s_suppkey") + 5000).alias("unique_cust_no"),
        F.col("s_nationkey").alias("status_cd"),
        F.when(F.col("s_acctbal") > 5000, "1").alias("blocking_reason_cd"),
    )
    return dict(matches=matches, base=base, wholesale=wholesale)


EXPORT_SQL = """
raw as (select distinct case when value < 50 then 'DE' else 'FR' end as country, event_type, user_id,
  cast(case when event_type in ('view', 'purchase') and user_id < 40 then user_id + 300
    when event_type = 'signup' and user_id >= 75 then user_id + 100 else user_id // 4 end as varchar) as unique_metro_id,
  cast(json_extract_string(props, '$.k') as bigint) * 2 as q from events
  where event_type in ('view', 'purchase', 'signup') and cast(json_extract_string(props, '$.k') as bigint) * 2 <= 150),
ms as (select distinct country, unique_metro_id, q, 'C' || user_id as uid from raw where event_type in ('view', 'purchase')),
mb as (select distinct country, unique_metro_id, q, 'b' || user_id as booq from raw where event_type = 'signup'),
cust as (select distinct coalesce(ms.country, mb.country) as country, coalesce(ms.unique_metro_id, mb.unique_metro_id) as unique_metro_id,
  uid, booq, coalesce(ms.q, mb.q) as q from ms full join mb on ms.country = mb.country and ms.unique_metro_id = mb.unique_metro_id),
cw as (select distinct cust.*, cast(s_suppkey + 1000 as bigint) as home, case when s_acctbal > 3000 then s_suppkey + 5000 end as cust_no,
  s_nationkey as status_cd, case when s_acctbal > 5000 then '1' end as blocking
  from cust left join supplier on cast(s_suppkey as varchar) = unique_metro_id and (case when s_nationkey < 15 then 'DE' else 'FR' end) = country),
o as (select o_custkey, min(o_orderdate) as first, max(o_orderdate) as last from orders group by 1),
est as (select 'H' || c_custkey as hd, case when c_acctbal >= 2000 then 'C' || c_custkey end as uid, case when not c_acctbal > 5000 then 'b' || c_custkey end as booq,
  c_mktsegment as seg, round(c_acctbal / 1000, 0) as score, c_mktsegment <> 'AUTOMOBILE' as active, first, last,
  case when c_acctbal > 5000 then last end as order_end, case when c_acctbal < 0 then last end as deleted from customer left join o on o_custkey = c_custkey),
j as (select cw.*, hd, seg, score, active, first, last, order_end, deleted from cw join est
  on cw.uid is not distinct from est.uid and cw.booq is not distinct from est.booq),
s as (
  select *, 'Dish Website' as d, 100 as code, first as f, cast(null as timestamp) as e from j
  union all select *, 'Dish Order', 106, null, order_end from j where seg = 'BUILDING'
  union all select *, 'Dish POS', 111, null, null from j where seg = 'MACHINERY'
  union all select *, 'GastroConsulting', 201, null, null from j where seg = 'BUILDING'
  union all select *, 'Dish Lynn', 110, last, null from j where seg = 'HOUSEHOLD'
  union all select *, 'Dish Premium', 105, null, last from j where seg = 'FURNITURE'),
auid as (select distinct country, uid from s where active),
amet as (select distinct s.country, s.unique_metro_id from s join auid on auid.country = s.country and auid.uid is not distinct from s.uid),
pick as (select country, unique_metro_id, hd from s qualify row_number() over (partition by country, unique_metro_id order by score desc, f nulls last, hd) = 1),
staging as (select distinct coalesce(home, 0) as unique_home_store_id, coalesce(cust_no, 0) as unique_cust_no, s.country,
  cast(case when amet.unique_metro_id is not null then code else code + 700 end as varchar) as w360_service_cd, d as w360_service_desc,
  strftime(coalesce(f, first), '%Y-%m-%d') as date_from, coalesce(strftime(coalesce(e, deleted), '%Y-%m-%d'), '2949-12-31') as date_to,
  cast(0 as double) as price, s.hd as HD_cust_ident, '2024-01-30' as creation_date, uid as UID__c,
  strftime(first, '%Y-%m-%d %H:%M:%S') as SFDC_createdDate, cast(status_cd as varchar) as status_cd, blocking as blocking_reason_cd, q as match_quality
  from s join pick on pick.country = s.country and pick.unique_metro_id = s.unique_metro_id and pick.hd = s.hd
  left join amet on amet.country = s.country and amet.unique_metro_id = s.unique_metro_id)
"""


@query("matching_export", f"with {EXPORT_SQL} select * from staging")
def matching_export_rows(t: Tables) -> DataFrame:
    return matching_export.matching_export(**export_inputs(t), as_of=AS_OF)


@query(
    "matching_feed",
    f"""with {EXPORT_SQL} select unique_home_store_id, unique_cust_no, country, w360_service_cd, w360_service_desc,
    cast(date_diff('day', date '1970-01-01', cast(date_from as date)) as integer) as date_from,
    cast(date_diff('day', date '1970-01-01', cast(date_to as date)) as integer) as date_to,
    cast(0 as bigint) as price, HD_cust_ident,
    cast(date_diff('day', date '1970-01-01', cast(creation_date as date)) as integer) as creation_date, UID__c,
    SFDC_createdDate, status_cd, blocking_reason_cd, match_quality from staging where lower(country) = 'de'""",
)
def matching_feed(t: Tables) -> DataFrame:
    staging = matching_export.matching_export(**export_inputs(t), as_of=AS_OF)
    return wire_form(matching_export.matching_feed(staging, "DE"), PARTNER_MATCHING)
