"""Invoice lines priced by effective date, as hashed commission measures."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import first_times, iso_country, rounded_long
from tidemark.functions.clock import day, stamp_scd, ts
from tidemark.functions.hashing import with_hashes
from tidemark.operators.aggregates import UNIT, exact_sum, money_sum, units
from tidemark.operators.joins import price_lookup

# Which invoice lines take part.
FIRST_BOOKING = date(2023, 10, 1)
PENALTY_CODE = "ContractPenalty"
PARTNER_CHANNEL = "PARTNER"

KEYS = [
    "parent_bill", "booking_date", "actual_delivery_start", "billing_country",
    "billing_country_code", "company", "sales_agency_id", "merchant", "salesforce_order_id",
    "salesforce_establishment_id", "salesforce_account_id", "metro_id", "siren_no",
    "product_code", "product_base_code", "label",
]
MEASURES = [
    "quantity", "price_per_unit", "theoretica_oneshot_amount", "actual_oneshot_amount",
    "theoretical_MFR_commission_oneshot", "promotions_amount_oneshot", "net_group_oneshot",
    "net_MFR_oneshot", "monthly_invoiced_subscription", "theoretical_MFR_commission_monthly",
    "amount_promotions_recurring", "net_group_monthly", "net_MFR_monthly",
    "total_theoretical_reccuring_monthly_MFR", "total_theoretical_one_shot_monthly_MFR",
    "total_promotion_one_shot", "total_promotion_reccuring", "total_commission_reccuring_MFR",
    "total_commission_one_shot_MFR", "total_monthly_promo", "total_monthly_DISH",
    "total_invoiced",
]
BUSINESS_KEY = ["parent_bill", "salesforce_establishment_id"]


def eligible_lines(lines: DataFrame, region: str, first_booking: date = FIRST_BOOKING) -> DataFrame:
    """Outgoing partner-channel invoice lines of one region; fees and penalties are out."""
    bill, agency = F.trim("ParentBill"), F.trim("SalesAgencyID")
    return lines.where(
        (F.col("SalesRegion") == region)
        & (F.col("BookingDate") >= ts(first_booking))
        & (F.col("EntryType") == "out_invoice")
        & (F.col("ParentBill") != "/")
        & ~bill.like("R%")
        & F.col("ProductBaseCode").isNotNull()
        & ~F.lower("ProductName").like("%fees%")
        & (F.col("ProductCode") != PENALTY_CODE)
        & F.coalesce(agency, F.lit(PARTNER_CHANNEL)).like(f"{PARTNER_CHANNEL}%")
    )


def priced_lines(lines: DataFrame, prices: DataFrame, customers: DataFrame, country: str) -> DataFrame:
    """Lines with their list prices and customer ids.

    Set-up lines look for the activation fee and other lines for the recurring one; a line
    has one kind, so one join on (product, fee type, period) serves both.
    """
    fee = F.when(F.col("ProductIsSetup"), "activation").when(~F.col("ProductIsSetup"), "recurring")
    trimmed = lines.withColumns(
        {
            c: F.trim(c)
            for c in ("Company", "SalesAgencyID", "Merchant", "SalesforceOrderID", "SalesforceEstablishmentID")
        }
    ).withColumn("_fee", fee)
    book = prices.where(F.col("country") == country).withColumn("_fee_type", F.lower("fee_type"))
    priced = price_lookup(
        trimmed,
        book,
        on=[("ProductCode", "product_code"), ("_fee", "_fee_type")],
        at="BookingDate",
        start="price_start_date",
        end="price_end_date",
        values={
            "platform_cost_eur": "_platform",
            "partner_commission_eur": "_partner",
            "customer_cost_local": "_list",
        },
    )
    ids = customers.select(
        F.trim("establishment_uid").alias("_uid"),
        F.col("clean_customer_id").alias("metro_id"),
        F.col("business_registry_no").alias("siren_no"),
    )
    known = priced.join(ids, F.col("SalesforceEstablishmentID") == F.col("_uid"), "left")

    return known.select(
        F.col("ParentBill").alias("parent_bill"),
        F.col("BookingDate").cast("date").alias("booking_date"),
        F.col("ActualDeliveryStart").cast("date").alias("actual_delivery_start"),
        F.col("SalesRegion").alias("billing_country"),
        iso_country("SalesRegion").alias("billing_country_code"),
        F.col("Company").alias("company"),
        F.col("SalesAgencyID").alias("sales_agency_id"),
        F.col("Merchant").alias("merchant"),
        F.col("SalesforceOrderID").alias("salesforce_order_id"),
        F.col("SalesforceEstablishmentID").alias("salesforce_establishment_id"),
        F.col("SalesforceAccountID").alias("salesforce_account_id"),
        "metro_id",
        "siren_no",
        F.col("ProductCode").alias("product_code"),
        F.col("ProductBaseCode").alias("product_base_code"),
        F.col("Label").alias("label"),
        F.col("ProductIsSetup").alias("is_setup"),
        F.col("PriceAdjustment").isNotNull().alias("is_promo"),
        F.col("Quantity").alias("line_quantity"),
        F.round("UnitPrice", 2).alias("unit_price"),
        F.round("NetPriceEUR", 2).alias("net"),
        first_times("Quantity", "_platform").alias("platform_list"),
        first_times("Quantity", "_partner").alias("partner_list"),
        first_times("Quantity", "_list").alias("customer_list"),
    )


def commission_measures(lines: DataFrame) -> DataFrame:
    """22 conditional measures per :data:`KEYS`, exact to the cent: shares are rounded once, as sums."""
    share = "try_divide(double({}), nullif(double(customer_list), 0D)) * double(net)"
    exact = lines.select(
        *KEYS, "is_promo", "is_setup", "unit_price",
        units("line_quantity").alias("line_quantity"),
        units("net").alias("net"),
        F.expr("cast(partner_list as decimal(28,10))").alias("partner_list"),
        F.expr(share.format("partner_list")).alias("partner_share"),
        F.expr(share.format("platform_list")).alias("platform_share"),
    )
    regular, promo = "not is_promo", "is_promo"
    setup, recurring = "is_setup", "not is_setup"
    measures = {
        "quantity": money_sum("line_quantity", regular),
        "price_per_unit": F.expr(f"max(unit_price) filter (where {regular})"),
        "theoretica_oneshot_amount": money_sum("net", regular),
        "actual_oneshot_amount": money_sum("net"),
        "theoretical_MFR_commission_oneshot": exact_sum("partner_share", regular),
        "promotions_amount_oneshot": money_sum("net", promo, zero=True),
        "net_group_oneshot": money_sum("net", regular),
        "net_MFR_oneshot": money_sum("net"),
        "monthly_invoiced_subscription": money_sum("net", recurring, zero=True),
        "theoretical_MFR_commission_monthly": exact_sum("partner_list", regular),
        "amount_promotions_recurring": money_sum("net", f"{recurring} and {promo}", zero=True),
        "net_group_monthly": money_sum("net", f"{recurring} and {regular}", zero=True),
        # Null when the group has no regular line, like its first part.
        "net_MFR_monthly": F.expr(
            f"round(sum(partner_list) filter (where {regular})"
            f" + cast(coalesce(sum(net) filter (where {recurring} and {promo}), 0L) as decimal(19,0)) / {UNIT}, 2)"
        ),
        "total_theoretical_reccuring_monthly_MFR": money_sum("net", f"{recurring} and {regular}", zero=True),
        "total_theoretical_one_shot_monthly_MFR": money_sum("net", f"{setup} and {regular}", zero=True),
        "total_promotion_one_shot": money_sum("net", f"{setup} and {promo}", zero=True),
        "total_promotion_reccuring": money_sum("net", f"{recurring} and {promo}", zero=True),
        "total_commission_reccuring_MFR": money_sum("net", recurring, zero=True),
        "total_commission_one_shot_MFR": money_sum("net", setup, zero=True),
        "total_monthly_promo": money_sum("net", promo, zero=True),
        "total_monthly_DISH": exact_sum("platform_share", regular),
        "total_invoiced": money_sum("net"),
    }
    return exact.groupBy(*KEYS).agg(*[measures[m].alias(m) for m in MEASURES])


def commission_snapshot(
    lines: DataFrame,
    prices: DataFrame,
    customers: DataFrame,
    as_of: date | datetime,
    region: str = "France",
    country: str = "FR",
    first_booking: date = FIRST_BOOKING,
) -> DataFrame:
    """One row per bill, establishment and product with measures, hashes, version columns.

    The business key (bill, establishment) repeats across products; nothing here assumes it
    to be unique.
    """
    eligible = eligible_lines(lines, region, first_booking)
    measured = commission_measures(priced_lines(eligible, prices, customers, country))
    typed = measured.withColumns(
        {
            "metro_id": F.col("metro_id").cast("bigint"),
            "quantity": rounded_long("quantity"),
            **{m: F.col(m).cast("double") for m in MEASURES if m != "quantity"},
        }
    )
    dated = typed.withColumn("_ldts", F.lit(day(as_of)))
    return stamp_scd(with_hashes(dated, BUSINESS_KEY, [*KEYS, *MEASURES]), as_of)
