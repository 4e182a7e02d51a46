"""Outbound record contracts, and the projections and checks that enforce them.

A contract is a ``StructType``: a field that is not nullable is required.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import epoch_day, unscaled

REASONS = "reject_reasons"

_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "DECIMAL(5,2)": T.DecimalType(5, 2),
}


def record(fields: str) -> T.StructType:
    """A flat record type from ``name TYPE [NOT NULL]`` entries; needs no session."""
    out = T.StructType()
    for entry in " ".join(fields.split()).split(", "):
        name, kind, *rest = entry.split(" ")
        out.add(name, _TYPES[kind], nullable=not rest)
    return out


# Field names, order, types and nullability of the records that the
# receiving systems registered. NOT NULL marks a required field.

SCORING = record("""
metro_id BIGINT NOT NULL, establishment_id STRING NOT NULL, establishment_name STRING NOT NULL,
street_name STRING NOT NULL, street_number STRING NOT NULL, postal_code STRING NOT NULL,
city STRING NOT NULL, iso_code STRING NOT NULL, manager_information STRING NOT NULL,
first_name STRING NOT NULL, mobilephone STRING NOT NULL, establishment_type STRING NOT NULL,
potential_level INT NOT NULL, bundle_recommendation STRING NOT NULL, _ldts STRING NOT NULL,
bundle_potential_score FLOAT, pos_recommendation INT, pos_potential_score FLOAT,
pay_recommendation INT, pay_potential_score FLOAT
""")

CRM_ASSET = record("""
establishment_uid STRING, product STRING, channel_v2 STRING, referrer STRING,
activated_by STRING, install_date DATE, disabled_date DATE, status STRING,
establishment_name STRING, shipping_postal_code STRING, shipping_city STRING,
shipping_street STRING, person_email STRING, email_permission BOOLEAN,
account_id_long STRING, crm_metro_id STRING, store_id INT, crm_account_identifier BIGINT,
vat_id STRING, metro_id BIGINT, cust_no INT, home_store_id INT, create_ts STRING,
update_ts STRING, _ldts DATE NOT NULL
""")

COMMISSION = record("""
parent_bill STRING, booking_date DATE, actual_delivery_start DATE, billing_country STRING,
billing_country_code STRING, company STRING, sales_agency_id STRING, merchant STRING,
salesforce_order_id STRING, salesforce_establishment_id STRING, salesforce_account_id STRING,
metro_id BIGINT, siren_no STRING, product_code STRING, product_base_code STRING, label STRING,
quantity INT, price_per_unit FLOAT, theoretica_oneshot_amount FLOAT,
actual_oneshot_amount FLOAT, theoretical_MFR_commission_oneshot FLOAT,
promotions_amount_oneshot FLOAT, net_group_oneshot FLOAT, net_MFR_oneshot FLOAT,
monthly_invoiced_subscription FLOAT, theoretical_MFR_commission_monthly FLOAT,
amount_promotions_recurring FLOAT, net_group_monthly FLOAT, net_MFR_monthly FLOAT,
total_theoretical_reccuring_monthly_MFR FLOAT, total_theoretical_one_shot_monthly_MFR FLOAT,
total_promotion_one_shot FLOAT, total_promotion_reccuring FLOAT,
total_commission_reccuring_MFR FLOAT, total_commission_one_shot_MFR FLOAT,
total_monthly_promo FLOAT, total_monthly_DISH FLOAT, total_invoiced FLOAT, _ldts DATE NOT NULL
""")

PARTNER_MATCHING = record("""
unique_home_store_id INT NOT NULL, unique_cust_no INT NOT NULL, country STRING NOT NULL,
w360_service_cd STRING NOT NULL, w360_service_desc STRING NOT NULL, date_from DATE NOT NULL,
date_to DATE NOT NULL, price DECIMAL(5,2) NOT NULL, HD_cust_ident STRING NOT NULL,
creation_date DATE NOT NULL, UID__c STRING, SFDC_createdDate STRING, status_cd STRING,
blocking_reason_cd STRING, match_quality INT
""")

WHOLESALE_INVOICE = record("""
uni_key STRING, parent_bill STRING, booking_month DATE NOT NULL, booking_date DATE NOT NULL,
actual_delivery_start DATE NOT NULL, billing_country STRING NOT NULL,
billing_country_code STRING NOT NULL, company STRING NOT NULL, sales_agency_id STRING NOT NULL,
merchant STRING NOT NULL, order_id STRING NOT NULL, establishment_id STRING NOT NULL,
metro_id BIGINT, account_id STRING NOT NULL, establishment_name STRING,
establishment_type STRING, establishment_city STRING, establishment_street STRING,
establishment_postalcode INT, establishment_latitude FLOAT, establishment_longitude FLOAT,
establishment_geo_accuracy STRING, main_category STRING, product_base_code STRING,
product_code STRING, quantity INT, theoretical_total_amount FLOAT,
promotions_total_amount FLOAT, actual_total_amount FLOAT, theo_total_rec_revenue FLOAT,
promotions_rec_amount FLOAT, actual_rec_revenue FLOAT, theo_total_onetime_revenue FLOAT,
promotions_onetime_amount FLOAT, actual_onetime_revenue FLOAT
""")

LEAD = record("""
lead_id STRING NOT NULL, converted_account_id STRING NOT NULL, lead_referrer STRING NOT NULL,
store STRING NOT NULL, metro_id STRING NOT NULL, customer_id_sam STRING NOT NULL,
establishment_name STRING NOT NULL, lead_full_name STRING NOT NULL,
product_name STRING NOT NULL, lead_creation_date STRING NOT NULL, closing_date STRING NOT NULL,
lead_source STRING NOT NULL, status STRING NOT NULL, reason_lost STRING NOT NULL,
reason_lost2 STRING NOT NULL, converted_contact_id STRING NOT NULL,
lead_owner_name STRING NOT NULL, channel_v2 STRING NOT NULL,
asset_creation_date STRING NOT NULL, activated_by STRING NOT NULL, lead_email STRING NOT NULL,
lead_street STRING NOT NULL, lead_city STRING NOT NULL, lead_postal_code STRING NOT NULL,
lead_country_code STRING NOT NULL, _ldts DATE NOT NULL, ecom_traffic_source STRING,
asset_id STRING
""")

ASSET = record("""
account_id STRING, mcc_metro_id STRING, mcc_home_store_id STRING, establishment_id STRING,
sfdc_internal_establishment_id STRING, country_code STRING, full_vat STRING,
vat_verified BOOLEAN, company_name STRING, establishment_name STRING, street STRING,
postalcode STRING, city STRING, establishment_address STRING, first_name STRING,
last_name STRING, mobilephone STRING, email STRING, manager_information STRING,
dish_terms_conditions BOOLEAN, asset_UID STRING, subscription_id STRING,
asset_channel_v2 STRING, asset_status STRING, asset_name STRING, asset_creation_date STRING,
asset_disabled_date STRING, reason_of_cancellation STRING, text_reason_of_cancellation STRING,
asset_onboarded BOOLEAN, asset_onboarding_date STRING, commitment_period INT,
asset_referrer STRING, price FLOAT, voucher_code STRING, voucher_reduction_grant_month INT,
onetime_percentage FLOAT, recurring_percentage FLOAT, onetime_original_net_price FLOAT,
recurring_original_net_price FLOAT, _ldts DATE NOT NULL, asset_activated_by STRING,
asset_migrated STRING, asset_onboarded_sfdc STRING, asset_onboarding_date_sfdc STRING,
product_code STRING, country_specific_code STRING, asset_install_date STRING,
is_subscription BOOLEAN, assignees STRING, quantity INT, lead_id INT, created_from_lead STRING,
odoo_OnboardingDate STRING, odoo_Onboarding_flag INT, odoo_metro_id STRING,
odoo_store_id STRING, establishment_active BOOLEAN
""")

VOUCHER = record("""
asset_id STRING, sale_order_id STRING, partner_id BIGINT, establishment_id STRING,
order_id STRING, subscription_id STRING, product_code STRING, discount_code STRING,
discount_desc STRING, price DOUBLE, recurring_invoice BOOLEAN, is_subscription BOOLEAN,
asset_installation_date STRING, asset_created_date STRING, country_code STRING
""")

TICKET = record("""
ticket_number STRING, ticket_name STRING, create_date STRING, ticket_type STRING,
ticket_tag STRING, close_date STRING, country STRING, escalated_check STRING,
current_status STRING, ticket_medium STRING, account_identifier STRING, customer_id STRING,
store_id INT
""")

# Source column names of the CRM asset snapshot and the contract names they
# travel under.
CRM_ASSET_NAMES = {
    "establishment_UID": "establishment_uid", "Product": "product", "ChannelV2": "channel_v2",
    "Referrer": "referrer", "ActivatedBy": "activated_by", "InstallDate": "install_date",
    "DisabledDate": "disabled_date", "Status": "status",
    "Establishment_name": "establishment_name", "ShippingPostalCode": "shipping_postal_code",
    "ShippingCity": "shipping_city", "ShippingStreet": "shipping_street",
    "PersonEmail": "person_email", "AccountId_Long": "account_id_long",
    "Crm_Metro_Id": "crm_metro_id", "Store_Id": "store_id",
    "Crm_Account_Identifier": "crm_account_identifier", "VAT_id": "vat_id",
    "_create_ts": "create_ts", "_update_ts": "update_ts",
}
ASSET_NAMES = {"odoo_Onboarding_status": "odoo_Onboarding_flag"}

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _cast(field: T.StructField, source: T.DataType, strict: bool) -> Column:
    """Cast to a contract type; fractions round instead of being cut off."""
    col = F.col(field.name)
    cast = (lambda c, t: c.cast(t)) if strict else (lambda c, t: c.try_cast(t))
    if isinstance(field.dataType, _WHOLE) and isinstance(
        source, (T.DoubleType, T.FloatType, T.DecimalType)
    ):
        col = F.round(cast(col, "decimal(38,9)"))
    return cast(col, field.dataType)


def conform(df: DataFrame, contract: T.StructType, strict: bool = True) -> DataFrame:
    """Exactly the contract's columns, in its order and types.

    ``strict`` raises on a value that cannot be cast; otherwise it becomes null.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[_cast(f, types[f.name], strict).alias(f.name) for f in contract.fields])


def wire_form(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Contract rows as the wire carries them: dates as days since 1970-01-01, decimals as
    unscaled integers."""
    def wired(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.DateType):
            return epoch_day(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return unscaled(f.name, f.dataType.precision, f.dataType.scale)
        return F.col(f.name)

    return df.select(*[wired(f).alias(f.name) for f in contract.fields])


def violations(df: DataFrame, contract: T.StructType, limits: Mapping[str, tuple] | None = None) -> Column:
    """Array of "field: reason" texts, empty where the row meets the contract.

    ``limits`` gives inclusive (low, high) bounds for single fields.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    found = []
    for f in contract.fields:
        value = F.col(f.name)
        fits = _cast(f, types[f.name], strict=False)
        if not f.nullable:
            found.append(F.when(value.isNull(), F.lit(f"{f.name}: missing")))
        if types[f.name] != f.dataType:
            found.append(
                F.when(value.isNotNull() & fits.isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}"))
            )
        if limits and f.name in limits:
            low, high = limits[f.name]
            found.append(F.when(~fits.between(low, high), F.lit(f"{f.name}: out of range")))
    if not found:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*found))


def validate(
    df: DataFrame, contract: T.StructType, limits: Mapping[str, tuple] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): valid rows conform to the contract, rejected ones keep their
    columns and gain ``reject_reasons``."""
    checked = df.withColumn(REASONS, violations(df, contract, limits))
    ok = checked.where(F.size(REASONS) == 0).drop(REASONS)
    return conform(ok, contract, strict=False), checked.where(F.size(REASONS) > 0)
