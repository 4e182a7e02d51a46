"""Payment-terminal inventory: nested JSON to flat tables, and the work derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import drop_blank, exclude_status
from tidemark.operators.joins import join_unique

# Settings groups that may be stored.
ALLOWED_SETTINGS = (
    "cardholderReceipt", "gratuities", "opi", "receiptPrinting", "refunds", "signature",
    "hardware", "connectivity", "offlineProcessing", "standalone", "payment", "localization",
    "terminalInstructions", "homeScreen",
)

# Fields of the three API records that are kept.
MERCHANT = """
id STRING, name STRING, companyId STRING, captureDelay STRING, defaultShopperInteraction STRING,
status STRING, shopWebAddress STRING, merchantCity STRING, primarySettlementCurrency STRING,
reference STRING, dataCenters ARRAY<STRUCT<name: STRING, livePrefix: STRING>>,
_links STRUCT<self: STRUCT<href: STRING>, apiCredentials: STRUCT<href: STRING>,
users: STRUCT<href: STRING>, webhooks: STRUCT<href: STRING>>
"""
STORE = """
id STRING, reference STRING, description STRING, status STRING, merchantId STRING,
phoneNumber STRING, shopperStatement STRING, externalReferenceId STRING,
address STRUCT<line1: STRING, city: STRING, country: STRING, postalCode: STRING>,
_links STRUCT<self: STRUCT<href: STRING>>
"""
TERMINAL = """
id STRING, model STRING, serialNumber STRING, firmwareVersion STRING, countryCode STRING,
cloudDeviceApiEndpoint STRING, restartLocalTime STRING,
assignment STRUCT<companyId: STRING, merchantId: STRING, storeId: STRING, status: STRING>,
connectivity STRUCT<wifi: STRUCT<ipAddress: STRING, macAddress: STRING, ssid: STRING>,
cellular: STRUCT<iccid: STRING, status: STRING>, bluetooth: STRUCT<macAddress: STRING>,
ethernet: STRUCT<macAddress: STRING>>
"""
SETTINGS = "terminal_id STRING, settings STRING"

# Flat name <- path in the record.
MERCHANT_FIELDS = {
    "merchant_id": "id", "merchant_name": "name", "company_id": "companyId",
    "capture_delay": "captureDelay", "shopper_interaction": "defaultShopperInteraction",
    "status": "status", "web_address": "shopWebAddress", "city": "merchantCity",
    "settlement_currency": "primarySettlementCurrency", "reference": "reference",
    "data_centers": "dataCenters", "self_url": "_links.self.href",
    "api_credentials_url": "_links.apiCredentials.href", "users_url": "_links.users.href",
    "webhooks_url": "_links.webhooks.href",
}
STORE_FIELDS = {
    "store_id": "id", "store_reference": "reference", "store_description": "description",
    "store_status": "status", "store_merchant_id": "merchantId",
    "store_phone_number": "phoneNumber", "store_shopper_statement": "shopperStatement",
    "store_external_reference_id": "externalReferenceId",
    "store_address_line1": "address.line1", "store_city": "address.city",
    "store_country": "address.country", "store_postal_code": "address.postalCode",
    "store_self_url": "_links.self.href",
}
TERMINAL_FIELDS = {
    "terminal_id": "id", "model": "model", "serial_number": "serialNumber",
    "firmware_version": "firmwareVersion", "country_code": "countryCode",
    "cloud_device_api_endpoint": "cloudDeviceApiEndpoint",
    "restart_local_time": "restartLocalTime", "company_id": "assignment.companyId",
    "merchant_id": "assignment.merchantId", "store_id": "assignment.storeId",
    "assignment_status": "assignment.status", "wifi_ip_address": "connectivity.wifi.ipAddress",
    "wifi_mac_address": "connectivity.wifi.macAddress", "wifi_ssid": "connectivity.wifi.ssid",
    "cellular_iccid": "connectivity.cellular.iccid",
    "cellular_status": "connectivity.cellular.status",
    "bluetooth_mac_address": "connectivity.bluetooth.macAddress",
    "ethernet_mac_address": "connectivity.ethernet.macAddress",
}


def _flat(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(path).alias(name) for name, path in fields.items()])


def flatten_merchants(df: DataFrame) -> DataFrame:
    """Merchants with link addresses and data centres as (name, live_prefix)."""
    flat = _flat(df, MERCHANT_FIELDS)
    centres = F.transform(
        F.col("data_centers"),
        lambda c: F.struct(c["name"].alias("name"), c["livePrefix"].alias("live_prefix")),
    )
    empty = F.array().cast("array<struct<name: string, live_prefix: string>>")
    return flat.withColumn("data_centers", F.coalesce(centres, empty))


def flatten_stores(df: DataFrame) -> DataFrame:
    return _flat(df, STORE_FIELDS)


def flatten_terminals(df: DataFrame) -> DataFrame:
    return _flat(df, TERMINAL_FIELDS)


def settings_targets(terminals: DataFrame) -> DataFrame:
    """Terminals whose settings are wanted: not in inventory, id not blank."""
    usable, _ = drop_blank(exclude_status(terminals, "assignment_status", "inventory"), ["terminal_id"])
    return usable


def allowed_settings(settings: Column, keys: Sequence[str] = ALLOWED_SETTINGS) -> Column:
    """JSON object as a map of its allowed top-level groups (each still JSON)."""
    groups = F.from_json(settings, "map<string,string>")
    return F.map_filter(groups, lambda k, _: k.isin(*keys))


def filter_settings(df: DataFrame, keys: Sequence[str] = ALLOWED_SETTINGS) -> tuple[DataFrame, DataFrame]:
    """(kept, counts): settings cut down to ``keys``; rows left empty are dropped.

    ``counts`` has one row: total, success, failed (no settings at all), skipped_empty, and
    ``nothing_left``, which a load treats as an error.
    """
    cut = df.withColumn("_kept", allowed_settings(F.col("settings"), keys))
    size = F.coalesce(F.size("_kept"), F.lit(-1))
    kept = cut.where(size > 0).select("terminal_id", F.col("_kept").alias("settings"))
    counts = cut.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(size > 0, 1)).alias("success"),
        F.count(F.when(size < 0, 1)).alias("failed"),
        F.count(F.when(size == 0, 1)).alias("skipped_empty"),
    ).withColumn("nothing_left", (F.col("total") > 0) & (F.col("success") == 0))
    return kept, counts


def terminal_inventory(
    merchants: DataFrame, stores: DataFrame, terminals: DataFrame, settings: DataFrame
) -> dict[str, DataFrame]:
    """The flat tables of one inventory run, and the settings counts."""
    flat = flatten_terminals(terminals)
    wanted = settings_targets(flat).select("terminal_id").distinct()
    mine = join_unique(settings.withColumn("terminal_id", F.trim("terminal_id")), wanted, ["terminal_id"], "left_semi")
    kept, counts = filter_settings(mine)
    return {
        "merchants": flatten_merchants(merchants),
        "stores": flatten_stores(stores),
        "terminals": flat,
        "terminal_settings": kept,
        "settings_counts": counts,
    }


def reassign_worklist(matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs to reassign, skipped): terminal and store both known and not blank."""
    ok, skipped = drop_blank(matches.select("terminal_id", "store_id"), ["terminal_id", "store_id"])
    return ok, skipped


def patch_worklist(matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(terminals to patch, skipped): marked, and id not blank."""
    marked = matches.where(F.col("to_disable_standalone_tip"))
    return drop_blank(marked.select("terminal_id"), ["terminal_id"])
