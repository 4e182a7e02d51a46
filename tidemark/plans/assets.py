"""CRM asset snapshot with hashes."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import rename
from tidemark.functions.clock import day, stamp_scd
from tidemark.functions.contracts import CRM_ASSET_NAMES, conform, record
from tidemark.functions.hashing import with_hashes

# Source columns and the types they are stored under.
COLUMNS = record("""
establishment_UID STRING, Product STRING, ChannelV2 STRING, Referrer STRING,
ActivatedBy STRING, InstallDate DATE, DisabledDate DATE, Status STRING,
Establishment_name STRING, ShippingPostalCode STRING, ShippingCity STRING,
ShippingStreet STRING, PersonEmail STRING, email_permission BOOLEAN, AccountId_Long STRING,
Crm_Metro_Id STRING, Store_Id BIGINT, Crm_Account_Identifier BIGINT, VAT_id STRING,
metro_id BIGINT, cust_no BIGINT, home_store_id BIGINT, _create_ts STRING, _update_ts STRING
""")
KEY = ["establishment_UID", "Crm_Account_Identifier"]


def asset_snapshot(df: DataFrame, as_of: date | datetime) -> DataFrame:
    """Typed asset rows with load date, hashes and version columns.

    The key (establishment, account) repeats: an account can hold many assets.
    """
    typed = conform(df, COLUMNS).withColumn("_ldts", F.lit(day(as_of)))
    return stamp_scd(with_hashes(typed, KEY, COLUMNS.names), as_of)


def asset_payload(delta: DataFrame) -> DataFrame:
    """Delta rows under the names of the event contract."""
    return rename(delta.select(*COLUMNS.names, "_ldts"), CRM_ASSET_NAMES)
